"""Tables by path, literal and sequence tables, file sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from silverloom.operators.ordering import assign_parts
from silverloom.sources.bronze import FILE_RECORDS

OVERWRITE = "overwrite"
APPEND = "append"
CREATE = "errorifexists"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Snapshot of a table; ``fmt`` may name any format on the classpath."""
    return spark.read.format(fmt).load(path)


def sql_over_path(spark: SparkSession, query: str, fmt: str = "parquet", **paths: str) -> DataFrame:
    """Run SQL whose ``{name}`` placeholders stand for tables at the given paths."""
    return spark.sql(query.format(**{n: f"{fmt}.`{p}`" for n, p in paths.items()}))


def literal_table(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def sequence_table(spark: SparkSession, start: int, end: int) -> DataFrame:
    return spark.range(start, end)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = OVERWRITE,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Replace, append to or create a table.

    Do not overwrite a path the frame is read from: write a new path and switch readers.
    """
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_json(df: DataFrame, path: str, mode: str = OVERWRITE) -> None:
    """Results as JSON lines; dates and timestamps are written as text."""
    df.write.mode(mode).json(path)


def write_parts(
    df: DataFrame,
    path: str,
    order_by: Sequence[Column | str],
    k: int,
    fmt: str = "csv",
    mode: str = OVERWRITE,
) -> None:
    """Split into ``k`` ordered parts, one folder ``part=i`` each, with a header if CSV.

    Records are never cut. Files of a part, in name order, hold its rows in order; how many
    files a part has follows from its size, so no task has to write a whole part.
    """
    rows = assign_parts(df, order_by, k).sortWithinPartitions("part", "position")
    writer = rows.drop("position").write.mode(mode).partitionBy("part").format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"', maxRecordsPerFile=FILE_RECORDS)
    writer.save(path)


def preview(df: DataFrame, n: int = 10) -> list[dict]:
    """A few rows for the eye; the rows of an unordered table are not fixed."""
    return [r.asDict(recursive=True) for r in df.limit(n).collect()]
