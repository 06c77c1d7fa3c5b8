"""Relational sources and targets over JDBC.

The driver jar, address and credentials come from the caller as options.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from silverloom.operators.conform import conform
from silverloom.schemas import TargetTable


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Read a table; with a partition column and bounds, over several connections."""
    reader = spark.read.format("jdbc").options(**(options or {})).option("url", url)
    reader = reader.option("dbtable", table)
    if partition_column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("a partition column needs bounds and num_partitions")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(num_partitions),
        )
    return reader.load()


def jdbc_write_options(
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    max_connections: int = 16,
    batch_size: int = 10_000,
    cascade: bool = False,
) -> dict[str, str]:
    """``truncate`` keeps the target's own column types, keys and references on overwrite;
    without it the table would be dropped and created anew from the frame's types. A table that
    others refer to can only be emptied with them (``cascade``): load those after it."""
    return {
        "truncate": "true",
        "cascadeTruncate": str(cascade).lower(),
        "batchsize": str(batch_size),
        "numPartitions": str(max_connections),
        **(options or {}),
        "url": url,
        "dbtable": table,
    }


def column_types(target: TargetTable) -> str:
    """Types for a table that does not exist yet, where the frame's types say too little."""
    return ", ".join(f"`{c}` VARCHAR({n})" for c, n in target.lengths.items())


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    target: TargetTable | None = None,
    options: Mapping[str, str] | None = None,
    mode: str = "overwrite",
    max_connections: int = 16,
) -> None:
    """Write to a relational table, first fitted to the target's columns if they are given.

    Executors write in parallel over at most ``max_connections`` connections.
    """
    cascade = target is not None and target.foreign_key is None and target.cascade
    settings = jdbc_write_options(url, table, options, max_connections, cascade=cascade)
    rows = df
    if target is not None:
        rows = conform(df, target.schema)
        settings.setdefault("createTableColumnTypes", column_types(target))
    rows.write.format("jdbc").options(**settings).mode(mode).save()
