"""Checks over whole tables: counts, keys, references, lengths, profiles, query suites."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.operators.ordering import union_all
from silverloom.operators.skew import exchanged, key_of
from silverloom.session import run_each

PROFILE_SCHEMA = (
    "table_name string, status string, row_count bigint, table_schema string, "
    "sample string, error string"
)
SUITE_SCHEMA = (
    "query string, status string, rows_shown int, truncated boolean, result string, error string"
)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` over all tables, sorted by name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return union_all(counts).orderBy("table_name")


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: ``(keys..., violation, row_count)``.

    A key with a NULL part is reported as ``null``, any other repeated key as ``duplicate``.
    The count is partial before the shuffle, so a sentinel shared by much of the table
    arrives as one row per map task.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("violation", F.when(has_null, "null").when(F.col("row_count") > 1, "duplicate"))
        .where(F.col("violation").isNotNull())
        .select(*keys, "violation", "row_count")
    )


def fk_orphans(
    child: DataFrame, parent: DataFrame, on: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Child rows that refer to no parent row. A NULL reference is not checked.

    ``on`` maps child columns to parent columns. The child is the streamed side; the parent
    contributes its distinct keys only.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    parent_keys = parent.select(
        *[F.col(f"`{p}`").alias(f"__p{i}") for i, p in enumerate(pairs.values())]
    ).distinct()
    not_null = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in pairs])
    matches = exchanged(
        [key_of(child, c, "c") for c in pairs],
        [key_of(parent_keys, c) for c in parent_keys.columns],
    )
    return child.where(not_null).alias("c").join(parent_keys, matches, "left_anti")


def length_violations(
    df: DataFrame, limits: Mapping[str, int], keys: Sequence[str] = ()
) -> DataFrame:
    """Values longer than their limit: ``(keys..., column_name, max_length, length)``.

    All columns are checked in one scan without a shuffle.
    """
    found = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(limit).alias("max_length"),
                F.char_length(F.col(f"`{column}`")).alias("length"),
            )
            for column, limit in limits.items()
        ]
    )
    too_long = F.filter(found, lambda v: v["length"] > v["max_length"])
    return df.select(*keys, F.inline(too_long))


def _message(e: Exception) -> str:
    return f"{type(e).__name__}: {e}".splitlines()[0]


def profile(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame] | DataFrame],
    sample_rows: int = 5,
) -> DataFrame:
    """Status, row count, schema and a small sample per table.

    A table is a frame or a function that opens one. Failing to open or to read a table is
    recorded in its row and does not stop the rest.
    """

    def examine(item):
        name, table = item
        try:
            df = table() if callable(table) else table
            count = df.count()
            sample = df.limit(sample_rows).select(F.to_json(F.struct("*"))).collect()
            text = "[" + ",".join(r[0] for r in sample) + "]"
            return name, "success", count, df.schema.simpleString(), text, None
        except Exception as e:  # any failure belongs in the report
            return name, "error", None, None, None, _message(e)

    return spark.createDataFrame(run_each(spark, tables.items(), examine), PROFILE_SCHEMA)


def run_suite(spark: SparkSession, queries: Mapping[str, str], max_rows: int = 20) -> DataFrame:
    """Run named SQL texts; per query its status and its first rows as JSON.

    At most ``max_rows`` are shown; ``truncated`` says whether the answer has more.
    """

    def answer(item):
        name, text = item
        try:
            result = spark.sql(text).limit(max_rows + 1)
            found = [r[0] for r in result.select(F.to_json(F.struct("*"))).collect()]
            shown = found[:max_rows]
            text = "[" + ",".join(shown) + "]"
            return name, "success", len(shown), len(found) > max_rows, text, None
        except Exception as e:  # any failure belongs in the report
            return name, "error", None, None, None, _message(e)

    return spark.createDataFrame(run_each(spark, queries.items(), answer), SUITE_SCHEMA)
