"""Ordering, limits, unions and exact global positions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.session import scratch_path

_SEQ = "__seq"
_TASK = "__task"
_PART = "__part"
_OFFSET = "__offset"
_TOTAL = "__total"


def _columns(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order_by]


def top_k(df: DataFrame, order_by: Sequence[Column | str], k: int) -> DataFrame:
    """First ``k`` rows by ``order_by``, which should end in a tie-break.

    Runs as a top-k (each task keeps ``k`` rows), never as a full sort.
    """
    return df.orderBy(*_columns(order_by)).limit(k)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by position; the first frame names the columns."""
    return reduce(DataFrame.unionAll, frames)


def _positioned(
    df: DataFrame, order_by: Sequence[Column | str], partitions: int | None, scratch: str | None
):
    spark = df.sparkSession
    path = scratch or scratch_path(spark, "positions")
    # Rows whose order columns are equal can be cut apart by the hash, and copies of one row
    # by the task that read them, so no value has to fit into one range.
    order = [*_columns(order_by), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col(_TASK)]
    tagged = (
        df.withColumn(_TASK, F.spark_partition_id())
        .repartitionByRange(*([partitions] if partitions else []), *order)
        .sortWithinPartitions(*order)
        .drop(_TASK)
        .withColumn(_SEQ, F.monotonically_increasing_id())
    )
    # Range bounds come from a sample, so a second evaluation could cut elsewhere: the tagged
    # rows are stored once and both the counts and the positions read what was stored.
    tagged.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(tagged.schema).parquet(path)
    stored = stored.withColumn(_PART, F.shiftright(_SEQ, 33))

    # One row per partition from here on, which bounds the window and the broadcast.
    counts = stored.groupBy(_PART).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = counts.select(
        _PART,
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(_OFFSET),
        F.sum("rows").over(everything).alias(_TOTAL),
    )
    local = F.col(_SEQ).bitwiseAND(F.lit((1 << 33) - 1))
    joined = stored.join(F.broadcast(offsets), _PART)
    return joined, F.col(_OFFSET) + local


def with_position(
    df: DataFrame,
    order_by: Sequence[Column | str],
    name: str = "position",
    partitions: int | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Exact 0-based position of every row in the total order ``order_by``.

    One range shuffle, as wide as the session's shuffles unless ``partitions`` says otherwise,
    and a table of the tagged rows, kept at ``scratch`` for the caller to remove when the result
    is no longer needed; no window over the whole table in one task. Give a unique order if the
    result must not depend on how ties fall.
    """
    joined, position = _positioned(df, order_by, partitions, scratch)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], position.alias(name))


def assign_parts(
    df: DataFrame,
    order_by: Sequence[Column | str],
    k: int,
    part: str = "part",
    position: str = "position",
    partitions: int | None = None,
    scratch: str | None = None,
) -> DataFrame:
    """Number ``k`` consecutive parts of ``n div k`` rows from 1; the last takes the rest.

    With fewer rows than parts, all rows are in the last part.
    """
    joined, pos = _positioned(df, order_by, partitions, scratch)
    chunk = F.floor(F.col(_TOTAL) / k)
    number = F.when(chunk == 0, F.lit(k)).otherwise(
        F.least(F.floor(pos / chunk) + 1, F.lit(k))
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        pos.alias(position),
        number.cast("int").alias(part),
    )
