"""Sharding by rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverloom.llm.common import stored, table

#: Hexadecimal digits of a digest that fit a double exactly.
_DIGITS = 13


def rendezvous(key: Column, weights: Sequence[float], seed: str = "") -> Column:
    """The shard (0, 1, ...) of a key: the least ``-ln(u) / weight`` over all shards.

    ``u`` is drawn from a digest of the key and the shard alone, so another shard takes keys
    only into itself, and a changed weight moves keys only from or to its own shard. A null
    key is a key like any other. Weights must be positive.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    name = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))

    def score(shard: int, weight: float) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(seed), F.lit(str(shard)), name))
        u = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double")
        cost = -F.log((u + 0.5) / float(16**_DIGITS)) / F.lit(float(weight))
        return F.struct(cost.alias("cost"), F.lit(shard).alias("shard"))

    return F.array_min(F.array(*[score(i, w) for i, w in enumerate(weights)]))["shard"]


def number_slots(df: DataFrame, shard: str = "shard", scratch: str | None = None) -> DataFrame:
    """Add ``slot``: a gapless number from 0 within each shard.

    Rows are numbered within (shard, input split), which no hot key can swell beyond one split,
    and moved up by the rows of the splits before. The numbered rows are stored once, since a
    second evaluation could be cut into other splits. Which row gets which slot follows the
    layout of the input, the shard itself does not.
    """
    split = Window.partitionBy(shard, "__split").orderBy(F.lit(0))
    numbered = df.withColumn("__split", F.spark_partition_id()).withColumn(
        "__at", F.row_number().over(split) - 1
    )
    numbered = stored(numbered, "shards", scratch)
    # One row per shard and split from here on.
    before = Window.partitionBy(shard).orderBy("__split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy(shard, "__split").agg(F.count(F.lit(1)).alias("__rows"))
    offsets = offsets.select(
        shard, "__split", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__from")
    )
    slots = numbered.join(offsets, [shard, "__split"])
    return slots.select(*df.columns, (F.col("__from") + F.col("__at")).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, key: str, weights: Sequence[float]) -> None:
    """Write the rows as one folder ``shard=N`` per shard. Columns named shard are replaced."""
    df.withColumn("shard", rendezvous(F.col(key), weights)).write.partitionBy("shard").parquet(path)


def op9_sharding(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    """Law ``key``: doc_id and the shard count decide. Null texts have size 1 and the CRC of no
    bytes; repeated rows fall into one shard and get slots of their own."""
    text = F.coalesce("text", F.lit(""))
    key = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, [1.0] * shards).alias("shard"),
        rendezvous(key, [1.0] * (shards + 1)).alias("grown_shard"),
    )
    out = number_slots(rows)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
