"""Connected components of undirected links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverloom.llm.common import split_join, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    linked = split_join(both, least.withColumn("m", F.least("u", "m")), ["u"], "inner")
    return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = split_join(edges, least, ["u"], "inner")
    own = least.select("u", F.col("m").alias("v"))
    return linked.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (u, v) of type long; the least node names it.

    Alternates two steps that hang neighbours under the least node in sight until nothing
    changes, which takes a few rounds even for long chains. A hub is reduced by partial minima
    and its links can be split in the join. Each round is stored. Null and self links are
    ignored; no links give no rows.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(edges.where("u > v").dropna().distinct(), "links")

    def state(df: DataFrame):
        mixed = F.xxhash64("u", "v").cast("decimal(20,0)")
        return df.agg(F.count(F.lit(1)), F.sum(mixed)).first()

    before = state(edges)
    while True:
        edges = _small_star(_large_star(edges).distinct()).distinct()
        edges = stored(edges, "links")
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("u"), "v")
    return edges.union(roots).distinct().select(
        F.col("u").alias("node"), F.col("v").alias("component")
    )
