"""Substring search by an inverted index of short pieces of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest piece that the index holds.
LONGEST = 3


def _pieces(text: Column, sizes: Column) -> Column:
    """The distinct substrings of the given sizes; none for NULL and for the empty text."""

    def of_size(size: Column) -> Column:
        last = F.length(text) - size + 1
        places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substring(text, i, size))

    return F.array_distinct(F.flatten(F.transform(sizes, of_size)))


def substring_index(df: DataFrame, column: str, ignore_case: bool = False) -> DataFrame:
    """``(piece, text)``: each distinct text of a column under its substrings of one to three
    characters, sorted by piece within each file.

    Store it once as a table; a search then reads the row groups of its own pieces. Repeated
    texts meet before they are taken apart, and the pieces are spread by (piece, text), so
    neither a common text nor a common piece gathers in one task. NULL and empty texts are not held.
    """
    texts = df.select(F.col(f"`{column}`").alias("text")).where(F.length("text") > 0).distinct()
    searched = F.lower("text") if ignore_case else F.col("text")
    sizes = F.array(*[F.lit(n) for n in range(1, LONGEST + 1)])
    pieces = texts.select(F.explode(_pieces(searched, sizes)).alias("piece"), "text")
    return pieces.repartition("piece", "text").sortWithinPartitions("piece", "text")


def texts_containing(index: DataFrame, pattern: str, ignore_case: bool = False) -> DataFrame:
    """``(text)``: the distinct texts that contain ``pattern``, out of a stored index made with
    the same ``ignore_case``.

    A pattern of up to three characters is a piece itself. A longer one is looked up by all its
    pieces of three; the texts that have every one of them are then tested in full. An empty
    pattern is contained in every text, which an index without empty texts cannot tell: it is refused.
    """
    if not pattern:
        raise ValueError("an index can't answer for the empty pattern")
    if ignore_case:
        pattern = pattern.lower()
    size = min(len(pattern), LONGEST)
    wanted = sorted({pattern[i : i + size] for i in range(len(pattern) - size + 1)})
    hits = index.where(F.col("piece").isin(wanted))
    if len(pattern) <= LONGEST:
        return hits.select("text")
    searched = F.lower("text") if ignore_case else F.col("text")
    held = hits.groupBy("text").agg(F.count(F.lit(1)).alias("__held"))
    return held.where((F.col("__held") == len(wanted)) & searched.contains(pattern)).select("text")
