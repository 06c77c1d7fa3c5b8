"""Exact Jaccard join of documents' word shingles in a metric space, region by region.

The Jaccard distance is a metric, but documents without common shingles are all at distance 1,
where a document as a pivot tells nothing apart. So the first partition has another pivot for
every shingle ``s``: the set of all shingles up to ``s`` in one fixed order, rare ones first. In the
metric of the symmetric difference, a document and one linked to it lie within their few
differing shingles of each other, so by the triangle inequality both meet such a pivot within
their first ``n - ceil(t n) + 1`` shingles. A document is replicated into just these regions, and
two linked documents share one. In the first that they share, the smaller of the two stands even within its first
``n - ceil(2 t n / (1 + t)) + 1``; a region needs such an "early" member in each pair.

Within a region early documents are the pivots, under the Jaccard distance, with radius
``r = 1 - t``. The first level compares every region with one pivot, which is done with
after that; those within ``r`` of it are its cell, linked and one component. Regions that have
become one component are done. A region that is still large is split by its pivot: members beyond
``2 r`` cannot be linked to the cell, so the cell goes on with the boundary (between ``r`` and
``2 r``) as one region, boundary and rest as another. Small regions, and those that a pivot tells
little about, are leaves: only members of different components are compared there, block by block,
and only the pairs that may be linked become rows. Distances are taken from the counts of shingles in slices of the
hash space first: they never exceed those of the sets, so they rule out most pairs and make
boundaries no smaller. Only pairs that they leave open are compared shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverloom.llm.common import ship_code, split_join, stored, table
from silverloom.llm.graph import components

SHINGLE = 5
#: Linked if ``PARTS * common >= SHARE * all``.
SHARE, PARTS = 80, 100
#: Slots of the table of shingle frequencies that orders shingles, and how many are sent at a time.
SLOTS, BLOCK = 1 << 20, 1 << 12
#: Largest region that is a leaf.
LEAF = 512
#: Levels at first that compare each region, leaves too, with one pivot.
STAR_LEVELS = 1
#: A region is split by its pivot if at most one member of so many is in the boundary.
SPLIT = 5
#: Largest region, in rows, whose members without a possible partner are dropped.
SIFT = 32
#: Bytes of text hashed at a time, and sets that a task remembers having sent.
_BYTES = 1 << 18
_SEEN = 100_000

#: Sets, and shingles in them, that a block of a region has on average.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 19

_U = np.uint64


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x + _U(0x9E3779B97F4A7C15 * (salt + 1) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


_VALUE = _mix(np.arange(256, dtype=_U))
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE, _STEP = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


def _sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of texts (UTF-8 end to end, cut at ``offsets``), each with the
    number of its text; by text, then hash."""
    n = len(offsets) - 1
    blank = _BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = blank[:-1]
    starts = np.flatnonzero(~blank & (before | edge[:-1]))
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    runs = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, runs)
    letters = _VALUE[data[starts[0] :]] * _powers(_BASE, int(runs.max()))[place]
    letters[blank[starts[0] :]] = 0
    word = _mix(np.add.reduceat(letters, starts - starts[0]))
    text = np.searchsorted(offsets, starts, "right") - 1

    count = np.bincount(text, minlength=n)
    first = np.cumsum(count) - count
    weights = _powers(_STEP, size)
    whole = np.flatnonzero(count[text] >= size)
    whole = whole[whole - first[text[whole]] <= count[text[whole]] - size]
    hashes = np.zeros(len(whole), _U)
    for j in range(size):
        hashes += word[whole + j] * weights[j]
    few = np.flatnonzero((count > 0) & (count < size))
    short = np.zeros(len(few), _U)
    for j in range(size - 1):
        has = count[few] > j
        short[has] += word[first[few[has]] + j] * weights[j]
    short += count[few].astype(_U)

    text = np.concatenate([text[whole], few])
    hashes = np.concatenate([_mix(hashes, 1), _mix(short, 2)])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[fresh], hashes[fresh]


def _slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts some megabytes at a time: number of the first, their bytes, their offsets."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + _BYTES, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


class _Texts:
    """The shingle sets of some texts: ``text`` and ``hashes`` as in :func:`_sets`, their sizes,
    and two independent fingerprints of each set."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int):
        self.text, self.hashes = _sets(data, offsets, size)
        n = len(offsets) - 1
        self.sizes = np.bincount(self.text, minlength=n)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.marks = []
        for salt in (3, 4):
            total = np.append(_U(0), np.cumsum(_mix(self.hashes, salt)))
            sums = total[self.first + self.sizes] - total[self.first]
            self.marks.append(_mix(sums, salt).view(np.int64))


def _by_texts(df: DataFrame, schema: str, make, size: int) -> DataFrame:
    """Run ``work(ids, texts)``, from ``make()`` in each task, over (doc_id, text)."""
    ship_code(df.sparkSession)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, rest = make()
        for batch in batches:
            ids = batch.column("doc_id")
            for at, data, offsets in _slices(batch.column("text")):
                found = _Texts(data, offsets, size)
                columns = work(ids.slice(at, len(offsets) - 1), found)
                if columns is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
        if rest is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rest()], names)

    return df.select("doc_id", "text").mapInArrow(run, schema)


def _counts(t: _Texts, wanted: np.ndarray) -> pa.Array:
    """How many shingles of each wanted set fall in each slice, a byte a slice. A set of ``n`` has
    the power of two up to ``n`` as its number of slices. Null if a count exceeds a byte."""
    slices = np.where(wanted, 1 << np.frexp(np.maximum(t.sizes, 1))[1] >> 1, 0)
    ends = np.append(0, np.cumsum(slices))
    own = wanted[t.text]
    text, hashes = t.text[own], t.hashes[own]
    cell = ends[text] + (hashes % slices[text].astype(_U)).astype(np.int64)
    counts = np.bincount(cell, minlength=ends[-1])
    good = wanted.copy()
    good[np.searchsorted(ends, np.flatnonzero(counts > 255), "right") - 1] = False
    data = pa.py_buffer(np.minimum(counts, 255).astype(np.uint8).tobytes())
    valid = pa.py_buffer(np.packbits(good, bitorder="little").tobytes())
    offsets = pa.py_buffer(ends.astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(wanted), [valid, offsets, data])


class _New:
    """Picks the sets that a task has not met before; it remembers a bounded number."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, ids: pa.Array, t: _Texts) -> np.ndarray:
        new = np.zeros(len(t.sizes), bool)
        for i, mark in enumerate(t.marks[0].tolist()):
            if t.sizes[i] and mark not in self.seen and ids[i].is_valid:
                if len(self.seen) >= _SEEN:
                    self.seen.clear()
                self.seen.add(mark)
                new[i] = True
        return new


_DESCRIBED = "doc_id long, n long, node long, mark long, slices binary, block long, often binary"


def _describe():
    """Every text, and in the end how often the task met the shingles of each slot."""
    often = np.zeros(SLOTS, np.int64)
    pick = _New()

    def work(ids: pa.Array, t: _Texts):
        slots = (t.hashes % _U(SLOTS)).astype(np.int64)
        np.add.at(often, slots, 1)
        n = len(t.sizes)
        slices = _counts(t, pick(ids, t))
        none = pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())
        return ids, t.sizes.astype(np.int64), t.marks[0], t.marks[1], slices, *none

    def rest():
        rows = often.reshape(-1, BLOCK)
        blocks = np.flatnonzero(rows.any(axis=1))
        none = pa.nulls(len(blocks), pa.int64())
        data = pa.array([_pack(rows[i]) for i in blocks], pa.binary())
        return none, none, none, none, pa.nulls(len(blocks), pa.binary()), blocks, data

    return work, rest


def _pack(counts: np.ndarray) -> bytes:
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // BLOCK}").astype(np.int64)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            total[block] = total.get(block, 0) + _unpack(data.as_buffer())
    data = pa.array([_pack(x) for x in total.values()], pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), data], ["block", "often"])


def _order(described: DataFrame) -> np.ndarray:
    """A coarse rank of every slot's frequency, in a byte."""
    blocks = described.where("block IS NOT NULL").select("block", "often").repartition("block")
    often = np.zeros((SLOTS // BLOCK, BLOCK), np.int64)
    for row in blocks.mapInArrow(_add_up, "block long, often binary").collect():
        often[row[0]] = _unpack(row[1])
    return (4 * np.log2(often.ravel() + 1.0)).astype(np.uint8)


def _windows(often: np.ndarray, share: int, parts: int):
    """Regions of each set: its first shingles in the fixed order. A set is sent once by a task."""

    def make():
        pick = _New()

        def work(ids: pa.Array, t: _Texts):
            new = pick(ids, t)
            slots = (t.hashes % _U(SLOTS)).astype(np.int64)
            order = np.lexsort((t.hashes, often[slots], t.text))
            reach = t.sizes - -(-share * t.sizes // parts) + 1
            place = np.arange(len(t.text)) - t.first[t.text]
            kept = new[t.text] & (place < reach[t.text])
            text = t.text[kept]
            hashes = t.hashes[order][kept].view(np.int64)
            return hashes, t.marks[0][text], t.sizes[text].astype(np.int64), place[kept]

        return work, None

    return make


def _whole_sets():
    def work(ids: pa.Array, t: _Texts):
        ends = np.append(t.first, len(t.hashes)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(t.hashes.view(np.int64)))
        return t.marks[0], t.sizes.astype(np.int64), lists

    return work, None


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most that two sets can have in common by their counts in slices (or by their sizes)."""
    for batch in batches:
        sides = zip(*(batch.column(x) for x in ("na", "nb", "sa", "sb")))
        bounds = np.zeros(batch.num_rows, np.int64)
        for i, (na, nb, sa, sb) in enumerate(sides):
            if not (sa.is_valid and sb.is_valid):
                bounds[i] = min(na.as_py(), nb.as_py())
                continue
            x, y = (np.frombuffer(s.as_buffer(), np.uint8) for s in (sa, sb))
            few = min(len(x), len(y))
            x, y = (s if len(s) == few else s.reshape(-1, few).sum(axis=0) for s in (x, y))
            bounds[i] = np.minimum(x, y).sum()
        kept = [batch.column(x) for x in ("a", "b", "na", "nb")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(bounds)], ["a", "b", "na", "nb", "bound"])


def _linked(common: Column, a: Column, b: Column, share: int, parts: int) -> Column:
    return parts * common >= share * (a + b - common)


class _Prepared(NamedTuple):
    """What both modes of the join start from."""

    described: DataFrame
    with_id: DataFrame
    classes: DataFrame
    regions: DataFrame
    whole: Callable[[DataFrame], DataFrame]


def _prepare(
    docs: DataFrame, doc_id: str, text: str, size: int, share: int, parts: int
) -> _Prepared:
    if not 0 < share <= parts:
        raise ValueError("the least similarity is above 0 and at most 1")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    described = stored(_by_texts(source, _DESCRIBED, _describe, size), "join-sets")
    often = _order(described)
    described = described.where("block IS NULL")
    with_id = described.where("doc_id IS NOT NULL AND n > 0")
    collision = F.raise_error(F.lit("two shingle sets have one hash")).cast("long")
    classes = with_id.groupBy("node").agg(
        F.when(F.min("mark") == F.max("mark"), F.min("doc_id")).otherwise(collision).alias("doc_id")
    )

    # Common shingles come last in the order; any order gives the same links.
    keyed = _by_texts(
        source, "region long, node long, n long, at long", _windows(often, share, parts), size
    )
    # ceil(2 t n / (1 + t)) in whole numbers.
    both = F.ceil(F.lit(2 * share) * F.col("n") / F.lit(parts + share))
    keyed = keyed.withColumn("early", F.col("at") <= F.col("n") - both)
    everyone = Window.partitionBy("region").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    regions = keyed.withColumns(
        {
            "lo": F.min("node").over(everyone),
            "hi": F.max("node").over(everyone),
            "any": F.max("early").over(everyone),
            "rows": F.count(F.lit(1)).over(everyone),
        }
    ).where("lo < hi AND any")
    regions = stored(_sifted(regions, ["node"], share, parts), "join-regions")
    regions = stored(_first_of_equal(regions), "join-regions")

    def whole(wanted: DataFrame) -> DataFrame:
        """The sets of some nodes; some may be there twice if rows share a doc_id."""
        ids = stored(split_join(classes, wanted, ["node"], "left_semi").select("doc_id"), "join-members")
        texts = source.join(ids.distinct(), "doc_id", "left_semi")
        sets = _by_texts(texts, "node long, n long, shingles array<bigint>", _whole_sets, size)
        return stored(sets.where("n > 0"), "join-shingles")

    return _Prepared(described, with_id, classes, regions, whole)


def ngram_join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    share: int = SHARE,
    parts: int = PARTS,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    A text's set: its distinct runs of ``size`` words (A-Z lower-cased, cut at ASCII white space),
    or all its words if it has fewer. Two documents are linked if ``parts * common >=
    share * all`` of their shingles; ``component_id`` is the least doc_id that links lead to. Null,
    empty and blank texts have no shingles and no links; rows without a doc_id have a null
    component and link nothing; repeated rows stay; rows that share a doc_id are told apart by
    their sets.

    Equal sets are one node throughout, so copies cost one row each. Shingles are 64-bit hashes
    and sets are named by one, checked against a second: a collision stops the job. Only the fixed-size
    frequency table and counts reach the driver. Every level of the recursion is stored.
    """
    described, with_id, _, regions, whole = _prepare(docs, doc_id, text, size, share, parts)
    placed = regions.select("node").distinct()
    nodes = split_join(with_id.select("node", "n", "slices"), placed, ["node"], "left_semi")
    nodes = nodes.groupBy("node").agg(F.first("n").alias("n"), F.max("slices").alias("slices"))
    nodes = stored(nodes, "join-slices")
    labels = nodes.select("node", F.col("node").alias("component"))
    labels = stored(labels, "join-labels")
    leaves, level = [], 0
    while True:
        here = stored(_open(regions, labels), "join-level")
        if level >= STAR_LEVELS:
            leaves.append(here.where(F.col("members") <= LEAF).select(*_OWN))
            here = here.where(F.col("members") > LEAF)
        if here.isEmpty():
            break
        if level < STAR_LEVELS:
            labels, _, _ = _star(here, labels, nodes, whole, share, parts)
            regions = here.where("node <> first").select(*_OWN)
        else:
            regions, labels, leaf = _split(here, labels, nodes, whole, share, parts)
            leaves.append(leaf)
        level += 1
    for best in (True, False) if leaves else ():
        left = reduce(DataFrame.union, leaves)
        pairs = _leaf_pairs(left, labels, nodes, share, parts, best)
        labels = _relabel(labels, _linked_pairs(pairs, whole, share, parts))

    placed = split_join(with_id.select("doc_id", "n", "node"), labels, ["node"], "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = split_join(placed, least, ["component"], "inner").select("doc_id", "n", "component_id")
    alone = described.where("doc_id IS NULL OR n = 0")
    return linked.union(
        alone.select("doc_id", "n", F.when(F.col("n") == 0, F.col("doc_id")))
    ).withColumnRenamed("n", "n_shingles")


def _sifted(regions: DataFrame, names: list[str], share: int, parts: int) -> DataFrame:
    """Distinct members of regions of so many ``rows``, in small ones only those that may be
    linked to a member of another name (the last of ``names``) by their sizes and places. In the
    first region that two linked documents share, neither has common shingles before its place, so
    they pass there; most that meet in a rare shingle by chance do not. A small region is one
    array, larger ones are arrays of one member each."""
    member = F.struct(*names, "n", "at", "early")
    apart = F.when(F.col("rows") > SIFT, F.col("node"))
    groups = regions.groupBy("region", "rows", apart.alias("apart")).agg(
        F.collect_set(member).alias("members")
    )

    def partner(x: Column) -> Callable[[Column], Column]:
        def meets(y: Column) -> Column:
            most = F.least(x["n"] - x["at"], y["n"] - y["at"])
            return (x[names[-1]] != y[names[-1]]) & _linked(most, x["n"], y["n"], share, parts)

        return meets

    some = F.filter("members", lambda x: F.exists("members", partner(x)))
    kept = F.when(F.col("rows") > SIFT, F.col("members")).otherwise(some)
    return groups.select("region", F.explode(kept).alias("m")).select("region", "m.*")


def _first_of_equal(regions: DataFrame) -> DataFrame:
    """Of regions with the same members, the one whose shingle comes first in the order. Two
    documents' first common region stays: one before it would be common to them too."""
    members = regions.groupBy("region").agg(
        F.count(F.lit(1)).alias("members"),
        F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        F.sum("at").alias("at"),
    )
    first = members.groupBy("members", "x", "y").agg(F.min(F.struct("at", "region")).alias("first"))
    return split_join(regions, first.select("first.region"), ["region"], "left_semi")


_OWN = ["region", "node", "n", "at", "early"]


def _open(regions: DataFrame, labels: DataFrame) -> DataFrame:
    """Members, with their components, of the regions that are not one component yet and have an
    early member; ``first`` is the region's pivot. No region has to fit a task."""
    here = split_join(regions, labels, ["node"], "inner")
    open_ = (
        here.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.min("component").alias("lo"),
            F.max("component").alias("hi"),
            F.min(F.when(F.col("early"), F.col("node"))).alias("first"),
        )
        .where("lo < hi AND first IS NOT NULL")
        .select("region", "members", "first")
    )
    return split_join(here, open_, ["region"], "inner")


def _star(
    here: DataFrame,
    labels: DataFrame,
    nodes: DataFrame,
    whole: Callable[[DataFrame], DataFrame],
    share: int,
    parts: int,
    every: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Compare each region with its pivot: as many pairs as members at most. The components after
    that, the pairs with their bounds, and the linked ones. Pairs that cannot be linked or are of
    one component are left out, unless ``every`` distance is wanted."""
    pivots = here.where("node = first").select(
        "region", *(F.col(x).alias(f"{x}a") for x in ("component", "n", "at"))
    )
    ends = [F.col(x).alias(f"{x}b") for x in ("node", "component", "n", "at")]
    others = here.where("node <> first").select("region", "first", *ends)
    # What two sets can still have in common from the places of this shingle on.
    most = F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb"))
    able = (F.col("componenta") != F.col("componentb")) & _linked(
        most, F.col("na"), F.col("nb"), share, parts
    )
    pairs = split_join(others, pivots, ["region"], "inner").where(able | F.lit(every))
    a, b = F.least("first", "nodeb").alias("a"), F.greatest("first", "nodeb").alias("b")
    pairs = pairs.select(a, b).distinct()
    for x in "ab":
        side = nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("slices").alias(f"s{x}"))
        pairs = split_join(pairs, side, [x], "inner")
    counted = pairs.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(
        _bound, "a long, b long, na long, nb long, bound long"
    )
    counted = stored(counted, "join-bounds")
    near = counted.where(_linked(F.col("bound"), F.col("na"), F.col("nb"), share, parts))
    linked = _linked_pairs(near.drop("bound"), whole, share, parts)
    return _relabel(labels, linked), counted, linked


def _linked_pairs(
    pairs: DataFrame, whole: Callable[[DataFrame], DataFrame], share: int, parts: int
) -> DataFrame:
    """Of stored pairs (a, b, na, nb) those that are linked, compared shingle by shingle."""
    linked = pairs
    if not pairs.isEmpty():
        sets = whole(pairs.select("a").union(pairs.select("b")).distinct().toDF("node"))
        for x in "ab":
            side = sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}"))
            linked = split_join(linked, side, [x], "inner")
        linked = linked.withColumn("common", F.size(F.array_intersect("sa", "sb")))
        linked = linked.where(_linked(F.col("common"), F.col("na"), F.col("nb"), share, parts))
    return stored(linked.select("a", "b").distinct(), "join-pairs")


def _split(
    here: DataFrame,
    labels: DataFrame,
    nodes: DataFrame,
    whole: Callable[[DataFrame], DataFrame],
    share: int,
    parts: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Regions split by their pivot, the components, and the regions that are left as leaves: those
    whose boundary is large, as near copies of one text are all within ``2 r``, and those where
    one part would have more than three quarters of the members."""
    labels, counted, linked = _star(here, labels, nodes, whole, share, parts, every=True)
    # Distance from the pivot: within r (0), by the bound within 2 r (1), or beyond (2).
    within = _linked(F.col("bound"), F.col("na"), F.col("nb"), max(2 * share - parts, 0), parts)
    measured = split_join(
        counted.select("a", "b", F.when(within, 1).otherwise(2).alias("wide")),
        linked.withColumn("close", F.lit(0)),
        ["a", "b"],
        "left",
    ).select("a", "b", F.coalesce("close", "wide").alias("ring"))
    left = here.where("node <> first").select(*_OWN, "first").withColumns(
        {"a": F.least("node", "first"), "b": F.greatest("node", "first")}
    )
    ringed = stored(split_join(left, measured, ["a", "b"], "inner"), "join-rings")
    total, edge = F.count(F.lit(1)), F.count(F.when(F.col("ring") == 1, 1))
    larger = F.greatest(F.count(F.when(F.col("ring") <= 1, 1)), F.count(F.when(F.col("ring") >= 1, 1)))
    pays = (SPLIT * edge <= total) & (4 * larger <= 3 * total)
    ringed = split_join(
        ringed, ringed.groupBy("region").agg(pays.alias("pays"), edge.alias("edge")), ["region"], "inner"
    )
    leaf = ringed.where("NOT pays").select(*_OWN)
    # A cell without a boundary has nothing to be compared with.
    cell = ringed.where("pays AND ring <= 1 AND edge > 0").withColumn("cell", F.lit(0))
    rest = ringed.where("pays AND ring >= 1").withColumn("cell", F.lit(1))
    name = F.xxhash64("region", "first", "cell").alias("region")
    regions = cell.union(rest).select(name, *_OWN[1:])
    return stored(regions, "join-regions"), labels, leaf


def _leaf_pairs(
    leaves: DataFrame, labels: DataFrame, nodes: DataFrame, share: int, parts: int, best: bool
) -> DataFrame:
    """Pairs (a, b, na, nb) of different components that may be linked; with ``best`` only the
    nearest one of each guest in its group, by the bound. Components joined by these need no more
    pairs, so two large ones cost few; what is left is compared without that choice.

    One of each such pair is lone, outside the region's largest component. Members are cut into
    blocks and the lone ones, as guests, into blocks of their own; each block meets each block of
    guests in a group of its own. So a region of any size is spread over tasks, and its rows are
    little more than its members unless most of a large region is lone.
    """
    here = _open(leaves, labels).withColumnRenamed("members", "rows")
    here = stored(_sifted(here, ["node", "component"], share, parts), "join-leaves")
    alike = here.groupBy("region", "component").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n"))
    home = alike.groupBy("region").agg(
        F.max(F.struct("members", "n", "component")).alias("home"),
        F.sum("members").alias("members"),
        F.sum("n").alias("all"),
    )

    def blocks(members: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(members / BLOCK_SETS), F.ceil(shingles / BLOCK_SHINGLES))

    lone = blocks(F.col("members") - F.col("home.members"), F.col("all") - F.col("home.n"))
    home = home.select(
        "region",
        F.col("home.component").alias("home"),
        blocks(F.col("members"), F.col("all")).alias("blocks"),
        lone.alias("guests"),
    )
    rows = split_join(here, home, ["region"], "inner").withColumns(
        {
            "lone": F.expr("component <> home"),
            "block": F.expr("pmod(xxhash64(region, node), blocks)"),
            "guest": F.expr("pmod(xxhash64(node, region), guests)"),
        }
    )
    cells = F.expr(
        "array_distinct(concat("
        "transform(sequence(0L, guests - 1), x -> struct(block AS own, x AS visit)),"
        "if(lone, transform(sequence(0L, blocks - 1), x -> struct(x AS own, guest AS visit)), array())))"
    )
    rows = rows.withColumn("cell", F.explode(cells)).select(
        *_OWN,
        "component",
        "lone",
        F.col("cell.own").alias("own"),
        F.col("cell.visit").alias("visit"),
        F.expr("cell.own = block").alias("owner"),
        F.expr("lone AND cell.visit = guest").alias("guest"),
    )
    rows = split_join(rows, nodes.select("node", "slices"), ["node"], "inner")
    key = ["region", "own", "visit"]
    ship_code(rows.sparkSession)
    found = (
        rows.repartition(*key)
        .sortWithinPartitions(*key)
        .mapInArrow(_leaf_bounds(share, parts, best), "a long, b long, na long, nb long")
    )
    return stored(found.distinct(), "join-bounds")


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted rows as batches of whole groups, with the places where groups start, and the end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        ends = [[x.column(k)[x.num_rows - 1].as_py() for k in key] for x in (held[0], batch)]
        if len(held) > 1 and ends[0] == ends[1]:
            continue
        rows = pa.concat_batches(held)
        starts = _starts(rows, key)
        if len(starts) > 1:
            yield rows.slice(0, starts[-1]), starts
        held = [rows.slice(starts[-1])]
    if held:
        rows = pa.concat_batches(held)
        yield rows, np.append(_starts(rows, key), rows.num_rows)


def _starts(rows: pa.RecordBatch, key: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for k in key:
        values = rows.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


class _Slices:
    """The counts in slices of some sets, as matrices of sets with equally many slices."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, places: np.ndarray):
        sizes = offsets[places + 1] - offsets[places]
        self.by_size = {}
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            self.by_size[size] = own, {size: data[offsets[places[own], None] + np.arange(size)]}

    def bounds(self, one: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The most that each set can have in common with the one, at most ``most``."""
        out = most.copy()
        for size, (own, folded) in self.by_size.items():
            few = min(size, len(one))
            if not few:
                continue  # a set without counts
            if few not in folded:
                folded[few] = folded[size].reshape(len(own), -1, few).sum(axis=1, dtype=np.uint16)
            x = one if len(one) == few else one.reshape(-1, few).sum(axis=0, dtype=np.uint16)
            out[own] = np.minimum(out[own], np.minimum(folded[few], x).sum(axis=1, dtype=np.int64))
        return out


def _leaf_bounds(share: int, parts: int, best: bool):
    """Pairs of a guest and an owner of its group that can be linked by their places in the region,
    sizes and counts in slices. Two lone members meet as guest and owner of less and greater name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "na", "nb"]
        for rows, starts in _groups(batches, ["region", "own", "visit"]):
            node, n, at, component = (rows.column(x).to_numpy() for x in ("node", "n", "at", "component"))
            early, lone, owner, guest = (
                rows.column(x).to_numpy(zero_copy_only=False).astype(bool)
                for x in ("early", "lone", "owner", "guest")
            )
            slices = rows.column("slices").fill_null(b"").cast(pa.large_binary())
            offsets = np.frombuffer(slices.buffers()[1], np.int64)[slices.offset :][: len(slices) + 1]
            data = np.frombuffer(slices.buffers()[2] or b"", np.uint8)
            found = []
            for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
                own = start + np.flatnonzero(owner[start:end])
                counts = None
                for i in (start + np.flatnonzero(guest[start:end])).tolist():
                    most = np.minimum(n[own] - at[own], n[i] - at[i])
                    good = (component[own] != component[i]) & (early[own] | early[i])
                    good &= ~lone[own] | (node[own] > node[i])
                    good &= parts * most >= share * (n[own] + n[i] - most)
                    if not good.any():
                        continue
                    counts = counts or _Slices(data, offsets, own)
                    most = counts.bounds(data[offsets[i] : offsets[i + 1]], most)
                    good &= parts * most >= share * (n[own] + n[i] - most)
                    j = own[good]
                    if best and len(j):
                        j = j[[np.argmax(most[good] / (n[j] + n[i] - most[good]))]]
                    i = np.full(len(j), i)
                    less = node[i] < node[j]
                    a, b = np.where(less, i, j), np.where(less, j, i)
                    found.append(np.stack([node[a], node[b], n[a], n[b]]))
            if found:
                columns = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def _relabel(labels: DataFrame, near: DataFrame) -> DataFrame:
    """Every node's component anew, after links between nodes (a, b)."""
    ends = near.select("a", "b")
    if ends.isEmpty():
        return labels
    for end in ("a", "b"):
        named = labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
        ends = split_join(ends, named, [end], "inner")
    merged = components(ends.select(F.col("ca").alias("u"), F.col("cb").alias("v")))
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("into"))
    new = split_join(labels, merged, ["component"], "left")
    component = F.coalesce("into", "component").alias("component")
    return stored(new.select("node", component), "join-labels")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists, and where each list, none empty, starts."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(), np.cumsum(sizes) - sizes


def _block_links(share: int, parts: int):
    """Links of two blocks of a region (or within one) whose first common region it is."""

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        node = rows["node"].to_numpy()
        _, once = np.unique(node, return_index=True)
        rows = rows.take(pa.array(once)).combine_chunks()
        node, n, block = (rows[x].to_numpy() for x in ("node", "n", "block"))
        early = rows["early"].to_numpy(zero_copy_only=False).astype(bool)
        (hashes, first), (homes, home) = (
            _flat(rows[x].combine_chunks()) for x in ("shingles", "homes")
        )
        _, hashes = np.unique(hashes, return_inverse=True)
        names, homes = np.unique(homes, return_inverse=True)
        region = np.searchsorted(names, rows["region"][0].as_py()) if len(node) else 0
        within = rows["lo"][0].as_py() == rows["hi"][0].as_py() if len(node) else True
        marks = np.zeros(len(hashes) and hashes.max() + 1, bool)
        never = len(homes) + 1
        turn = np.full(len(names), never)
        found = []
        for i in np.flatnonzero(early):
            good = (n > n[i]) | ((n == n[i]) & (node > node[i]))
            good &= parts * n[i] >= share * n
            if not within:
                good &= block != block[i]
            if not good.any():
                continue
            own = homes[home[i] : home[i + 1] if i + 1 < len(home) else None]
            turn[own] = np.arange(len(own))
            good &= np.minimum.reduceat(turn[homes], home) == turn[region]
            turn[own] = never
            if not good.any():
                continue
            mine = hashes[first[i] : first[i] + n[i]]
            marks[mine] = True
            common = np.add.reduceat(marks[hashes], first, dtype=np.int64)
            marks[mine] = False
            hit = np.flatnonzero(good & (parts * common >= share * (n + n[i] - common)))
            found.append(np.stack([np.full(len(hit), node[i]), node[hit]]))
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.table({"a": a, "b": b})

    return work


def _all_links(ready: _Prepared, share: int, parts: int) -> DataFrame:
    """Every link (a, b) between two nodes, once.

    The smaller set of a link is early in the first region that both share; only there is the
    link taken. A region is cut into blocks and each pair of blocks is a group of its own, so a
    region of any size is spread over tasks; within one the sets are compared shingle by shingle.
    """
    regions = ready.regions
    sets = ready.whole(regions.select("node").distinct()).select("node", "shingles")
    homes = regions.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("at", "region")))["region"].alias("homes")
    )
    blocks = F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)
    )
    cut = regions.groupBy("region").agg(blocks.alias("blocks"))
    rows = split_join(regions.select("region", "node", "n", "early"), cut, ["region"], "inner")
    rows = split_join(split_join(rows, homes, ["node"], "inner"), sets, ["node"], "inner")
    block = F.pmod(F.xxhash64("region", "node"), "blocks")
    rows = rows.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    lo, hi = F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    rows = rows.select("region", lo, hi, "block", "node", "n", "early", "homes", "shingles")
    ship_code(rows.sparkSession)
    links = rows.groupBy("region", "lo", "hi").applyInArrow(
        _block_links(share, parts), "a long, b long"
    )
    return stored(links, "join-links")


def ngram_pairs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    share: int = SHARE,
    parts: int = PARTS,
) -> DataFrame:
    """Every link of :func:`ngram_join` between two different sets, once: ``a`` and ``b`` are the
    least doc_ids that have them, ``a <= b`` (equal only if one doc_id has both).

    These are as many rows as there are links, so a group of near copies has about the square of
    its size; exact copies add none.
    """
    ready = _prepare(docs, doc_id, text, size, share, parts)
    links = _all_links(ready, share, parts)
    for x in "ab":
        names = ready.classes.select(F.col("node").alias(x), F.col("doc_id").alias(f"id{x}"))
        links = split_join(links, names, [x], "inner")
    return links.select(F.least("ida", "idb").alias("a"), F.greatest("ida", "idb").alias("b"))


def ngram_links(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    share: int = SHARE,
    parts: int = PARTS,
) -> DataFrame:
    """``doc_id`` and ``n_links`` of every row of ``docs``: how many other rows it is linked to,
    copies included, by the links of :func:`ngram_join`. Rows without shingles or a doc_id have 0.
    """
    ready = _prepare(docs, doc_id, text, size, share, parts)
    links = _all_links(ready, share, parts)
    copies = stored(ready.with_id.groupBy("node").agg(F.count(F.lit(1)).alias("copies")), "join-copies")
    both = links.union(links.select("b", "a")).toDF("node", "other")
    others = copies.withColumnRenamed("node", "other")
    near = split_join(both, others, ["other"], "inner").groupBy("node").agg(F.sum("copies").alias("near"))
    counts = split_join(copies, near, ["node"], "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links")
    )
    linked = split_join(ready.with_id.select("doc_id", "node"), counts, ["node"], "inner")
    alone = ready.described.where("doc_id IS NULL OR n = 0")
    return linked.select("doc_id", "n_links").union(alone.select("doc_id", F.lit(0).cast("long")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those linked to a document of smaller id. Rows that share an
    id stay or go together, those without one stay."""
    joined = ngram_join(docs, doc_id, text, **options)
    gone = joined.where(F.col("doc_id") > F.col("component_id")).select(F.col("doc_id").alias("__gone"))
    gone = stored(gone.distinct(), "join-gone")
    return docs.join(gone, docs[doc_id] == gone["__gone"], "left_anti")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op1_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_links(table(spark, sf_dir, "documents"))
