"""Periodic runs of words: recompression into a run-length grammar, whose longest common
extensions grow candidates from a harmonic grid to their exact ends."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.common import append_columns, table, words

#: A run repeats its period at least so often, and has at least so many words.
EXPONENT, SHORTEST = 4, 6
#: Bytes of text whose words are held and compressed together in a task.
_GROUP = 2 << 20

Run = tuple[int, int, int]  # start, length, period


def _mixed(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A bit of each symbol that differs from turn to turn."""
    x = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64((0xBF58476D1CE4E5B9 + 2 * turn * 0x9FB21C651E98DF25) & (1 << 64) - 1)
    return (x >> np.uint64(63)).astype(bool)


class RunLengthGrammar:
    """A sequence compressed level by level until no symbol of a level occurs twice.

    A level either puts every run of a symbol into one (block compression), or every symbol of
    a left class with a following one of a right class (pair compression). Either looks at the
    symbols alone, so equal stretches are compressed alike but for their ends, and two places
    can be compared from the top: large symbols that are equal are passed in one step.
    """

    def __init__(self, sequence: np.ndarray):
        symbols = np.asarray(sequence, np.int64)
        self._symbols = [memoryview(symbols)]
        self._first: list[memoryview] = [memoryview(symbols[:0])]  # of a symbol's children
        self._parent: list[memoryview] = []
        self._is_block = [False]
        fresh = int(symbols.max()) + 1 if len(symbols) else 0
        turn = block = 0
        while len(np.unique(symbols)) < len(symbols):
            block = not block
            heads = self._blocks(symbols) if block else self._pairs(symbols, turn)
            turn += 1
            if len(heads) == len(symbols):
                continue
            first = np.append(heads, len(symbols)).astype(np.int64)
            sizes = np.diff(first)
            joined = np.flatnonzero(sizes > 1)
            tail = sizes[joined] if block else symbols[heads[joined] + 1]
            pairs = symbols[heads[joined]] * np.int64(max(fresh, len(symbols)) + 1) + tail
            known, names = np.unique(pairs, return_inverse=True)
            parent = np.repeat(np.arange(len(heads)), sizes).astype(np.int64)
            symbols = symbols[heads]
            symbols[joined] = fresh + names
            fresh += len(known)
            self._symbols.append(memoryview(symbols))
            self._first.append(memoryview(first))
            self._parent.append(memoryview(parent))
            self._is_block.append(block)

    @staticmethod
    def _blocks(symbols: np.ndarray) -> np.ndarray:
        return np.append(0, np.flatnonzero(symbols[1:] != symbols[:-1]) + 1)

    @staticmethod
    def _pairs(symbols: np.ndarray, turn: int) -> np.ndarray:
        right = _mixed(symbols, turn)
        second = np.flatnonzero(~right[:-1] & right[1:]) + 1
        heads = np.ones(len(symbols), bool)
        heads[second] = False
        return np.flatnonzero(heads)

    def forward(self, x: int, y: int) -> int:
        """How many symbols from x on equal those from y on (x < y)."""
        start, level, rising = x, 0, True
        while True:
            symbols = self._symbols[level]
            if y < len(symbols) and symbols[x] == symbols[y]:
                if level < len(self._parent):
                    first = self._first[level + 1]
                    p, q = self._parent[level][x], self._parent[level][y]
                    if rising and first[p] == x and first[q] == y:
                        above = self._symbols[level + 1]
                        if above[p] == above[q]:
                            x, y, level = p, q, level + 1
                            continue
                    if self._is_block[level + 1]:
                        size = min(first[p + 1] - x, first[q + 1] - y)
                        x, y = x + size, y + size
                        continue
                x, y = x + 1, y + 1
            elif level:
                first, rising = self._first[level], False
                x, y, level = first[x], first[y], level - 1
            else:
                return x - start

    def backward(self, x: int, y: int) -> int:
        """How many symbols before x equal those before y (x < y)."""
        start, level, rising = x, 0, True
        x, y = x - 1, y - 1
        while True:
            symbols = self._symbols[level]
            if x >= 0 and symbols[x] == symbols[y]:
                if level < len(self._parent):
                    first = self._first[level + 1]
                    p, q = self._parent[level][x], self._parent[level][y]
                    if rising and first[p + 1] == x + 1 and first[q + 1] == y + 1:
                        above = self._symbols[level + 1]
                        if above[p] == above[q]:
                            x, y, level = p, q, level + 1
                            continue
                    if self._is_block[level + 1]:
                        size = min(x - first[p], y - first[q]) + 1
                        x, y = x - size, y - size
                        continue
                x, y = x - 1, y - 1
            elif level:
                first, rising = self._first[level], False
                x, y, level = first[x + 1] - 1, first[y + 1] - 1, level - 1
            else:
                return start - 1 - x


def find_runs(
    sequence: np.ndarray, longest: int, exponent: int = EXPONENT, shortest: int = SHORTEST
) -> list[Run]:
    """All maximal runs of at least ``max(shortest, exponent * period)`` symbols, by start and
    period, with their smallest period; no run has more than ``longest`` symbols.

    A run of period p holds ``exponent - 1`` neighbouring multiples of p whose symbols recur p
    places on. All such places are found by comparing every p-th symbol, which for all p takes
    n log n comparisons; the grammar then gives the exact ends. Periods go up, so a stretch met
    again has been reported with its smallest one.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period")
    grammar, found = None, {}
    for period in range(1, longest // exponent + 1):
        grid = sequence[::period]
        same = grid[1:] == grid[:-1]
        hits = same[: len(same) - exponent + 2].copy()
        for k in range(1, exponent - 1):
            hits &= same[k : len(hits) + k]
        done = 0
        for at in (np.flatnonzero(hits) * period).tolist():
            if at < done:
                continue
            grammar = grammar or RunLengthGrammar(sequence)
            start = at - grammar.backward(at, at + period)
            end = at + period + grammar.forward(at, at + period)
            done = end - period
            if end - start >= max(shortest, exponent * period):
                found.setdefault((start, end), period)
    return sorted((start, end - start, period) for (start, end), period in found.items())


def _groups(sizes: Sequence[int]) -> Iterator[list[int]]:
    """Texts of similar size together, as the periods tried depend on the largest."""
    group, held, least = [], 0, 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__):
        if group and (held + sizes[i] > _GROUP or sizes[i] > 2 * least + 256):
            yield group
            group, held = [], 0
        if not group:
            least = sizes[i]
        group.append(i)
        held += sizes[i]
    if group:
        yield group


def runs_of(
    texts: Sequence[bytes], exponent: int = EXPONENT, shortest: int = SHORTEST
) -> list[tuple[int, list[Run], bytes]]:
    """Number of words, runs and collapsed text of each text, compressed as one sequence.

    Signs that occur once stand between the texts, so that no run crosses.
    """
    ids: dict[bytes, int] = {}
    split = [text.split() for text in texts]
    offsets, numbers = [], []
    for k, held in enumerate(split):
        offsets.append(len(numbers))
        numbers += [ids.setdefault(w, len(ids)) for w in held]
        numbers.append(-1 - k)
    sequence = np.array(numbers, np.int64) + len(split)
    longest = max(map(len, split), default=0)
    runs: list[list[Run]] = [[] for _ in split]
    for start, length, period in find_runs(sequence, longest, exponent, shortest):
        k = bisect_right(offsets, start) - 1
        runs[k].append((start - offsets[k], length, period))
    out = []
    for held, own in zip(split, runs):
        kept = held
        if own:
            drops = np.zeros(len(held) + 1, np.int64)
            for start, length, period in own:
                drops[start + period] += 1
                drops[start + length] -= 1
            kept = [held[i] for i in np.flatnonzero(np.cumsum(drops[:-1]) == 0).tolist()]
        out.append((len(held), own, b" ".join(kept)))
    return out


_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def collapse_runs(
    df: DataFrame,
    text: str = "text",
    exponent: int = EXPONENT,
    shortest: int = SHORTEST,
    n_words: str = "n_words",
    runs: str = "runs",
    collapsed: str = "collapsed",
) -> DataFrame:
    """Add a text's number of words, its periodic runs and the text without their repetitions.

    Words are what stands between ASCII white space. ``runs`` are all maximal runs by start and
    period; a word goes if a run contains it after that run's first period; the words left are
    joined by single blanks. Null and empty texts have no words and an empty collapsed text.
    Equal texts get equal results, rows are neither merged nor moved, and columns named like
    new ones are replaced. An empty table gives an empty one.

    Row-local, without a shuffle. A task holds one batch of texts and the words of about 2 MB of
    them, or of one longer text (some 100 bytes of memory per word).
    """
    new = {n_words: "bigint", runs: _RUNS, collapsed: "string"}
    if len(new) < 3:
        raise ValueError("the new columns need names of their own")
    named = ("start", "length", "period")
    triple = pa.list_(pa.struct([(c, pa.int64()) for c in named]))

    def work(texts: pa.Array) -> Iterator[tuple[Sequence[int], Sequence[pa.Array]]]:
        sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
        for group in _groups(sizes):
            held = texts.take(pa.array(group, pa.int64())).to_pylist()
            counts, found, left = zip(*runs_of([t or b"" for t in held], exponent, shortest))
            yield group, [
                pa.array(counts, pa.int64()),
                pa.array([[dict(zip(named, r)) for r in own] for own in found], triple),
                pa.array(left, pa.binary()).cast(pa.string()),
            ]

    return append_columns(df, text, new, work)


def _planted(text: Column, key: Column) -> Column:
    """Some texts, chosen by the key's checksum, turned periodic from some word on."""
    checksum = F.crc32(key.cast("string").cast("binary"))
    g, held = F.floor(checksum / 10).cast("long"), words(text)
    n = F.size(held)
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
    copies = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(held, a + 1, p), copies)), 1, n - a)
    periodic = F.array_join(F.concat(F.slice(held, 1, a), tail), " ")
    return F.when((checksum % 10 == 0) & (n > 0), periodic).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, some of them planted by doc_id (by none where it is null)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text", _planted(F.col("text"), F.col("doc_id")))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    longer = lambda a, r: r.length * a.period > a.length * r.period
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(longer(a, r), r).otherwise(a))
    found = collapse_runs(docs).drop("text").withColumn("best", best)
    milli = F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        milli.alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
