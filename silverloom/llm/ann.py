"""Approximate nearest neighbours: multi-index hashing over learned rotated binary codes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverloom.llm.common import ship_code, stored, table
from silverloom.session import scratch_path

#: The codes: bits in all, and of a substring that is indexed.
BITS = 128
SUBSTRING = 16
#: Rows from which rotations and radius are learned, at most.
SAMPLE = 20_000
#: Sample rows used as queries to learn the radius, and the share of their neighbours' codes
#: that it covers.
TRIALS = 300
COVER = 0.97
#: Rows of an index block, and query vectors searched for in one pass over the index.
BLOCK = 16_384
QUERIES = 4096

_ONES = np.array([i.bit_count() for i in range(1 << SUBSTRING)], np.uint8)
_BLOCK_SCHEMA = "n int, ids binary, vectors binary, codes binary, keys binary, places binary"


@dataclass(frozen=True)
class Model:
    """``codes`` = signs of ``(x - mean) @ axes``; every code within ``radius`` is retrieved."""

    mean: np.ndarray
    axes: np.ndarray
    radius: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One row of 16-bit substrings per vector."""
        signs = (vectors - self.mean) @ self.axes > 0
        return np.packbits(signs, axis=1, bitorder="little").view("<u2")


def fit(sample: np.ndarray, k: int, seed: int = 0) -> Model:
    """Principal axes, turned so that the signs lose least (alternating between the nearest
    corners and the best rotation to them); as many such rotations as the bits take.

    The radius covers most neighbours within the sample. In more rows neighbours are nearer, so
    it errs towards more candidates.
    """
    rng = np.random.default_rng(seed)
    n, d = sample.shape
    mean = sample.mean(0) if n else np.zeros(d)
    centred = sample - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / max(n, 1))
    main = vectors[:, ::-1][:, : min(d, BITS)]
    reduced = centred @ main
    axes = []
    for _ in range(-(-BITS // main.shape[1])):
        turn = np.linalg.qr(rng.normal(size=(main.shape[1],) * 2))[0]
        for _ in range(30 if n > main.shape[1] else 0):
            corners = np.where(reduced @ turn > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(corners.T @ reduced)
            turn = (left @ right).T
        axes.append(main @ turn)
    model = Model(mean, np.hstack(axes)[:, :BITS], BITS)
    trials = sample[:TRIALS]
    if n <= k + 1:
        return model
    squares = (sample**2).sum(1)
    far = squares[None] - 2 * trials @ sample.T
    far[np.arange(len(trials)), np.arange(len(trials))] = np.inf
    near = np.argpartition(far, k, axis=1)[:, :k]
    codes = model.codes(sample)
    apart = _ONES[codes[: len(trials), None] ^ codes[near]].sum(-1, dtype=np.int64)
    return Model(mean, model.axes, int(np.quantile(apart, COVER, method="higher")))


def usable(vector: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def build_index(rows: DataFrame, model: Model, path: str) -> DataFrame:
    """Store rows of (id, vector) as blocks: ids, vectors, codes, and for each substring of the
    code its distinct values in the block with the rows that have them."""
    ship_code(rows.sparkSession)

    def pack(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        codes = model.codes(vectors.astype("<f8"))
        keys, places = [], []
        for column in codes.T:
            distinct, place = np.unique(column, return_inverse=True)
            keys.append(distinct.astype("<u2").tobytes())
            places.append(place.astype("<u2").tobytes())
        sizes = np.array([len(x) for x in keys], "<u4").tobytes()
        row = {"n": len(ids), "ids": ids.astype("<i8").tobytes(), "vectors": vectors.tobytes()}
        row |= {"codes": codes.tobytes(), "keys": sizes + b"".join(keys), "places": b"".join(places)}
        types = [("n", pa.int32()), *((c, pa.binary()) for c in list(row)[1:])]
        return pa.RecordBatch.from_pylist([row], pa.schema(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []
        for batch in batches:
            ids.append(batch.column("id").to_numpy(zero_copy_only=False))
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            vectors.append(flat.reshape(len(ids[-1]), -1).astype("<f8"))
            if sum(map(len, ids)) >= BLOCK:
                all_ids, all_vectors = np.concatenate(ids), np.concatenate(vectors)
                for i in range(0, len(all_ids), BLOCK):
                    yield pack(all_ids[i : i + BLOCK], all_vectors[i : i + BLOCK])
                ids, vectors = [], []
        if sum(map(len, ids)):
            yield pack(np.concatenate(ids), np.concatenate(vectors))

    return stored(rows.select("id", "vector").mapInArrow(run, _BLOCK_SCHEMA), "ann-index", path)


def _hits(block: dict, codes: np.ndarray, radius: int) -> Iterator[np.ndarray]:
    """For each code, the rows of a block whose code differs in ``radius`` bits at most.

    By the pigeonhole principle such a row has a substring that differs in its share of the
    radius at most, so only rows under those values of a substring are compared in full.
    """
    parts = BITS // SUBSTRING
    own = np.frombuffer(block["codes"], "<u2").reshape(block["n"], parts)
    sizes = np.frombuffer(block["keys"], "<u4", parts)
    keys = np.split(np.frombuffer(block["keys"], "<u2", offset=4 * parts), np.cumsum(sizes // 2)[:-1])
    places = np.frombuffer(block["places"], "<u2").reshape(parts, block["n"])
    for code in codes:
        found = np.zeros(block["n"], bool)
        for key, place, part in zip(keys, places, code):
            near = _ONES[key ^ part] <= radius // parts
            if near.any():
                found |= near[place]
        rows = np.flatnonzero(found)
        apart = _ONES[own[rows] ^ code].sum(1, dtype=np.int64)
        yield rows[apart <= radius]


def search(
    index: DataFrame, ids: np.ndarray, vectors: np.ndarray, model: Model, radius: int, k: int
) -> DataFrame:
    """(query, id, score): the ``k`` nearest of each task's rows within the radius, by distance
    and then id. The queries are a bounded batch and travel with the task."""
    codes = model.codes(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_far = np.full((len(ids), k), np.inf)
        best_id = np.full((len(ids), k), np.iinfo(np.int64).max)
        for batch in batches:
            for block in batch.to_pylist():
                own_ids = np.frombuffer(block["ids"], "<i8")
                own = np.frombuffer(block["vectors"], "<f8").reshape(block["n"], -1)
                for q, rows in enumerate(_hits(block, codes, radius)):
                    far = np.sqrt(((own[rows] - vectors[q]) ** 2).sum(1))
                    keep = np.flatnonzero(far <= best_far[q, -1])
                    if len(keep):
                        far = np.concatenate([best_far[q], far[keep]])
                        who = np.concatenate([best_id[q], own_ids[rows[keep]]])
                        first = np.lexsort((who, far))[:k]
                        best_far[q], best_id[q] = far[first], who[first]
        q, place = np.nonzero(np.isfinite(best_far))
        columns = [pa.array(ids[q]), pa.array(best_id[q, place]), pa.array(best_far[q, place])]
        yield pa.RecordBatch.from_arrays(columns, ["query", "id", "score"])

    return index.mapInArrow(run, "query long, id long, score double")


def _batches(rows: Iterable, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield np.array([r[0] for r in held]), np.array([r[1] for r in held], np.float64)
            held = []
    if held:
        yield np.array([r[0] for r in held]), np.array([r[1] for r in held], np.float64)


def nearest(
    df: DataFrame,
    queries: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scratch: str | None = None,
) -> DataFrame:
    """The ``k`` nearest other rows of each row that ``queries`` selects: ``query_id``, ``rank``
    (int, from 1), ``vec_id``, ``score`` (Euclidean distance in double precision).

    Vectors that are null, zero, not finite, or of another length than most take no part; nor do
    rows without an id. Ties go to the smaller id. Of equal vectors only the ``k + 1`` rows with
    the least ids can ever be answers, so no more are indexed, and equal queries are searched for
    once; a vector that a third of the rows share is thereby cut down before it is shuffled.
    Repeated (id, vector) rows count once. The index is stored in blocks that hold every
    such row; rotations, and the radius, are learned from at most 20,000 of them. Queries pass
    over the index in batches of 4,096, which the driver streams: no two tables are crossed and
    nothing grows with the data but the number of passes. Queries with fewer than ``k`` rows
    inside the radius are searched for again without one.
    """
    spark = df.sparkSession
    root = scratch or scratch_path(spark, "ann")
    rows = (
        df.select(
            F.col(vec_id).cast("long").alias("id"),
            F.col(vector).cast("array<double>").alias("vector"),
            F.coalesce(queries, F.lit(False)).alias("asks"),
        )
        .where(F.col("id").isNotNull() & usable(F.col("vector")))
    )
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), "d").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == usual["d"])

    same = Window.partitionBy("vector").orderBy("id")
    least = rows.select("id", "vector").dropDuplicates(["id", "vector"])
    least = least.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1)
    least = stored(least, "ann-rows", f"{root}/rows")
    count = least.count()
    share = min(1 << 30, (1 << 30) * SAMPLE * 9 // (10 * count) if count > SAMPLE else 1 << 30)
    drawn = least.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share).limit(SAMPLE)
    drawn = sorted(drawn.select("id", "vector").collect())
    sample = np.array([r["vector"] for r in drawn], np.float64).reshape(-1, usual["d"])
    order = np.random.default_rng(0).permutation(len(sample))
    model = fit(sample[order], k)
    index = build_index(least, model, f"{root}/index")

    asked = rows.where("asks").select("id", "vector").dropDuplicates(["id", "vector"])
    named = asked.withColumn("query", F.min("id").over(Window.partitionBy("vector")))
    named = stored(named, "ann-queries", f"{root}/queries")
    distinct = named.where("id = query").select("query", "vector")

    best = Window.partitionBy("query").orderBy("score", "id")
    found, done = f"{root}/found", 0

    def answer(batch: tuple[np.ndarray, np.ndarray], radius: int) -> None:
        hits = search(index, *batch, model, radius, k + 1)
        hits = hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
        hits.write.mode("append").parquet(f"{found}/radius={radius}")

    schema = "query long, id long, score double, place int"
    for batch in _batches(distinct.toLocalIterator(), QUERIES):
        answer(batch, model.radius)
        done += 1
    if not done:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    answers = spark.read.schema(schema).parquet(f"{found}/radius={model.radius}")
    full = answers.groupBy("query").count().where(F.col("count") > k).select("query")
    if model.radius < BITS and count > k:
        short = distinct.join(full, "query", "left_anti")
        again = 0
        for batch in _batches(short.toLocalIterator(), QUERIES):
            answer(batch, BITS)
            again += 1
        if again:
            more = spark.read.schema(schema).parquet(f"{found}/radius={BITS}")
            answers = answers.join(full, "query", "left_semi").unionByName(more)

    per_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        named.select(F.col("id").alias("query_id"), "query")
        .join(answers, "query")
        .where(F.col("id") != F.col("query_id"))
        .select("query_id", F.col("id").alias("vec_id"), "score")
        .withColumn("rank", F.row_number().over(per_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("vec_id") % 100 == 0)
