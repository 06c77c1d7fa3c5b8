import pytest
from pyspark.sql import functions as F

from silverloom.schemas import BRONZE_COLUMNS
from silverloom.sources import read_table
from silverloom.streaming import ingest_absent, ingest_table
from silverloom.streaming.ingest import BUCKET, _bucketed, touched_part

HEADER = ",".join(BRONZE_COLUMNS["movies"]) + "\n"


def movie(i, genres):
    cells = [str(i), f"T{i}", "1", "", "en", "", '"two\nlines"', "1.5", "2001-01-01", "5"]
    cells += ["90.0", "", "", "7", "3", '"' + genres.replace('"', '""') + '"', "", "", "", ""]
    return ",".join(cells) + "\n"


def test_new_files_only(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    cell = '[{"id": 1, "name": "a"}, {"name": "b"}]'
    (source / "movies_part_001.csv").write_text(HEADER + movie(1, cell) + movie(2, "[]"))
    ingest_table(spark, str(source), "genres", target, state)
    assert read_table(spark, target).count() == 2
    ingest_table(spark, str(source), "genres", target, state)
    assert read_table(spark, target).count() == 2
    (source / "movies_part_002.csv").write_text(HEADER + movie(3, cell))
    (source / "movies_part_003.csv").write_text(HEADER + movie(4, "bad"))
    ingest_table(spark, str(source), "genres", target, state, files_per_batch=1)
    got = sorted(tuple(r) for r in read_table(spark, target).collect())
    assert got == [("1", -9999, "b"), ("1", 1, "a"), ("3", -9999, "b"), ("3", 1, "a")]


def test_movies_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text(HEADER + movie(1, "[]"))
    ingest_table(spark, str(source), "movies", str(tmp_path / "out"), str(tmp_path / "state"))
    row = read_table(spark, str(tmp_path / "out")).first()
    assert (row.runtime, row.overview) == (90, "two\nlines")


def test_insert_absent_over_batches(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k int, v string, pos int"
    for batch in ([(1, "a", 2), (1, "b", 1), (2, "c", 1)], [(2, "late", 0), (3, "d", 1)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        ingest_absent(stream, target, "k", ["pos"], str(tmp_path / "state"))
    got = sorted(tuple(r) for r in read_table(spark, target).collect())
    assert got == [(1, "b", 1), (2, "c", 1), (3, "d", 1)]

    # The same files under a new state: every key is present, nothing is added.
    again = spark.readStream.schema(schema).parquet(source)
    ingest_absent(again, target, "k", ["pos"], str(tmp_path / "state2"))
    assert read_table(spark, target).agg(F.count("*")).first()[0] == 3


def test_a_batch_reads_its_own_buckets(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(5000).selectExpr("id AS k", "concat('v', id) AS v", "1 AS pos")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    ingest_absent(stream, target, "k", ["pos"], str(tmp_path / "state"), buckets=32)
    assert read_table(spark, target).count() == 5000
    batch = _bucketed(rows.where("k IN (7, 9)"), ["k"], 32)
    part = touched_part(spark, target, batch)
    text = part._jdf.queryExecution().executedPlan().toString()
    assert f"{BUCKET}" in text[text.index("PartitionFilters: [") :].split("]")[0]
    assert 2 <= part.count() < 1000
    scanned = {r[0] for r in part.select(F.input_file_name()).distinct().collect()}
    assert all(any(f"{BUCKET}={b[0]}/" in f for b in batch.select(BUCKET).collect()) for f in scanned)

    # A plain target is not taken for a bucketed one.
    rows.write.parquet(str(tmp_path / "plain"))
    again = spark.readStream.schema(rows.schema).parquet(source)
    with pytest.raises(ValueError, match="no buckets"):
        ingest_absent(again, str(tmp_path / "plain"), "k", ["pos"], str(tmp_path / "s2"), buckets=32)


def test_insert_absent_into_buckets_over_batches(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k int, j string, v string, pos int"
    batches = [
        [(1, "x", "a", 2), (1, "x", "b", 1), (2, "x", "c", 1), (None, "x", "n", 0)],
        [(2, "x", "late", 0), (2, "y", "new", 0), (3, "x", "d", 1)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        ingest_absent(stream, target, ["k", "j"], ["pos"], str(tmp_path / "state"), buckets=3)
    got = sorted(tuple(r) for r in read_table(spark, target).drop(BUCKET).collect())
    assert got == [(1, "x", "b", 1), (2, "x", "c", 1), (2, "y", "new", 0), (3, "x", "d", 1)]
