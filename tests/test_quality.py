import json

from pyspark.sql import functions as F

from silverloom.operators import (
    conform,
    conform_report,
    fk_orphans,
    length_violations,
    pk_violations,
    profile,
    row_counts,
    run_suite,
)
from silverloom.plans import check_targets
from silverloom.plans.targets import _measures
from silverloom.schemas import DATE, INT, MOVIES, STRICT_TARGETS, STRING, TARGETS, struct

KV = "k int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pk_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, None), (2, None)], KV)
    assert rows(pk_violations(df, ["k", "v"])) == sorted(
        [(1, "a", "duplicate", 2), (None, "c", "null", 1), (2, None, "null", 2)], key=repr
    )
    assert pk_violations(spark.createDataFrame([(1, "a"), (2, "a")], KV), ["k"]).isEmpty()


def test_sentinels_collide(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], KV).fillna({"v": "0000000000"})
    assert rows(pk_violations(df, ["v"])) == [("0000000000", "duplicate", 2)]


def test_fk_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (9, "b"), (None, "c"), (9, "d")], KV)
    parent = spark.createDataFrame([(1, "p"), (1, "p"), (None, "q")], KV)
    assert rows(fk_orphans(child, parent, ["k"])) == [(9, "b"), (9, "d")]
    two = fk_orphans(child, parent.toDF("pk", "pv"), {"k": "pk", "v": "pv"})
    assert rows(two) == [(1, "a"), (9, "b"), (9, "d")]


def test_length_violations_count_characters(spark):
    df = spark.createDataFrame([(1, "güneş"), (2, "abc"), (3, None), (4, "toolong")], KV)
    assert rows(length_violations(df, {"v": 5}, ["k"])) == [(4, "v", 5, 7)]
    assert rows(length_violations(df, {"v": 2})) == [("v", 2, 3), ("v", 2, 5), ("v", 2, 7)]


def test_conform_and_report(spark):
    df = spark.createDataFrame(
        [("1", "2001-01-01", "x"), ("a", "never", None), (None, None, "y")], "i string, d string, t string"
    )
    schema = struct(d=DATE, i=INT, t=STRING)
    got = conform(df, schema)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schema]
    assert [(r.i, r.t) for r in got.collect()] == [(1, "x"), (None, None), (None, "y")]
    assert [tuple(r) for r in conform_report(df, schema).collect()] == [
        ("d", "string", "date", 2, 1),
        ("i", "string", "int", 2, 1),
        ("t", "string", "string", 2, 0),
    ]


def test_row_counts(spark):
    got = row_counts({"b": spark.range(3), "a": spark.range(0), "c": spark.range(5)})
    assert [tuple(r) for r in got.collect()] == [("a", 0), ("b", 3), ("c", 5)]


def test_profile_isolates_failures(spark):
    bad = spark.range(5).selectExpr("raise_error('late') AS x")
    report = profile(
        spark,
        {
            "good": spark.range(7),
            "absent": lambda: spark.read.parquet("/no/such/path"),
            "late": bad,
        },
    )
    found = {r.table_name: r for r in report.collect()}
    assert (found["good"].status, found["good"].row_count) == ("success", 7)
    assert len(json.loads(found["good"].sample)) == 5
    assert found["good"].table_schema == "struct<id:bigint>"
    assert found["absent"].status == "error"
    assert "PATH_NOT_FOUND" in found["absent"].error
    assert found["late"].status == "error"


def test_check_targets(spark):
    movies = spark.createDataFrame([("1",), ("2",), ("x",)], "movie_id string").select(
        "movie_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in MOVIES.fields[1:]]
    )
    genres = spark.createDataFrame(
        [("1", -9999, "a"), ("1", -9999, "b"), ("9", 1, "c" * 101), (None, 1, "d")],
        "movie_id string, id int, name string",
    )
    report = check_targets({"movies": movies, "genres": genres}).collect()
    got = {(r.table_name, r.rule): r.violations for r in report}
    assert got == {
        ("movies", "type"): 1,
        ("movies", "primary key"): 1,
        ("movies", "length"): 0,
        ("genres", "type"): 0,
        ("genres", "primary key"): 2,
        ("genres", "foreign key"): 1,
        ("genres", "length"): 1,
    }


def test_target_keys_that_look_alike(spark):
    """Keys of several parts, a missing part against an empty one, a parent given twice."""
    movies = spark.createDataFrame([("1",), ("1",), (None,)], "movie_id string").select(
        "movie_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in MOVIES.fields[1:]]
    )
    countries = spark.createDataFrame(
        [("1", "TR", "a"), ("1", "", "b"), ("1", None, "c"), ("12", "TR", "d"), ("2", "TR", "e"), ("2", "TR", "f")],
        "movie_id string, iso_3166_1 string, name string",
    )
    report = check_targets({"production_countries": countries, "movies": movies}).collect()
    got = {(r.table_name, r.rule): r.violations for r in report}
    assert got[("production_countries", "primary key")] == 2
    assert got[("production_countries", "foreign key")] == 3
    assert got[("movies", "primary key")] == 2
    alone = check_targets({"production_countries": countries.limit(0)}, STRICT_TARGETS).collect()
    assert {(r.rule, r.violations) for r in alone} == {("type", 0), ("primary key", 0), ("length", 0)}


def test_tables_are_scanned_once(spark, tmp_path):
    path = str(tmp_path / "genres")
    spark.createDataFrame([("1", 1, "a")], "movie_id string, id int, name string").write.parquet(path)
    plan = check_targets({"genres": spark.read.parquet(path)})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_run_suite(spark):
    report = run_suite(
        spark, {"dates": "SELECT DATE'2001-01-01' AS d", "bad": "SELEC", "long": "SELECT * FROM range(50)"}
    )
    found = {r["query"]: r for r in report.collect()}
    assert json.loads(found["dates"].result) == [{"d": "2001-01-01"}]
    assert (found["bad"].status, found["bad"].result) == ("error", None)
    assert (found["long"].rows_shown, found["long"].truncated) == (20, True)
    assert (found["dates"].rows_shown, found["dates"].truncated) == (1, False)


def test_check_targets_sends_two_rows_for_one(spark):
    """A row's own counts travel with its key: beside that there is its reference or, of a parent,
    the key that others refer to."""
    target = TARGETS["movies"]
    movies = spark.range(10).select(*[F.lit("1").alias(n) for n in target.schema.names])
    assert _measures(movies, "movies", target, True).count() == 20
    assert _measures(movies, "movies", target, False).count() == 10
