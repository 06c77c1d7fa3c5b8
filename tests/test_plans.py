"""The shape of physical plans: what is pushed down, what is shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from silverloom.functions import parse_objects
from silverloom.operators import (
    Update,
    cascade_delete,
    fk_orphans,
    length_violations,
    merge,
    scd2_apply,
    scd2_chain,
)
from silverloom.plans import actor_topk, build_silver
from silverloom.session import spread_small
from silverloom.sources import land_bronze
from silverloom.workloads import all_queries
from silverloom.workloads.inputs import bronze_credits, bronze_movies, table

SF = "/root/testdata/sf0.001"
EAGER = {
    "profile",
    "profile_content",
    "query_suite",
    "load_report",
    "load_in_order",
    "silver_load",
    "target_checks",
    "target_checks_strict",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lazy_plans(spark):
    names = [n for n in all_queries() if n not in EAGER]
    return {n: plan(all_queries()[n](spark, SF)) for n in names}


def test_no_python_and_no_cross_joins(lazy_plans):
    for name, text in lazy_plans.items():
        assert not re.search(r"Python|ArrowEval|InPandas", text), name
        assert not re.search(r"CartesianProduct|NestedLoopJoin", text), name


@pytest.fixture(scope="module")
def landed_silver(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    credits = land_bronze(bronze_credits(spark, SF), str(root / "credits"))
    movies = land_bronze(bronze_movies(spark, SF), str(root / "movies"))
    return build_silver(credits, movies)


def test_silver_builders_are_one_narrow_stage(landed_silver):
    for name, df in landed_silver.items():
        text = plan(df)
        assert "Exchange" not in text, name
        assert text.count("from_json") <= 1, name


def test_builders_read_their_own_columns(landed_silver):
    assert "ReadSchema: struct<id:string,genres:string>" in plan(landed_silver["genres"])
    assert "ReadSchema: struct<movie_id:string,title:string,crew:string>" in plan(
        landed_silver["crew"]
    )


def test_only_small_tables_are_dealt_out(spark):
    small = table(spark, SF, "orders")
    assert spread_small(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert "RoundRobinPartitioning" in plan(spread_small(small))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert "Exchange" not in plan(spread_small(table(spark, SF, "orders")))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ordinary_teams_need_no_three_way_expansion(spark):
    text = plan(all_queries()["team_consistency"](spark, SF))
    assert "Expand" not in text


def test_name_test_reaches_the_scan(spark):
    movies = table(spark, SF, "orders").withColumnRenamed("o_custkey", "movie_id")
    cast = table(spark, SF, "customer").withColumnRenamed("c_custkey", "movie_id")
    text = plan(
        actor_topk(movies, cast, "12", title="o_orderkey", revenue="o_totalprice", name="c_name")
    )
    assert "StringContains(c_name,12)" in text
    assert "TakeOrderedAndProject" in text


def test_small_source_leaves_the_target_in_place(spark):
    target = table(spark, SF, "orders").select("o_orderkey", "o_totalprice")
    source = target.limit(5).withColumn("o_totalprice", target.o_totalprice * 2)
    merged = merge(target, source, "o_orderkey", not_matched=[], check_ambiguous=False)
    text = plan(merged)
    assert "BroadcastHashJoin" in text and "LeftOuter" in text
    assert "hashpartitioning" not in text
    # The check shuffles counted keys only, and of the target those that the source has.
    checked = plan(merge(target, source, "o_orderkey", not_matched=[]))
    assert "SortMergeJoin" not in checked
    for below in checked.split("Exchange hashpartitioning")[1:]:
        assert "HashAggregate" in below.split("\n")[1]


def test_large_source_reuses_the_key_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target, source = table(spark, SF, "customer"), table(spark, SF, "customer")
        text = plan(merge(target, source, "c_custkey"))
        lone = plan(merge(target, source, "c_custkey", check_ambiguous=False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FullOuter" not in text
    # Distinct keys of both sides meet without a further exchange; so do the source's counts.
    semi = lone[lone.index("LeftSemi") :]
    assert semi.count("Exchange hashpartitioning(c_custkey") == 2
    assert text.count("Exchange ") == lone.count("Exchange ") + 1


def test_merge_and_scd2_run_no_job_when_called(spark):
    target = table(spark, SF, "customer").selectExpr("c_custkey AS k", "c_name AS v", "true AS is_current", "'1' AS valid_from", "'' AS valid_to")
    source = target.drop("is_current", "valid_to")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("built"))
    spark.sparkContext.setJobGroup("built", "plans only")
    try:
        merge(target.select("k", "v"), source.select("k", "v"), "k", matched=[Update(None, "s.v > t.v")])
        merged = merge(target.select("k", "v"), source.select("k", "v"), "k")
        scd2_apply(target, source, "k", ["v"])
        scd2_chain(target, source, "k", ["v"])
        assert jobs() == 0
        merged.count()
        assert jobs() > 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture
def everything_is_large(spark):
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key in SKEW:
        spark.conf.unset(key)


def finished(df):
    df.collect()
    return plan(df)


def hot_table(spark):
    """A key that holds a third of 120,000 rows, in many map tasks."""
    return spark.range(0, 120_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )


def test_a_hot_key_is_split(spark, everything_is_large):
    hot = hot_table(spark)
    others = spark.range(0, 100_000, 1, 4).selectExpr("id AS k", "id AS v")
    unique = others.groupBy("k").agg(F.max("v").alias("v"))
    few_left = others.where("k > 200")

    assert "skew=true" in finished(fk_orphans(hot, others, ["k"]))
    assert "skew=true" in finished(cascade_delete(others, "k", "v > 9", {"c": (hot, "k")})[1]["c"])
    updated = merge(hot, unique, "k", not_matched=[])
    assert "skew=true" in finished(updated)
    assert updated.count() == 120_000
    inserted = merge(few_left, hot, "k", matched=[])
    assert "skew=true" in finished(inserted)
    assert inserted.where("k = 7").count() == 40_001


def test_row_checks_do_not_shuffle(spark):
    text = plan(length_violations(table(spark, SF, "part"), {"p_name": 5}, ["p_partkey"]))
    assert "Exchange" not in text


def test_only_wanted_fields_are_parsed(spark):
    df = spark.createDataFrame([("[]",)], "c string").select(parse_objects("c", ["id"]).alias("o"))
    assert "StructField(id,StringType,true)),true)" in plan(df)


def test_silver_teams_parse_the_cells_once(spark):
    """The question reads the crew several times; its plan reads stored rows."""
    assert "from_json" not in plan(all_queries()["silver_team_consistency"](spark, SF))
