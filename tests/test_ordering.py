import random

import pytest
from pyspark.sql import functions as F

from silverloom.operators import assign_parts, top_k, union_all, with_position


def sizes(df, k):
    found = {r.part: r.n for r in df.groupBy("part").agg(F.count("*").alias("n")).collect()}
    return [found.get(i, 0) for i in range(1, k + 1)]


@pytest.mark.parametrize(
    "n, wanted", [(12, [2, 2, 2, 2, 4]), (3, [0, 0, 0, 0, 3]), (10, [2] * 5), (1, [0] * 4 + [1])]
)
def test_part_sizes(spark, n, wanted):
    assert sizes(assign_parts(spark.range(n), ["id"], 5, partitions=3), 5) == wanted


def test_no_rows(spark):
    assert assign_parts(spark.range(0), ["id"], 5).count() == 0


def test_positions_are_exact_whatever_the_partitioning(spark):
    values = [random.Random(5).randrange(40) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    for partitions in (1, 7, 64):
        got = with_position(df.repartition(5), ["v", "id"], partitions=partitions)
        order = [r.id for r in got.orderBy("position").collect()]
        assert order == [i for i, _ in sorted(enumerate(values), key=lambda x: (x[1], x[0]))]
        assert [r.position for r in got.orderBy("position").collect()] == list(range(500))


def test_positions_with_one_dominant_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    got = with_position(df, ["v"], partitions=16)
    assert sorted(r.position for r in got.collect()) == list(range(3000))
    hot = [r.position for r in got.where("v = 1").collect()]
    assert max(hot) - min(hot) == len(hot) - 1


def test_copies_of_one_row_are_cut_apart(spark):
    df = spark.range(0, 8000, 1, 16).select(F.lit(5).alias("v"), F.lit("copy").alias("w"))
    got = with_position(df, ["v"], partitions=8).cache()
    assert sorted(r.position for r in got.collect()) == list(range(8000))
    per_task = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task <= 4000


def test_descending_order_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id int, v int")
    got = with_position(df, [F.desc_nulls_last("v"), "id"])
    assert {r.id: r.position for r in got.collect()} == {3: 0, 2: 1, 1: 2}


def test_top_k_and_union(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9), (4, 9)], "id int, v int")
    assert [r.id for r in top_k(df, [F.desc_nulls_last("v"), "id"], 3).collect()] == [3, 4, 2]
    both = union_all([df, df.toDF("a", "b"), df])
    assert both.columns == ["id", "v"]
    assert both.count() == 12


def test_the_shuffle_is_as_wide_as_the_session(spark):
    """Whatever the optimizer thinks of the input's size: too much, or nothing."""
    one = spark.range(200).selectExpr("id AS a", "id % 5 AS b")
    wide = one.join(one.toDF("c", "b"), "b")
    for df in (one, wide, wide.join(one.toDF("d", "b"), "b")):
        small = with_position(df, df.columns)
        parts = small.select(F.spark_partition_id()).distinct().count()
        assert parts <= int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert small.count() == small.select("position").distinct().count() == df.count()
