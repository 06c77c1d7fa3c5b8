import random

import pytest
from pyspark.sql import functions as F

from silverloom.operators import (
    AmbiguousMerge,
    Insert,
    Update,
    absent_rows,
    cascade_delete,
    delete_where,
    fk_orphans,
    insert_if_absent,
    merge,
    update_where,
)

def mixed(spark, left, right):
    return spark.createDataFrame(left, "k int, v int"), spark.createDataFrame(right, "k bigint, v int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(df, wanted):
    assert rows(df) == sorted(wanted, key=repr)


STOCK = "item int, place string, pieces int"


def test_one_table_through_its_life(spark):
    """Load, repeat the load, take a delivery of which only some lines count, correct, clear."""
    stock = spark.createDataFrame([(1, "cellar", 4), (2, "attic", 9), (3, "attic", 0)], STOCK)
    count = spark.createDataFrame([(2, "attic", 7), (3, "shed", 1), (4, "shed", 6)], STOCK)
    counted = [(1, "cellar", 4), (2, "attic", 7), (3, "shed", 1), (4, "shed", 6)]
    once = merge(stock, count, "item")
    same(once, counted)
    same(merge(once, count, "item"), counted)

    # Lines with pieces meet their item; the empty line meets nothing and is added beside it.
    delivery = spark.createDataFrame([(1, "porch", 5), (4, "porch", 0), (9, "porch", 2)], STOCK)
    received = merge(
        once,
        delivery,
        "item",
        source_condition="line.pieces > 0",
        matched=[Update({"pieces": "here.pieces + line.pieces"})],
        target_alias="here",
        source_alias="line",
    )
    same(
        received,
        [(1, "cellar", 9), *counted[1:], (4, "porch", 0), (9, "porch", 2)],
    )

    moved = update_where(received, "place = 'attic'", {"place": F.lit("loft"), "pieces": "pieces - 1"})
    assert tuple(moved.where("item = 2").first()) == (2, "loft", 6)
    assert moved.where("place = 'attic'").isEmpty()
    same(delete_where(moved, F.col("pieces") == 0), [r for r in rows(moved) if r[2]])


def test_keys_of_different_types_meet(spark):
    t, s = mixed(spark, [(1, 1), (2, 2), (None, 3)], [(1, 10), (3, 30), (None, 40)])
    same(merge(t, s, "k"), [(1, 10), (2, 2), (None, 3), (3, 30), (None, 40)])
    left = cascade_delete(s, "k", "v = 10", {"c": (t, "k")})[1]["c"]
    same(left, [(2, 2), (None, 3)])
    same(fk_orphans(t, s, ["k"]), [(2, 2)])
    scales = spark.createDataFrame([("1.10",), ("2.00",)], "x string")
    a = scales.selectExpr("CAST(x AS decimal(5,1)) AS k", "1 AS v")
    b = scales.selectExpr("CAST(x AS decimal(9,3)) AS k", "2 AS v")
    assert fk_orphans(a, b, ["k"]).isEmpty()
    zero = spark.createDataFrame([(-0.0,)], "k double")
    assert fk_orphans(zero, spark.createDataFrame([(0,)], "k int"), ["k"]).isEmpty()
    with pytest.raises(TypeError, match="convert one side"):
        fk_orphans(t, scales.withColumnRenamed("x", "k"), ["k"])


KV = "k int, v int"


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, 1), (1, 1)], KV)
    s = spark.createDataFrame([(None, 9), (None, 9), (1, 5)], KV)
    same(merge(t, s, "k"), [(None, 1), (1, 5), (None, 9), (None, 9)])


def test_one_source_row_may_update_many(spark):
    t = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], KV)
    s = spark.createDataFrame([(1, 7)], KV)
    same(merge(t, s, "k", matched=[Update({"v": "s.v + t.v"})]), [(1, 8), (1, 9), (1, 9)])


def test_two_acting_rows_raise(spark):
    t = spark.createDataFrame([(1, 1)], KV)
    s = spark.createDataFrame([(1, 7), (1, 7)], KV)
    with pytest.raises(AmbiguousMerge, match="'k': 1"):
        merge(t, s, "k").collect()
    with pytest.raises(AmbiguousMerge, match="'k': 1"):
        merge(t, s, "k", not_matched=[]).collect()
    with pytest.raises(AmbiguousMerge, match="'k': 1"):
        merge(t, s, "k", matched=[Update(None, "s.v > t.v")]).collect()
    assert merge(t, s, "k", check_ambiguous=False).count() == 2
    assert merge(t, s, "k", matched=[], not_matched=[Insert()]).count() == 1


def test_repeated_keys_are_fine_while_one_row_acts(spark):
    t = spark.createDataFrame([(1, 1), (1, 1), (2, 5)], KV)
    s = spark.createDataFrame([(1, 7), (1, 0), (3, 1), (3, 1)], KV)
    got = merge(t, s, "k", matched=[Update(None, "s.v > t.v")])
    same(got, [(1, 7), (1, 7), (2, 5), (3, 1), (3, 1)])


def test_repeated_keys_that_meet_nothing_are_inserted(spark):
    """The test for ambiguity must not be moved to the source's side of a join."""
    t = spark.createDataFrame([(1, 1), (2, 2)], KV)
    s = spark.createDataFrame([(1, 7), (3, 1), (3, 1), (None, 4), (None, 4)], KV)
    same(merge(t, s, "k"), [(1, 7), (2, 2), (3, 1), (3, 1), (None, 4), (None, 4)])
    same(merge(t, s, "k", not_matched=[]), [(1, 7), (2, 2)])


def test_matched_without_clause_is_neither_changed_nor_inserted(spark):
    t = spark.createDataFrame([(1, 9)], KV)
    s = spark.createDataFrame([(1, 3), (2, 3)], KV)
    same(merge(t, s, "k", matched=[Update(None, "s.v > t.v")]), [(1, 9), (2, 3)])


def test_null_condition_does_not_hold(spark):
    t = spark.createDataFrame([(1, None), (2, 1)], KV)
    s = spark.createDataFrame([(1, 3), (2, 3)], KV)
    same(merge(t, s, "k", matched=[Update(None, "s.v <> t.v")]), [(1, None), (2, 3)])


def test_first_clause_wins_and_sets_only_its_columns(spark):
    t = spark.createDataFrame([(1, 1, "a"), (2, 9, "a")], "k int, v int, w string")
    s = spark.createDataFrame([(1, 5), (2, 5)], KV)
    got = merge(
        t,
        s,
        "k",
        matched=[Update({"v": "s.v"}, "s.v > t.v"), Update({"w": "'kept'"})],
        not_matched=[],
    )
    same(got, [(1, 5, "a"), (2, 9, "kept")])


def test_insert_clauses_in_order_with_missing_columns_null(spark):
    t = spark.createDataFrame([], "k int, v bigint, w string")
    s = spark.createDataFrame([(1, 5), (2, 50)], KV)
    got = merge(
        t,
        s,
        "k",
        matched=[],
        not_matched=[
            Insert({"k": "s.k", "w": "'big'"}, "s.v > 10"),
            Insert({"k": "s.k", "v": "s.v"}),
        ],
    )
    same(got, [(1, 5, None), (2, None, "big")])
    assert got.schema["v"].dataType.simpleString() == "bigint"


def test_unknown_columns_are_named(spark):
    t = spark.createDataFrame([(1, 1)], KV)
    s = spark.createDataFrame([(1, 1)], "k int, z int")
    with pytest.raises(ValueError, match="source column not found: v"):
        merge(t, s, "k")
    with pytest.raises(ValueError, match="updated column not found: q"):
        merge(t, s, "k", matched=[Update({"q": "1"})])
    with pytest.raises(ValueError, match="target key not found: x"):
        merge(t, s, {"x": "k"})


def test_frames_derived_from_one_another(spark):
    t = spark.createDataFrame([(i, i) for i in range(10)], KV)
    s = t.where("k > 4").withColumn("v", F.col("v") * 10)
    same(merge(t, s, "k"), [(i, i if i < 5 else i * 10) for i in range(10)])


def brute_merge(target, source, conjunct, acts):
    """MERGE row by row: update v from the one acting source row, insert all unmatched."""
    out, matched = [], set()
    for tk, tv in target:
        acting = []
        for j, (sk, sv) in enumerate(source):
            if tk is not None and tk == sk and conjunct(sv):
                matched.add(j)
                if acts(sv, tv):
                    acting.append(sv)
        if len(acting) > 1:
            return None
        out.append((tk, acting[0] if acting else tv))
    return out + [row for j, row in enumerate(source) if j not in matched]


@pytest.mark.parametrize("seed", range(12))
def test_merge_against_brute_force(spark, seed):
    rng = random.Random(seed)
    size = rng.choice([4, 8, 14])
    target = [(rng.choice([None, *range(size)]), rng.randrange(4)) for _ in range(size)]
    source = [(rng.choice([None, *range(size + 3)]), rng.randrange(4)) for _ in range(size // 2)]
    t, s = spark.createDataFrame(target, KV), spark.createDataFrame(source, KV)
    wanted = brute_merge(target, source, lambda sv: sv != 2, lambda sv, tv: sv > tv)
    call = dict(matched=[Update(None, "s.v > t.v")], source_condition="s.v <> 2")
    if wanted is None:
        with pytest.raises(AmbiguousMerge):
            merge(t, s, "k", **call).collect()
    else:
        same(merge(t, s, "k", **call), wanted)


def test_update_sees_old_row_and_keeps_null_condition(spark):
    df = spark.createDataFrame([(1, 2), (None, 5)], KV)
    same(update_where(df, "k = 1", {"k": "v", "v": "k"}), [(2, 1), (None, 5)])


def test_delete_keeps_null_condition(spark):
    df = spark.createDataFrame([(1, 2), (None, 5), (3, 3)], KV)
    same(delete_where(df, "k < 3"), [(None, 5), (3, 3)])


def test_cascade_delete(spark):
    parent = spark.createDataFrame([(1, 1), (2, 2), (None, 2)], KV)
    child = spark.createDataFrame([(1, 10), (2, 20), (2, 21), (None, 5), (99, 9)], KV)
    left, children = cascade_delete(parent, "k", "v = 2", {"child": (child, "k")})
    same(left, [(1, 1)])
    same(children["child"], [(1, 10), (None, 5), (99, 9)])


def test_insert_if_absent_first_row_wins(spark):
    existing = spark.createDataFrame([(1, "old", 0)], "k int, v string, pos int")
    batch = spark.createDataFrame(
        [(1, "new", 1), (2, "b", 3), (2, "a", 2), (None, "x", 0), (3, "c", 9)],
        existing.schema,
    )
    got = insert_if_absent(existing, batch, "k", ["pos"])
    same(got, [(1, "old", 0), (2, "a", 2), (3, "c", 9)])
    same(insert_if_absent(got, batch, "k", ["pos"]), rows(got))


def test_absent_rows_with_arrays_and_a_dominant_key(spark):
    schema = "k int, tags array<int>, pos int"
    existing = spark.createDataFrame([(5, [1], 0)], schema)
    batch = spark.createDataFrame(
        [(7 if i % 3 else i, [i], 1000 - i) for i in range(1000)], schema
    )
    got = absent_rows(existing, batch, "k", ["pos"])
    wanted = {i for i in range(1000) if i % 3 == 0} | {7}
    assert {r.k for r in got.collect()} == wanted - {5}
    assert got.where("k = 7").first().tags == [998]
