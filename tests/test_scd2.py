import random

import pytest

from silverloom.operators import AmbiguousMerge, Insert, Update, merge, scd2_apply, scd2_chain, scd2_stage

DIM = (
    "sku bigint, label string, aisle string, rack string, is_current boolean, "
    "valid_from string, valid_to string"
)
UPD = "sku bigint, label string, aisle string, rack string, valid_from string"
# A store's shelves: two articles that will move, one that stays, one without a rack, one that
# was given up.
CURRENT = [
    (11, "kettle", "A", "low", True, "2020-03-01", None),
    (12, "lamp", "B", "mid", True, "2020-03-05", None),
    (13, "stool", "C", None, True, "2020-04-17", None),
    (14, "teapot", "A", "top", True, "2021-01-02", None),
    (15, "radio", "D", "mid", False, "2019-02-02", "2020-02-02"),
]
NEWS = [
    (11, "kettle", "E", "low", "2022-06-30"),
    (12, "lamp", "B", "mid", "2022-06-30"),
    (14, "teapot", "A", "low", "2022-07-01"),
    (31, "vase", "F", "top", "2022-07-01"),
]
TRACKED = ["aisle", "rack"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def apply(spark, dim, updates, **options):
    return scd2_apply(
        spark.createDataFrame(dim, DIM), spark.createDataFrame(updates, UPD), "sku", TRACKED, **options
    )


def staged_merge(spark, dim, updates):
    d, u = spark.createDataFrame(dim, DIM), spark.createDataFrame(updates, UPD)
    change = "t.is_current AND (" + " OR ".join(f"s.{c} <> t.{c}" for c in TRACKED) + ")"
    values = {c: f"s.{c}" for c in u.columns} | {"is_current": "true", "valid_to": "null"}
    return merge(
        d,
        scd2_stage(d, u, "sku", TRACKED),
        {"sku": "merge_key"},
        matched=[Update({"is_current": "false", "valid_to": "s.valid_from"}, change)],
        not_matched=[Insert(values)],
    )


def golden():
    """Two articles moved, one came in; everything else stands."""
    closed = [(*CURRENT[0][:4], False, "2020-03-01", "2022-06-30")]
    closed += [(*CURRENT[3][:4], False, "2021-01-02", "2022-07-01")]
    opened = [(*NEWS[i][:4], True, NEWS[i][4], None) for i in (0, 2, 3)]
    return sorted([*CURRENT[1:3], CURRENT[4], *closed, *opened], key=repr)


def test_golden(spark):
    got = apply(spark, CURRENT, NEWS)
    assert rows(got) == golden()
    assert [f.dataType for f in got.schema] == [f.dataType for f in spark.createDataFrame([], DIM).schema]


def test_staging_and_merge_agree(spark):
    d, u = spark.createDataFrame(CURRENT, DIM), spark.createDataFrame(NEWS, UPD)
    staged = scd2_stage(d, u, "sku", TRACKED)
    assert staged.columns == ["merge_key", *u.columns]
    assert staged.count() == len(NEWS) + 2
    assert sorted(r.sku for r in staged.where("merge_key IS NULL").collect()) == [11, 14]
    assert rows(staged_merge(spark, CURRENT, NEWS)) == golden()


def test_keys_of_another_type(spark):
    """The dimension's keys are bigint; those of the updates widen to them, or are refused."""
    d, u = spark.createDataFrame(CURRENT, DIM), spark.createDataFrame(NEWS, UPD)
    for kind in ("int", "decimal(12,2)"):
        got = scd2_apply(d, u.withColumn("sku", u.sku.cast(kind)), "sku", TRACKED)
        assert rows(got) == golden()
    with pytest.raises(TypeError, match="convert one side"):
        scd2_apply(d, u.withColumn("sku", u.sku.cast("string")), "sku", TRACKED)


def test_second_run_changes_nothing(spark):
    once = apply(spark, CURRENT, NEWS)
    again = scd2_apply(once, spark.createDataFrame(NEWS, UPD), "sku", TRACKED)
    assert rows(again) == golden()


def test_null_counts_as_no_change_unless_asked(spark):
    dim = [(1, "a", None, "p", True, "1990", None)]
    upd = [(1, "a", "s", "p", "1991")]
    assert rows(apply(spark, dim, upd)) == sorted(dim, key=repr)
    changed = rows(apply(spark, dim, upd, null_safe=True))
    assert len(changed) == 2
    assert (1, "a", "s", "p", True, "1991", None) in changed


def test_key_with_closed_rows_only(spark):
    dim = [(1, "a", "s", "p", False, "1990", "1991")]
    upd = [(1, "a", "s2", "p", "1995")]
    assert rows(apply(spark, dim, upd)) == dim
    assert rows(staged_merge(spark, dim, upd)) == dim
    reopened = rows(apply(spark, dim, upd, reopen_closed=True))
    assert reopened == sorted([*dim, (1, "a", "s2", "p", True, "1995", None)], key=repr)


def test_two_changes_for_one_key_raise(spark):
    dim = [(1, "a", "s", "p", True, "1990", None)]
    upd = [(1, "a", "s1", "p", "1995"), (1, "a", "s2", "p", "1996")]
    with pytest.raises(AmbiguousMerge):
        apply(spark, dim, upd).collect()
    with pytest.raises(AmbiguousMerge):
        staged_merge(spark, dim, upd).collect()


def test_repeats_that_do_not_clash_follow_the_staged_merge(spark):
    dim = [
        (1, "a", "s", "p", True, "1990", None),
        (2, "b", "s", "p", True, "1990", None),
        (2, "b", "x", "p", True, "1991", None),
        (3, "c", "s", "p", True, "1990", None),
        (3, "c", "s", "p", False, "1980", "1990"),
        (None, "n", "s", "p", True, "1990", None),
    ]
    upd = [
        (1, "a", "s", "p", "1995"),  # the same as the current row
        (1, "a", "s2", "p", "1996"),
        (2, "b", "s9", "p", "1996"),  # two current rows, both close
        (3, "c", "s3", "p", "1996"),
        (4, "d", "s", "p", "1996"),  # a new key twice
        (4, "d", "t", "p", "1997"),
        (None, "m", "t", "p", "1997"),
    ]
    assert rows(apply(spark, dim, upd)) == rows(staged_merge(spark, dim, upd))


def test_columns_the_update_lacks_are_null_in_new_versions(spark):
    dim = spark.createDataFrame(
        [(1, "s", True, "1990", None, "x")],
        "k int, state string, flag boolean, a string, b string, note string",
    )
    upd = spark.createDataFrame([(1, "t", "1995")], "k int, state string, a string")
    got = scd2_apply(dim, upd, "k", ["state"], flag="flag", start="a", end="b")
    assert rows(got) == sorted(
        [(1, "s", False, "1990", "1995", "x"), (1, "t", True, "1995", None, None)], key=repr
    )


def chain(dim, updates):
    """The versions of each key, by going through its rows in time."""
    out = [r for r in dim if r[0] is None or r[5] is None]
    keys = {r[0] for r in dim if r[5] is not None} | {u[0] for u in updates if u[4] is not None}
    for key in keys - {None}:
        ours = [r for r in dim if r[0] == key and r[5] is not None]
        news = {}
        for u in updates:
            if u[0] == key and u[4] is not None:
                rank = tuple((x is not None, x) for x in u[1:4])
                news[u[4]] = max(news.get(u[4], (rank, u)), (rank, u))
        if not news:
            out += ours
            continue
        rows = [(r[5], 0, r) for r in ours if r[5] not in news] + [(d, 1, u) for d, (_, u) in news.items()]
        rows.sort(key=lambda r: r[:2])
        versions, state = [], None  # state: tracked values and end
        for day, new, r in rows:
            over = state is not None and state[1] is not None and state[1] <= day
            if not new or state is None or over or r[2:4] != state[0]:
                versions.append([*r[:4], day, None if new else r[6]])
                state = (r[2:4], versions[-1][5])
        for v, nxt in zip(versions, [*versions[1:], None]):
            ends = [e for e in (v[5], nxt and nxt[4]) if e is not None]
            until = min(ends) if ends else None
            out.append((*v[:4], until is None, v[4], until))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_chains_against_a_walk_through_time(spark, seed):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)
    dim, updates = [], []
    for key in range(40):
        days = sorted(rng.sample(range(10, 40), 4))
        if key % 5:
            dim.append((key, "a", pick("x", "y"), pick("p", None), False, f"d{days[0]}", f"d{days[1]}"))
        if key % 3:
            dim.append((key, "a", pick("x", "y"), pick("p", None), True, f"d{days[2]}", None))
        for _ in range(rng.randrange(6)):
            updates.append((key, pick("a", "b"), pick("x", "y"), pick("p", None), f"d{rng.randrange(10, 45)}"))
    dim += [(None, "n", "x", "p", True, "d10", None), (3, "s", "x", "p", True, None, None)]
    updates += [(None, "n", "x", "p", "d12"), (4, "b", "x", "p", None)]
    d, u = spark.createDataFrame(dim, DIM), spark.createDataFrame(updates, UPD)
    got = scd2_chain(d, u, "sku", TRACKED)
    assert got.schema == d.schema
    assert rows(got) == sorted(chain(dim, updates), key=repr)
    # Taking the same updates again changes nothing.
    assert rows(scd2_chain(spark.createDataFrame(got.collect(), DIM), u, "sku", TRACKED)) == rows(got)


def test_three_updates_and_a_late_one(spark):
    dim = [(1, "a", "s", "p", True, "2020", None), (2, "b", "s", "p", True, "2020", None)]
    upd = [(1, "a", f"s{y}", "p", str(y)) for y in (2023, 2021, 2022)] + [(1, "a", "s0", "p", "2019")]
    d, u = spark.createDataFrame(dim, DIM), spark.createDataFrame(upd, UPD)
    starts = ["2019", "2020", "2021", "2022", "2023"]
    got = [(r.valid_from, r.valid_to, r.is_current) for r in scd2_chain(d, u, "sku", TRACKED).where("sku = 1").orderBy("valid_from").collect()]
    assert got == [(a, b, b is None) for a, b in zip(starts, [*starts[1:], None])]
    assert rows(scd2_chain(d, u.limit(0), "sku", TRACKED)) == rows(d)
    assert scd2_chain(d.limit(0), u, "sku", TRACKED).count() == 4
