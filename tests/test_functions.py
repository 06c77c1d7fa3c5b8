import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.functions import (
    cast_to,
    extract_value,
    parse_objects,
    to_date,
    to_double,
    to_float,
    to_int,
    to_long,
)

INTS = [
    ("162", 162),
    ("162.0", 162),
    ("162.7", 162),
    ("-3.9", -3),
    (" 7 ", 7),
    (".5", 0),
    ("5.", 5),
    ("x", None),
    ("1e3", None),
    ("", None),
    (None, None),
    ("99999999999", None),
    ("9999999999", None),
    ("2147483647", 2147483647),
    ("-2147483648.9", -2147483648),
    ("000000000000000012", 12),
    ("+4", 4),
    ("5.99999999999999", 5),
    ("1.2.3", None),
    (".", None),
    ("-", None),
    ("NaN", None),
]


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "c string")


def test_to_int(spark):
    got = column(spark, [v for v, _ in INTS]).select(to_int("c")).collect()
    assert [r[0] for r in got] == [w for _, w in INTS]


def test_to_long_keeps_large_keys_exact(spark):
    values = ["9007199254740993", "9007199254740993.9", "99999999999999999999", "x"]
    got = column(spark, values).select(to_long("c")).collect()
    assert [r[0] for r in got] == [9007199254740993, 9007199254740993, None, None]


def test_to_double_float_date(spark):
    df = column(spark, ["2.5", "abc", None, "1e3", " .5 ", "-7", "5 apples", "-Infinity"])
    wanted = [2.5, None, None, 1000.0, 0.5, -7.0, None, float("-inf")]
    assert [r[0] for r in df.select(to_double("c")).collect()] == wanted
    assert [r[0] for r in df.select(to_float("c")).collect()] == wanted
    days = column(
        spark, ["2009-12-10", "2020-13-45", "2021-02-29", "2009-12-10x", "2009", "soon", None]
    )
    got = [r[0] for r in days.select(to_date("c")).collect()]
    assert got == [datetime.date(2009, 12, 10)] + [None] * 6
    dotted = column(spark, ["10.12.2009", "x"]).select(to_date("c", "dd.MM.yyyy"))
    assert [r[0] for r in dotted.collect()] == [datetime.date(2009, 12, 10), None]


def test_cast_to_leaves_typed_input_alone(spark):
    df = spark.range(1)
    assert df.select(cast_to(F.col("id"), T.LongType(), T.LongType()).alias("v")).first().v == 0
    assert df.select(cast_to(F.lit(3.7), T.IntegerType(), T.DoubleType()).alias("v")).first().v == 3


# Cell -> rows (id, name) for the two modes.
CELLS = [
    (None, [], []),
    ("", [], []),
    ("[]", [], []),
    ('[{"id":1},{"id', [], []),
    ("[{'id': 28, 'name': 'A'}]", [("28", "A")], [("28", "A")]),
    ('[{"id": 1, "name": "O\'Brien"}]', [("1", "O'Brien")], []),
    ('[{"id": null}]', [(None, None)], [(None, None)]),
    ('[null, {"id": 3}]', [(None, None), ("3", None)], [(None, None), ("3", None)]),
    ('[{"id": 1, "id": 2}]', [("2", None)], [("2", None)]),
    ('[{"id": 1}] junk', [("1", None)], []),
    ("[1,2]", [], [(None, None), (None, None)]),
    ('{"id":1}', [], []),
    ('[{"id": 1.50, "name": true}]', [("1.5", "true")], [("1.5", "true")]),
    ('[{"name": {"x": 1}}]', [(None, '{"x":1}')], [(None, '{"x":1}')]),
    (' \n[{"id": 9}]', [("9", None)], [("9", None)]),
    ('[{"id": 1, "other": [1, {"a": 2}]}]', [("1", None)], [("1", None)]),
    ('[{"id": "a\\"b", "name": "ü"}]', [('a"b', "ü")], [('a"b', "ü")]),
]


@pytest.mark.parametrize("mode, wanted", [("native", 1), ("replace", 2)])
def test_parse_objects(spark, mode, wanted):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CELLS)], "i int, c string")
    rows = (
        df.select("i", F.posexplode(parse_objects("c", ["id", "name"], mode)).alias("p", "o"))
        .select("i", "p", "o.id", "o.name")
        .orderBy("i", "p")
        .collect()
    )
    for i, cell in enumerate(CELLS):
        assert [(r.id, r.name) for r in rows if r.i == i] == cell[wanted], cell[0]


def test_parse_objects_reads_whole_long_cells(spark):
    text = "x" * 300_000
    df = spark.range(1).select(
        F.to_json(F.array(*[F.struct(F.lit(text).alias("name"))] * 3)).alias("c")
    )
    got = df.select(F.explode(parse_objects("c", ["name"])).alias("o")).select(
        F.length("o.name")
    )
    assert [r[0] for r in got.collect()] == [300_000] * 3


def test_unknown_quote_mode_is_rejected():
    with pytest.raises(ValueError, match="quote_mode"):
        parse_objects("c", ["id"], "other")


def test_extract_value(spark):
    values = ['{"k": 69}', "{'k': 'v'}", '{"z": 1}', "[1]", "{bad", None, '{"k.x": 1, "k": null}']
    got = column(spark, values).select(extract_value("c", "k")).collect()
    assert [r[0] for r in got] == ["69", "v", None, None, None, None, None]
    dotted = column(spark, ['{"k.x": 1}']).select(extract_value("c", "k.x", "replace"))
    assert dotted.first()[0] == "1"


@pytest.mark.parametrize("mode", ["native", "replace"])
def test_cells_of_any_size_survive(spark, mode):
    """Values over 20 MB, long numbers and deep nesting keep their cell."""
    big = "x" * 25_000_000
    # Replacing quotes writes each element out again, which Spark does to 1,000 levels only.
    levels = 1100 if mode == "native" else 900
    number, deep = "7" * 1500, "[" * levels + "]" * levels
    cells = [
        f'[{{"name": "{big}"}}, {{"name": "b"}}]',
        f'[{{"name": "a", "other": {number}}}]',
        f'[{{"name": "c", "other": {deep}}}]',
    ]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    parsed = df.select(F.transform(parse_objects("c", ["name"], mode), lambda o: F.length(o["name"])))
    assert sorted(r[0] for r in parsed.collect()) == [[1], [1], [25_000_000, 1]]
    roots = df.select(F.length(extract_value(F.expr("substring(c, 2, length(c) - 2)"), "name", mode)))
    assert sorted(r[0] for r in roots.where("c NOT LIKE '%b%'").collect()) == [1, 1]
