"""The silver builders and their column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverloom.functions import extract_value, parse_objects
from silverloom.operators import conform, conform_report, explode_objects
from silverloom.plans import build_movies, build_objects
from silverloom.schemas import DATE, DOUBLE, FLOAT, INT, LONG, OBJECT_TABLES, STRING, struct
from silverloom.workloads.inputs import bronze_credits, bronze_movies, spread_table, table

_BRONZE = {"credits": bronze_credits, "movies": bronze_movies}


def _builder(name):
    source = _BRONZE[OBJECT_TABLES[name].source]
    return lambda spark, sf: build_objects(source(spark, sf), name)


def q_silver_movies(spark, sf):
    return build_movies(bronze_movies(spark, sf))


def q_silver_companies_replace(spark, sf):
    """If quotes are replaced, a cell with an apostrophe or trailing text is lost."""
    cell = F.col("production_companies")
    plain = F.replace(cell, F.lit("O'B"), F.lit("B"))
    bronze = bronze_movies(spark, sf).withColumn(
        "production_companies",
        F.when(F.col("status") == "O", plain)
        .when(F.col("status") == "P", F.concat(plain, F.lit(" junk")))
        .otherwise(cell),
    )
    return build_objects(bronze, "production_companies", quote_mode="replace")


def q_explode_json_items(spark, sf):
    lines = spread_table(
        spark,
        sf,
        "lineitem",
        *("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"),
    )
    part = F.struct(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("name"))
    supplier = F.struct(F.col("l_suppkey").alias("id"), F.col("l_linestatus").alias("name"))
    cells = lines.select("l_orderkey", F.to_json(F.array(part, supplier)).alias("items"))
    return explode_objects(
        cells, "items", {"l_orderkey": "l_orderkey"}, ("id", "name"), {"id": LONG}
    )


def q_parse_event_props(spark, sf):
    cells = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("["), "props", F.lit("]")).alias("cell")
    )
    return explode_objects(
        cells, "cell", {"event_id": "event_id"}, ("k", "z"), {"k": INT, "z": INT}, {"z": -9999}
    )


def q_extract_value(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", extract_value("props", "k").alias("k"), extract_value("props", "z").alias("z")
    )


def q_parse_whole_texts(spark, sf):
    """Whole document texts through a JSON cell and back."""
    docs = table(spark, sf, "documents")
    cell = F.to_json(F.array(F.struct(F.col("text").alias("body"))))
    parsed = docs.select(
        "doc_id",
        F.col("text"),
        parse_objects(cell, ["body"])[0]["body"].alias("body"),
    )
    return parsed.select(
        "doc_id", F.char_length("body").alias("length"), (F.col("body") == F.col("text")).alias("same")
    )


_TEXT_ORDERS = struct(
    o_orderkey=LONG, o_custkey=INT, o_totalprice=DOUBLE, o_orderdate=DATE, weight=FLOAT, note=STRING
)


def _text_orders(spark, sf):
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    orders = spread_table(
        spark,
        sf,
        "orders",
        *("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority"),
    )
    return orders.select(
        key.cast("string").alias("o_orderkey"),
        F.when(status == "P", F.concat(cust.cast("string"), F.lit(".7")))
        .when(status == "O", F.concat((cust + 1).cast("string"), F.lit("00000000000")))
        .otherwise(cust.cast("string"))
        .alias("o_custkey"),
        F.when(status == "P", "n/a")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "5-LOW", "2020-13-45")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("o_orderdate"),
        F.concat(cust.cast("string"), F.lit(".5")).alias("weight"),
        F.col("o_orderpriority").alias("note"),
    )


def q_movies_conform(spark, sf):
    return conform(_text_orders(spark, sf), _TEXT_ORDERS)


def q_conform_report(spark, sf):
    return conform_report(_text_orders(spark, sf), _TEXT_ORDERS)


QUERIES = {
    "silver_movies": q_silver_movies,
    **{f"silver_{name}": _builder(name) for name in OBJECT_TABLES},
    "silver_companies_replace": q_silver_companies_replace,
    "explode_json_items": q_explode_json_items,
    "parse_event_props": q_parse_event_props,
    "extract_value": q_extract_value,
    "parse_whole_texts": q_parse_whole_texts,
    "movies_conform": q_movies_conform,
    "conform_report": q_conform_report,
}

_CONFORMED = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS o_custkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
       CAST(o_custkey + 0.5 AS FLOAT) AS weight, o_orderpriority AS note
FROM orders
"""

SQL = {
    "silver_movies": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, 'Order ' || o_orderkey AS title,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS budget,
               CASE WHEN o_orderstatus <> 'F' THEN 'http://example.com/' || o_orderkey END AS homepage,
               lower(o_orderstatus) AS original_language, 'Order ' || o_orderkey AS original_title,
               'The "' || o_orderpriority || '" one,' || chr(10) || 'by customer ' || o_custkey || '.'
                 AS overview,
               CAST(o_custkey + 0.5 AS FLOAT) AS popularity,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END
                 AS release_date,
               o_totalprice AS revenue, CAST(o_custkey AS INTEGER) AS runtime,
               o_orderstatus AS status, o_orderpriority AS tagline,
               CAST(o_custkey + 0.25 AS FLOAT) AS vote_average,
               CAST(o_custkey AS INTEGER) AS vote_count
        FROM orders""",
    "silver_cast": """
        SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, 'Order ' || l_orderkey AS title,
               CAST(l_linenumber AS VARCHAR) AS cast_id, 'The "Part"' AS character,
               'p' || l_partkey AS credit_id, '1' AS gender, CAST(l_partkey AS VARCHAR) AS id,
               'Part ' || l_partkey AS name
        FROM lineitem
        UNION ALL
        SELECT CAST(l_orderkey AS VARCHAR), 'Order ' || l_orderkey, CAST(l_linenumber AS VARCHAR),
               'Maker', '0000000000', '2', CAST(l_suppkey AS VARCHAR), 'Supplier ' || l_suppkey
        FROM lineitem""",
    "silver_crew": """
        SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, 'Order ' || l_orderkey AS title,
               '0000000000' AS credit_id, l_linestatus AS department, '0' AS gender,
               CAST(l_suppkey AS VARCHAR) AS id,
               CASE WHEN l_returnflag = 'R' THEN 'Director' ELSE 'Editor' END AS job,
               'Supplier ' || l_suppkey AS name
        FROM lineitem""",
    "silver_genres": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, CAST(o_custkey AS INTEGER) AS id,
               o_orderpriority AS name FROM orders
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), -9999, o_orderstatus FROM orders""",
    "silver_keywords": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, CAST(o_custkey AS INTEGER) AS id,
               'kept ' || o_orderstatus AS name FROM orders WHERE o_orderstatus <> 'O'""",
    "silver_production_companies": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, -9999 AS id, 'O''Brien' AS name FROM orders
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS INTEGER), 'Plain' FROM orders""",
    "silver_production_countries": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, o_orderstatus AS iso_3166_1,
               o_orderpriority AS name FROM orders
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'XX', 'none' FROM orders""",
    "silver_spoken_languages": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, o_orderstatus AS iso_639_1,
               CAST(NULL AS VARCHAR) AS name FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'XX', NULL FROM orders
                  WHERE o_orderstatus <> 'F'""",
    "silver_companies_replace": """
        SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, -9999 AS id, 'Brien' AS name
        FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS INTEGER), 'Plain'
        FROM orders WHERE o_orderstatus = 'O'""",
    "explode_json_items": """
        SELECT l_orderkey, l_partkey AS id, l_returnflag AS name FROM lineitem
        UNION ALL SELECT l_orderkey, l_suppkey, l_linestatus FROM lineitem""",
    "parse_event_props": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, -9999 AS z
        FROM events""",
    "extract_value": """
        SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.z') AS z
        FROM events""",
    "parse_whole_texts": """
        SELECT doc_id, CAST(length(text) AS INTEGER) AS length, true AS same FROM documents""",
    "movies_conform": _CONFORMED,
    "conform_report": f"""
        WITH fitted AS ({_CONFORMED})
        SELECT 'o_orderkey' AS column_name, 'string' AS from_type, 'bigint' AS to_type,
               count(*) AS present, count(*) - count(o_orderkey) AS lost FROM fitted
        UNION ALL SELECT 'o_custkey', 'string', 'int', count(*), count(*) - count(o_custkey) FROM fitted
        UNION ALL SELECT 'o_totalprice', 'string', 'double', count(*), count(*) - count(o_totalprice)
                  FROM fitted
        UNION ALL SELECT 'o_orderdate', 'string', 'date', count(*), count(*) - count(o_orderdate)
                  FROM fitted
        UNION ALL SELECT 'weight', 'string', 'float', count(*), 0 FROM fitted
        UNION ALL SELECT 'note', 'string', 'string', count(*), 0 FROM fitted""",
}
