"""Sources and sinks: what is written under the scratch folder is read back and checked."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.functions.json_cells import UNLIMITED
from silverloom.operators import assign_parts, with_position
from silverloom.plans import build_movies, build_silver, check_targets, write_silver
from silverloom.schemas import (
    INT,
    LONG,
    OBJECT_TABLES,
    SILVER_TABLES,
    STRICT_TARGETS,
    STRING,
    TARGETS,
    struct,
)
from silverloom.session import scratch_path
from silverloom.sources import (
    concat_pages,
    land_bronze,
    load_tables,
    read_bronze,
    read_pages,
    read_table,
    sql_over_path,
    to_search_docs,
    write_json,
    write_parts,
    write_search_docs,
    write_table,
)
from silverloom.sources.bronze import CSV_OPTIONS, FILE_RECORDS
from silverloom.sources.tables import APPEND, CREATE
from silverloom.streaming import ingest_absent, ingest_table
from silverloom.streaming.ingest import BUCKET
from silverloom.workloads.inputs import bronze_credits, bronze_movies, table


def _write_csv(df, path):
    options = dict(header=True, escape=CSV_OPTIONS["escape"], maxRecordsPerFile=FILE_RECORDS)
    df.write.options(**options).csv(path)


def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "bronze-movies")
    _write_csv(bronze_movies(spark, sf), path)
    return build_movies(read_bronze(spark, path, "movies"))


def q_json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice"
    )
    write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


def q_append_overwrite(spark, sf):
    """Create, replace, then append: the customers written first are gone."""
    path = scratch_path(spark, "table")

    def named(name, prefix):
        rows = table(spark, sf, name)
        return rows.select(
            F.lit(name).alias("kind"),
            F.col(f"{prefix}key").alias("id"),
            F.col(f"{prefix[0]}_name").alias("name"),
        )

    write_table(named("customer", "c_cust"), path, CREATE)
    write_table(named("supplier", "s_supp"), path)
    write_table(named("part", "p_part"), path, APPEND)
    return read_table(spark, path).groupBy("kind").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("id").alias("max_id")
    )


def q_path_sql(spark, sf):
    return sql_over_path(
        spark,
        """
        SELECT c.c_mktsegment, count(*) AS orders, max(o.o_totalprice) AS largest
        FROM {orders} o JOIN {customers} c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment
        """,
        orders=f"{sf.rstrip('/')}/orders.parquet",
        customers=f"{sf.rstrip('/')}/customer.parquet",
    )


def q_search_docs(spark, sf):
    path = scratch_path(spark, "docs")
    write_search_docs(to_search_docs(table(spark, sf, "part"), "part", "p_partkey"), path)
    written = spark.read.schema("_index string, _id string, _source string").json(path)
    fields = F.from_json(
        "_source", "p_name string, p_size int, p_retailprice double", UNLIMITED
    )
    return written.select("_index", "_id", fields.alias("f")).select("_index", "_id", "f.*")


def q_paged_cap(spark, sf):
    """Pages of two records each; the listing ends after the first 500 records."""
    record = struct(id=LONG, title=STRING)
    results = F.array(
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("title")),
        F.struct(F.col("event_id").alias("id"), F.col("props").alias("title")),
    )
    path = scratch_path(spark, "pages")
    write_json(
        table(spark, sf, "events").select(
            F.col("event_id").alias("page"), results.alias("results")
        ),
        path,
    )
    return concat_pages(read_pages(spark, path, record), 500)


def q_paged_arrays(spark, sf):
    """An array of integers through pages, a stored table and back."""
    record = struct(id=LONG, genre_ids=T.ArrayType(INT))
    ids = F.array(F.col("user_id"), F.col("event_id") % 100, F.lit(None))
    path, stored = scratch_path(spark, "array-pages"), scratch_path(spark, "array-table")
    pages = table(spark, sf, "events").select(
        F.col("event_id").alias("page"),
        F.array(F.struct(F.col("event_id").alias("id"), ids.alias("genre_ids"))).alias("results"),
    )
    write_json(pages, path)
    write_table(read_pages(spark, path, record).select(F.inline("results")), stored)
    genres = F.col("genre_ids")
    return read_table(spark, stored).select(
        "id",
        F.size(genres).alias("n_genres"),
        F.get(genres, F.lit(0)).alias("first_genre"),
        F.array_join(genres.cast("array<string>"), ",", "none").alias("genres"),
    )


_BY_PRICE = ["o_totalprice", "o_orderkey"]


def q_chunk_parts(spark, sf):
    parts = assign_parts(table(spark, sf, "orders"), _BY_PRICE, 7)
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("position").alias("first_position"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
    )


def q_part_files(spark, sf):
    path = scratch_path(spark, "parts")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    write_parts(orders, path, _BY_PRICE, 7)
    written = spark.read.options(**CSV_OPTIONS).csv(path)
    return written.groupBy(F.col("part").cast("int").alias("part")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(F.col("o_totalprice").cast("double")).alias("lowest"),
        F.max(F.col("o_totalprice").cast("double")).alias("highest"),
    )


def q_load_report(spark, sf):
    root = scratch_path(spark, "load")
    names = ("orders", "customer", "supplier", "missing")
    report = load_tables(
        spark,
        {name: f"{root}/{name}" for name in names},
        lambda name: table(spark, sf, name),
        write_table,
    )
    return report.select("table_name", "status", "row_count")


def q_load_in_order(spark, sf):
    """Line items wait for orders and parts, orders for customers; a table whose parent is
    missing, and what refers to it in turn, is skipped."""
    root = scratch_path(spark, "ordered-load")
    parents = {
        "lineitem": ("orders", "part"),
        "orders": ("customer",),
        "supplier": ("missing",),
        "events": ("supplier",),
    }
    names = ("events", "lineitem", "orders", "part", "supplier", "customer", "missing")

    def write(df, target):
        name = target.rsplit("/", 1)[1]
        for parent in parents.get(name, ()):
            read_table(spark, f"{root}/{parent}")  # refused while the parent is not there
        write_table(df, target)

    report = load_tables(
        spark,
        {name: f"{root}/{name}" for name in names},
        lambda name: table(spark, sf, name),
        write,
        parents,
    )
    return report.select("table_name", "status", "row_count")


def _load_silver(spark, sf):
    credits = land_bronze(bronze_credits(spark, sf), scratch_path(spark, "credits"))
    movies = land_bronze(bronze_movies(spark, sf), scratch_path(spark, "movies"))
    root = scratch_path(spark, "silver")
    return root, write_silver(spark, build_silver(credits, movies), root)


def q_silver_load(spark, sf):
    """Land bronze in columns, write all eight silver tables, report the rows of each."""
    return _load_silver(spark, sf)[1].select("table_name", "status", "row_count")


def q_target_checks(spark, sf):
    """The rules of the relational targets over the stored silver tables."""
    root, _ = _load_silver(spark, sf)
    return check_targets({name: read_table(spark, f"{root}/{name}") for name in SILVER_TABLES})


def _damaged(spark, sf):
    """Movies, cast and genres that break every rule: keys that are no numbers or repeated,
    movies that are not there, texts of growing length."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    none = {f.name: F.lit(None).cast("string") for f in TARGETS["movies"].schema}
    movie = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(
        F.expr("CAST(o_orderkey div 2 AS string)")
    )
    movies = none | {
        "movie_id": movie,
        "title": F.expr("repeat('title', int(o_custkey % 60))"),
        "status": F.expr("repeat('s', int(o_custkey % 60))"),
        "runtime": F.when(F.col("o_orderstatus") == "P", "long").otherwise("90"),
    }
    refers = F.expr("CAST(l_orderkey div 2 AS string)")
    genres = {
        "movie_id": F.when(F.col("l_linenumber") != 1, refers),
        "id": F.when(F.col("l_linenumber") == 2, "two").otherwise(F.col("l_linenumber").cast("string")),
        "name": F.expr("repeat('g', int(l_partkey % 130))"),
    }
    cast = {
        "movie_id": F.expr("CAST(l_orderkey * 3 AS string)"),
        "cast_id": F.col("l_linenumber").cast("string"),
        "character": F.expr("repeat('c', int(l_partkey % 300))"),
        "credit_id": F.col("l_orderkey").cast("string"),
        "gender": F.when(F.col("l_returnflag") == "R", "none").otherwise("2"),
        "id": F.col("l_suppkey").cast("string"),
        "name": F.expr("repeat('n', int(l_partkey % 260))"),
    }
    shaped = lambda df, columns: df.select(*[c.alias(n) for n, c in columns.items()])
    return {"movies": shaped(orders, movies), "genres": shaped(lines, genres), "cast": shaped(lines, cast)}


def q_target_checks_broken(spark, sf):
    return check_targets(_damaged(spark, sf))


def q_target_checks_strict(spark, sf):
    """The earlier loader's shorter limits."""
    return check_targets(_damaged(spark, sf), STRICT_TARGETS)


def q_stream_ingest(spark, sf):
    source, target = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    _write_csv(bronze_movies(spark, sf), source)
    ingest_table(spark, source, "keywords", target, scratch_path(spark, "stream-state"))
    return read_table(spark, target)


def q_stream_insert_absent(spark, sf):
    source, target = scratch_path(spark, "absent-in"), scratch_path(spark, "absent-out")
    batch = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    write_table(batch, source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    state = scratch_path(spark, "absent-state")
    ingest_absent(stream, target, "o_custkey", ["o_orderkey"], state)
    return read_table(spark, target)


def q_stream_insert_buckets(spark, sf):
    """Three batches against a target that already holds the customers of every fourth order; a
    key found there, or in an earlier batch, is not added again."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    target, state = scratch_path(spark, "buckets-out"), scratch_path(spark, "buckets-state")
    for run, parts in enumerate([(0,), (1, 2, 3)]):
        source = scratch_path(spark, "buckets-in")
        for part in parts:  # one file each, and so one batch
            write_table(orders.where(F.col("o_orderkey") % 4 == part).coalesce(1), source, APPEND)
        stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest_absent(stream, target, "o_custkey", ["o_orderkey"], f"{state}-{run}", buckets=16)
    return read_table(spark, target).drop(BUCKET)


def q_csv_reordered_parts(spark, sf):
    """Two part sets whose headers have the columns in another order, read as one."""
    movies, paths = bronze_movies(spark, sf), [scratch_path(spark, f"set-{i}") for i in (1, 2)]
    even = F.col("id").cast("bigint") % 2 == 0
    _write_csv(movies.where(even), paths[0])
    _write_csv(movies.where(~even).select(*reversed(movies.columns)), paths[1])
    return build_movies(read_bronze(spark, paths, "movies"))


def q_chunk_parts_joined(spark, sf):
    """Positions over a join, whose size the optimizer overrates by far."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    order = ["o_orderdate", "o_orderkey", "l_linenumber"]
    return with_position(joined.select(*order), order)


QUERIES = {
    "csv_reordered_parts": q_csv_reordered_parts,
    "chunk_parts_joined": q_chunk_parts_joined,
    "csv_roundtrip": q_csv_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "append_overwrite": q_append_overwrite,
    "path_sql": q_path_sql,
    "search_docs": q_search_docs,
    "paged_cap": q_paged_cap,
    "paged_arrays": q_paged_arrays,
    "chunk_parts": q_chunk_parts,
    "part_files": q_part_files,
    "load_report": q_load_report,
    "silver_load": q_silver_load,
    "target_checks": q_target_checks,
    "target_checks_broken": q_target_checks_broken,
    "target_checks_strict": q_target_checks_strict,
    "stream_ingest": q_stream_ingest,
    "stream_insert_absent": q_stream_insert_absent,
    "stream_insert_buckets": q_stream_insert_buckets,
    "load_in_order": q_load_in_order,
}

_PARTS = """
WITH placed AS (
  SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position,
         count(*) OVER () AS n FROM orders),
parts AS (
  SELECT *, CAST(CASE WHEN n < 7 THEN 7 ELSE least(position // (n // 7) + 1, 7) END AS INTEGER) AS part
  FROM placed)
"""

_SILVER_SIZES = {
    "movies": "orders",
    "cast": "lineitem, range(2)",
    "crew": "lineitem",
    "genres": "orders, range(2)",
    "keywords": "orders WHERE o_orderstatus <> 'O'",
    "production_companies": "orders, range(2)",
    "production_countries": "orders, range(2)",
    "spoken_languages": "orders, range(2) WHERE o_orderstatus <> 'F'",
}
assert set(_SILVER_SIZES) == set(SILVER_TABLES)

_RULES = {name: ("type", "primary key", "foreign key", "length") for name in OBJECT_TABLES}
_RULES["movies"] = ("type", "primary key", "length")
# Part and maker of a line share its number; every crew entry has the same imputed id.
_BROKEN_KEYS = {
    "cast": "(SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))",
    "crew": "1",
}


def _movies_sql():
    from silverloom.workloads.silver import SQL as silver_sql

    return silver_sql["silver_movies"], silver_sql["silver_keywords"]


_MOVIES, _KEYWORDS = _movies_sql()

_BROKEN = """
WITH movies AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey // 2 END AS movie,
         5 * (o_custkey % 60) AS title, o_custkey % 60 AS status, o_orderstatus FROM orders),
genres AS (
  SELECT CASE WHEN l_linenumber <> 1 THEN l_orderkey // 2 END AS movie,
         CASE WHEN l_linenumber <> 2 THEN l_linenumber END AS id, l_partkey % 130 AS name FROM lineitem),
members AS (
  SELECT l_orderkey * 3 AS movie, l_linenumber AS id, l_partkey % 300 AS part, l_partkey % 260 AS name,
         l_returnflag FROM lineitem),
known AS (SELECT DISTINCT movie FROM movies WHERE movie IS NOT NULL)
SELECT * FROM (
  SELECT 'movies' AS table_name, 'type' AS rule,
         count(*) FILTER (movie IS NULL) + count(*) FILTER (o_orderstatus = 'P') AS violations FROM movies
  UNION ALL SELECT 'movies', 'length', count(*) FILTER (title > 255) + count(*) FILTER (status > {status}) FROM movies
  UNION ALL SELECT 'movies', 'primary key', count(*) FROM
    (SELECT 1 FROM movies GROUP BY movie HAVING count(*) > 1 OR movie IS NULL)
  UNION ALL SELECT 'genres', 'type', count(*) FILTER (id IS NULL) FROM genres
  UNION ALL SELECT 'genres', 'length', count(*) FILTER (name > 100) FROM genres
  UNION ALL SELECT 'genres', 'primary key', count(*) FROM
    (SELECT 1 FROM genres GROUP BY movie, id HAVING count(*) > 1 OR movie IS NULL OR id IS NULL)
  UNION ALL SELECT 'genres', 'foreign key', count(*) FROM genres
    WHERE movie IS NOT NULL AND movie NOT IN (SELECT movie FROM known)
  UNION ALL SELECT 'cast', 'type', count(*) FILTER (l_returnflag = 'R') FROM members
  UNION ALL SELECT 'cast', 'length', count(*) FILTER (name > 255) + {character} FROM members
  UNION ALL SELECT 'cast', 'primary key', count(*) FROM
    (SELECT 1 FROM members GROUP BY movie, id HAVING count(*) > 1)
  UNION ALL SELECT 'cast', 'foreign key', count(*) FROM members WHERE movie NOT IN (SELECT movie FROM known))
"""

SQL = {
    "csv_roundtrip": _MOVIES,
    "json_roundtrip": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders""",
    "append_overwrite": """
        SELECT 'supplier' AS kind, count(*) AS row_count, max(s_suppkey) AS max_id FROM supplier
        UNION ALL SELECT 'part', count(*), max(p_partkey) FROM part""",
    "path_sql": """
        SELECT c_mktsegment, count(*) AS orders, max(o_totalprice) AS largest
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    "search_docs": """
        SELECT 'part' AS _index, CAST(p_partkey AS VARCHAR) AS _id, p_name, p_size, p_retailprice
        FROM part""",
    "paged_cap": """
        SELECT page, pos, id, title FROM (
          SELECT event_id AS page, 0 AS pos, user_id AS id, event_type AS title FROM events
          UNION ALL SELECT event_id, 1, event_id, props FROM events)
        ORDER BY page, pos LIMIT 500""",
    "paged_arrays": """
        SELECT event_id AS id, 3::INTEGER AS n_genres, user_id::INTEGER AS first_genre,
               user_id || ',' || event_id % 100 || ',none' AS genres FROM events""",
    "chunk_parts": _PARTS
    + """
SELECT part, count(*) AS row_count, min(position) AS first_position,
       min(o_totalprice) AS lowest, max(o_totalprice) AS highest
FROM parts GROUP BY part""",
    "part_files": _PARTS
    + """
SELECT part, count(*) AS row_count, min(o_totalprice) AS lowest, max(o_totalprice) AS highest
FROM parts GROUP BY part""",
    "load_report": """
        SELECT 'orders' AS table_name, 'success' AS status, count(*) AS row_count FROM orders
        UNION ALL SELECT 'customer', 'success', count(*) FROM customer
        UNION ALL SELECT 'supplier', 'success', count(*) FROM supplier
        UNION ALL SELECT 'missing', 'failed', NULL""",
    "load_in_order": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'success' AS status, count(*) AS row_count FROM {t}"
        for t in ("lineitem", "orders", "part", "customer")
    )
    + " UNION ALL SELECT 'missing', 'failed', NULL"
    + " UNION ALL SELECT 'supplier', 'skipped', NULL UNION ALL SELECT 'events', 'skipped', NULL",
    "stream_insert_buckets": """
        SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 4, o_orderkey) = 1""",
    "silver_load": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 'success' AS status, count(*) AS row_count FROM {rows}"
        for name, rows in _SILVER_SIZES.items()
    ),
    "target_checks": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{rule}' AS rule, CAST("
        f"{_BROKEN_KEYS.get(name, '0') if rule == 'primary key' else '0'} AS BIGINT) AS violations"
        for name, rules in _RULES.items()
        for rule in rules
    ),
    "target_checks_broken": _BROKEN.format(status=50, character=0),
    "target_checks_strict": _BROKEN.format(status=20, character="count(*) FILTER (part > 255)"),
    "stream_ingest": _KEYWORDS,
    "stream_insert_absent": """
        SELECT o_custkey, min(o_orderkey) AS o_orderkey,
               arg_min(o_orderpriority, o_orderkey) AS o_orderpriority
        FROM orders GROUP BY o_custkey""",
}
SQL["csv_reordered_parts"] = SQL["csv_roundtrip"]
SQL["chunk_parts_joined"] = """
    SELECT o_orderdate, o_orderkey, l_linenumber,
           row_number() OVER (ORDER BY o_orderdate, o_orderkey, l_linenumber) - 1 AS position
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""
