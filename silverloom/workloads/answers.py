"""The analytic questions, on the nearest test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverloom.operators import row_counts, substring_index, top_k
from silverloom.plans import (
    actor_topk,
    build_movies,
    build_objects,
    career_history,
    genre_revenue,
    team_consistency,
    year_revenue,
)
from silverloom.session import scratch_path
from silverloom.sources import read_table, write_table
from silverloom.workloads.inputs import bronze_credits, bronze_movies, table

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _actor(spark, sf, **options):
    movies = table(spark, sf, "orders").withColumnRenamed("o_custkey", "movie_id")
    cast = table(spark, sf, "customer").withColumnRenamed("c_custkey", "movie_id")
    return actor_topk(
        movies, cast, title="o_orderkey", revenue="o_totalprice", name="c_name", **options
    ).withColumnRenamed("title", "o_orderkey")


def q_actor_topk(spark, sf):
    return _actor(spark, sf, name_contains="00012")


def q_actor_topk_ignore_case(spark, sf):
    return _actor(spark, sf, name_contains="CUSTOMER#", k=20, ignore_case=True)


def _name_index(spark, sf, ignore_case=False):
    path = scratch_path(spark, "names")
    substring_index(table(spark, sf, "customer"), "c_name", ignore_case).write.parquet(path)
    return spark.read.parquet(path)


def q_actor_topk_indexed(spark, sf):
    return _actor(spark, sf, name_contains="00012", index=_name_index(spark, sf))


def q_actor_topk_indexed_ignore_case(spark, sf):
    """A pattern of two characters, which is a piece of the index itself."""
    index = _name_index(spark, sf, ignore_case=True)
    return _actor(spark, sf, name_contains="R#", k=20, ignore_case=True, index=index)


def q_genre_revenue(spark, sf):
    movies = table(spark, sf, "orders").withColumnRenamed("o_custkey", "movie_id")
    genres = table(spark, sf, "customer").withColumnRenamed("c_custkey", "movie_id")
    found = genre_revenue(movies, genres, revenue="o_totalprice", name="c_mktsegment")
    return found.withColumn("avg_revenue", F.round("avg_revenue", 2))


def q_year_revenue(spark, sf):
    found = year_revenue(
        table(spark, sf, "orders"), released="o_orderdate", revenue="o_totalprice"
    )
    return found.withColumn("avg_revenue", F.round("avg_revenue", 2))


def _team(spark, sf, **options):
    return team_consistency(
        table(spark, sf, "lineitem"),
        F.col("l_returnflag") == "R",
        movie_id="l_orderkey",
        name="l_suppkey",
        **options,
    ).withColumnRenamed("lead", "l_suppkey")


def q_team_consistency(spark, sf):
    return _team(spark, sf)


def q_team_consistency_hot(spark, sf):
    """Suppliers per (flag, status) group: few huge groups."""
    return _huge_teams(spark, sf, "l_suppkey")


def q_team_consistency_dense(spark, sf):
    """Parts per (flag, status) group: thousands of names in each, so bitmaps answer."""
    return _huge_teams(spark, sf, "l_partkey")


def _huge_teams(spark, sf, name):
    lines = table(spark, sf, "lineitem").withColumn(
        "team", F.concat("l_returnflag", "l_linestatus")
    )
    return team_consistency(
        lines, F.col("l_discount") > 0.05, k=50, movie_id="team", name=name
    ).withColumnRenamed("lead", name)


def q_career_history(spark, sf):
    names = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    crew = lines.join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_orderpriority",
        F.to_date("o_orderdate").alias("o_orderdate"),
    )
    return career_history(
        crew,
        orders,
        "Supplier#000000007",
        movie_id="l_orderkey",
        name="s_name",
        role="l_returnflag",
        title="o_orderpriority",
        released="o_orderdate",
    )


def q_row_counts(spark, sf):
    return row_counts({name: table(spark, sf, name) for name in TABLES})


def q_nulls_order(spark, sf):
    shown = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("final_price"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("open_priority"),
    )
    order = [
        F.asc_nulls_first("open_priority"),
        F.desc_nulls_last("final_price"),
        F.asc("o_orderkey"),
    ]
    return top_k(shown, order, 25)


def q_silver_genre_revenue(spark, sf):
    """From text cells to the answer: parse, explode, cast, join, aggregate, rank."""
    bronze = bronze_movies(spark, sf)
    found = genre_revenue(build_movies(bronze), build_objects(bronze, "genres"))
    return found.withColumn("avg_revenue", F.round("avg_revenue", 2))


def q_silver_year_revenue(spark, sf):
    found = year_revenue(build_movies(bronze_movies(spark, sf)))
    return found.withColumn("avg_revenue", F.round("avg_revenue", 2))


def q_silver_actor_topk(spark, sf):
    movies = build_movies(bronze_movies(spark, sf))
    return actor_topk(movies, build_objects(bronze_credits(spark, sf), "cast"), "Part 17", k=10)


def q_silver_team_consistency(spark, sf):
    """Stored first: the question reads the crew several times, the cells are parsed once."""
    crew, path = build_objects(bronze_credits(spark, sf), "crew"), scratch_path(spark, "crew")
    write_table(crew.select("movie_id", "name", "job"), path)
    found = team_consistency(read_table(spark, path), F.col("job") == "Director")
    return found.withColumnRenamed("lead", "director")


QUERIES = {
    "actor_topk": q_actor_topk,
    "actor_topk_ignore_case": q_actor_topk_ignore_case,
    "actor_topk_indexed": q_actor_topk_indexed,
    "actor_topk_indexed_ignore_case": q_actor_topk_indexed_ignore_case,
    "genre_revenue": q_genre_revenue,
    "year_revenue": q_year_revenue,
    "team_consistency": q_team_consistency,
    "team_consistency_hot": q_team_consistency_hot,
    "team_consistency_dense": q_team_consistency_dense,
    "career_history": q_career_history,
    "row_counts": q_row_counts,
    "nulls_order": q_nulls_order,
    "silver_genre_revenue": q_silver_genre_revenue,
    "silver_year_revenue": q_silver_year_revenue,
    "silver_actor_topk": q_silver_actor_topk,
    "silver_team_consistency": q_silver_team_consistency,
}

_ACTOR = """
SELECT o.o_orderkey, o.o_totalprice AS revenue, c.c_name AS name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE {where}
ORDER BY o.o_totalprice DESC NULLS LAST, o.o_orderkey, c.c_name LIMIT {k}
"""

# Counted apart: what a lead led, whom those movies name, and positions per lead row.
_TEAM = """
WITH credited AS (SELECT {movie} AS movie, {name} AS person, {lead} AS leads FROM {rows}),
led AS (SELECT movie, person, count(*) AS n FROM credited WHERE leads GROUP BY ALL),
named AS (SELECT movie, count(person) AS positions FROM credited GROUP BY movie),
around AS (SELECT DISTINCT led.person, c.person AS member
           FROM led JOIN (SELECT DISTINCT movie, person FROM credited) c USING (movie)),
team AS (SELECT person, count(member) AS unique_crew_members FROM around GROUP BY person)
SELECT led.person AS {out}, count(*) AS movie_count,
       any_value(team.unique_crew_members) AS unique_crew_members,
       CAST(sum(led.n * named.positions) AS BIGINT) AS total_crew_positions
FROM led JOIN named USING (movie) JOIN team ON team.person = led.person
GROUP BY led.person HAVING count(*) > 1
ORDER BY movie_count DESC, {out} LIMIT {k}
"""

_CREW = """(
SELECT l_orderkey AS movie_id, 'Supplier ' || l_suppkey AS name, l_returnflag AS flag FROM lineitem)"""

# Over a few huge teams a plain self-join has too many pairs, so this states the same answer
# through distinct (team, name) rows.
_TEAM_HOT = """
WITH lines AS (
  SELECT l_returnflag || l_linestatus AS team, l_suppkey, l_discount > 0.05 AS lead FROM lineitem),
led AS (SELECT team, l_suppkey, count(*) AS n FROM lines WHERE lead GROUP BY ALL),
sizes AS (SELECT team, count(*) AS positions FROM lines GROUP BY team),
members AS (SELECT DISTINCT team, l_suppkey AS member FROM lines),
reach AS (
  SELECT led.l_suppkey, count(DISTINCT member) AS unique_crew_members
  FROM led JOIN members USING (team) GROUP BY led.l_suppkey)
SELECT led.l_suppkey, count(*) AS movie_count, any_value(unique_crew_members) AS unique_crew_members,
       CAST(sum(n * positions) AS BIGINT) AS total_crew_positions
FROM led JOIN sizes USING (team) JOIN reach USING (l_suppkey)
GROUP BY led.l_suppkey HAVING count(*) > 1
ORDER BY movie_count DESC, led.l_suppkey LIMIT 50
"""

SQL = {
    "actor_topk": _ACTOR.format(where="c.c_name LIKE '%00012%'", k=5),
    "actor_topk_ignore_case": _ACTOR.format(where="c.c_name ILIKE '%CUSTOMER#%'", k=20),
    "actor_topk_indexed": _ACTOR.format(where="c.c_name LIKE '%00012%'", k=5),
    "actor_topk_indexed_ignore_case": _ACTOR.format(where="c.c_name ILIKE '%R#%'", k=20),
    "genre_revenue": """
        SELECT c.c_mktsegment AS genre, round(avg(o.o_totalprice), 2) AS avg_revenue,
               count(*) AS movie_count
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_totalprice > 0 GROUP BY c.c_mktsegment
        ORDER BY avg(o.o_totalprice) DESC NULLS LAST, genre LIMIT 10""",
    "year_revenue": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
               round(avg(o_totalprice), 2) AS avg_revenue, count(*) AS movie_count
        FROM orders WHERE o_totalprice > 0 AND o_orderdate IS NOT NULL
        GROUP BY year(o_orderdate) ORDER BY year DESC LIMIT 20""",
    "team_consistency": _TEAM.format(
        name="l_suppkey",
        out="l_suppkey",
        movie="l_orderkey",
        rows="lineitem",
        lead="l_returnflag = 'R'",
        k=10,
    ),
    "team_consistency_hot": _TEAM_HOT,
    "team_consistency_dense": _TEAM_HOT.replace("l_suppkey", "l_partkey"),
    "career_history": """
        SELECT s_name AS name, CAST(o_orderdate AS DATE) AS release_date,
               o_orderpriority AS title, l_returnflag AS role
        FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON o_orderkey = l_orderkey
        WHERE s_name = 'Supplier#000000007'""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    ),
    "nulls_order": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS final_price,
               CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS open_priority
        FROM orders
        ORDER BY open_priority ASC NULLS FIRST, final_price DESC NULLS LAST, o_orderkey LIMIT 25""",
    "silver_genre_revenue": """
        SELECT genre, round(avg(o_totalprice), 2) AS avg_revenue, count(*) AS movie_count
        FROM (SELECT o_orderpriority AS genre, o_totalprice FROM orders
              UNION ALL SELECT o_orderstatus, o_totalprice FROM orders)
        WHERE o_totalprice > 0 GROUP BY genre
        ORDER BY avg(o_totalprice) DESC, genre LIMIT 10""",
    "silver_year_revenue": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
               round(avg(o_totalprice), 2) AS avg_revenue, count(*) AS movie_count
        FROM orders WHERE o_totalprice > 0 AND o_orderpriority <> '5-LOW'
        GROUP BY year(o_orderdate) ORDER BY year DESC LIMIT 20""",
    "silver_actor_topk": """
        SELECT 'Order ' || o_orderkey AS title, o_totalprice AS revenue, 'Part ' || l_partkey AS name
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE 'Part ' || l_partkey LIKE '%Part 17%'
        ORDER BY revenue DESC NULLS LAST, title, name LIMIT 10""",
    "silver_team_consistency": _TEAM.format(
        name="name", out="director", movie="movie_id", rows=_CREW, lead="flag = 'R'", k=10
    ),
}
