"""The test tables, and bronze frames that Spark derives from them row by row.

Orders stand in for movies and line items for credits. The JSON cells are written with the
defects the parser must cope with: JSON nulls, missing keys, single quotes, apostrophes,
ids that are not numbers, empty and truncated text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.session import spread_small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table whose rows are about to be written as text and parsed again."""
    return spread_small(table(spark, sf_dir, name).select(*columns))


def _text(pattern: str, *columns: Column) -> Column:
    """Fill ``%s`` places by concatenation, which is code-generated (``format_string`` is not)."""
    first, *rest = pattern.split("%s")
    pieces = [F.lit(first)]
    for column, text in zip(columns, rest, strict=True):
        pieces += [column.cast("string"), F.lit(text)]
    return F.concat(*pieces)


def bronze_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice").cast("string")
    title = _text("Order %s", key)
    orders = spread_table(
        spark,
        sf_dir,
        "orders",
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )
    return orders.select(
        key.cast("string").alias("id"),
        title.alias("title"),
        F.when(status == "P", "unknown").otherwise(price).alias("budget"),
        F.when(status != "F", _text("http://example.com/%s", key)).alias("homepage"),
        F.lower(status).alias("original_language"),
        title.alias("original_title"),
        _text('The "%s" one,\nby customer %s.', priority, cust).alias("overview"),
        _text("%s.5", cust).alias("popularity"),
        F.when(priority == "5-LOW", "2020-13-45")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("release_date"),
        price.alias("revenue"),
        _text("%s.7", cust).alias("runtime"),
        status.alias("status"),
        priority.alias("tagline"),
        _text("%s.25", cust).alias("vote_average"),
        cust.cast("string").alias("vote_count"),
        _text(
            '[{"id": %s, "name": "%s"}, {"id": null, "name": "%s"}]', cust, priority, status
        ).alias("genres"),
        F.when(status == "O", "")
        .otherwise(_text("[{'id': %s, 'name': 'kept %s'}]", cust, status))
        .alias("keywords"),
        _text(
            '[{"id": "x%s", "name": "O\'Brien"}, {"id": %s.0, "name": "Plain"}]', cust, cust
        ).alias("production_companies"),
        _text(
            '[{"iso_3166_1": "%s", "name": "%s"}, {"name": "none"}]', status, priority
        ).alias("production_countries"),
        F.when(status == "F", '[{"iso_639_1": "en", "na')
        .otherwise(_text('[{"iso_639_1": "%s", "name": null}, null]', status))
        .alias("spoken_languages"),
    )


def bronze_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    line = F.col("l_linenumber")
    lines = spread_table(
        spark,
        sf_dir,
        "lineitem",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
    )
    return lines.select(
        F.col("l_orderkey").cast("string").alias("movie_id"),
        _text("Order %s", F.col("l_orderkey")).alias("title"),
        _text(
            '[{"cast_id": %s, "character": "The \\"Part\\"", "credit_id": "p%s", "gender": 1, '
            '"id": %s, "name": "Part %s"}, '
            '{"cast_id": %s, "character": "Maker", "gender": 2, "id": %s, "name": "Supplier %s"}]',
            line, part, part, part, line, supp, supp,
        ).alias("cast"),
        _text(
            '[{"credit_id": null, "department": "%s", "gender": 0, "id": %s, "job": "%s", '
            '"name": "Supplier %s"}]',
            F.col("l_linestatus"),
            supp,
            F.when(F.col("l_returnflag") == "R", "Director").otherwise("Editor"),
            supp,
        ).alias("crew"),
    )
