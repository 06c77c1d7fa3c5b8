"""Bronze -> silver: eight tables, each one narrow stage without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.functions import cast_to
from silverloom.functions.json_cells import NATIVE
from silverloom.operators.objects import explode_objects
from silverloom.schemas import MOVIES, OBJECT_TABLES, SILVER_TABLES
from silverloom.sources.load import load_tables
from silverloom.sources.tables import write_table


def build_movies(bronze: DataFrame) -> DataFrame:
    """One typed row per movie; bad text becomes NULL and nothing is imputed."""
    return bronze.select(
        *[
            cast_to(F.col("id" if f.name == "movie_id" else f.name), f.dataType).alias(f.name)
            for f in MOVIES
        ]
    )


def build_objects(bronze: DataFrame, table: str, quote_mode: str = NATIVE) -> DataFrame:
    """One of the seven tables that flatten a JSON cell."""
    spec = OBJECT_TABLES[table]
    return explode_objects(
        bronze, spec.cell, spec.keep, spec.fields, spec.casts, spec.fills, quote_mode
    )


def build_silver(
    credits: DataFrame, movies: DataFrame, quote_mode: str = NATIVE
) -> dict[str, DataFrame]:
    """All eight tables, lazily. Use landed bronze frames: each table scans its own columns."""
    sources = {"credits": credits, "movies": movies}
    tables = {"movies": build_movies(movies)}
    for name, spec in OBJECT_TABLES.items():
        tables[name] = build_objects(sources[spec.source], name, quote_mode)
    return tables


def write_silver(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    write: Callable[[DataFrame, str], None] = write_table,
) -> DataFrame:
    """Replace the silver tables under ``root``; reports rows written per table."""
    targets = {name: f"{root.rstrip('/')}/{name}" for name in SILVER_TABLES if name in tables}
    return load_tables(spark, targets, lambda name: tables[name], write)
