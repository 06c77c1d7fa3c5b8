"""Rows as search documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONNECTOR = "org.elasticsearch.spark.sql"


def to_search_docs(df: DataFrame, index: str, id_column: str | None = None) -> DataFrame:
    """``(_index, _id, _source)`` with the row as JSON.

    Give an id column only if it is unique; with ``None`` the id is left to the search store.
    """
    doc_id = F.lit(None) if id_column is None else F.col(f"`{id_column}`")
    return df.select(
        F.lit(index).alias("_index"),
        doc_id.cast("string").alias("_id"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("_source"),
    )


def write_search_docs(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Documents as JSON lines, for a bulk loader."""
    docs.write.mode(mode).json(path)


def write_search_index(
    df: DataFrame,
    index: str,
    id_column: str | None = None,
    options: Mapping[str, str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Hand rows to the search connector, if its jar is on the classpath."""
    settings = {"es.index.auto.create": "true", **(options or {}), "es.resource": f"{index}/_doc"}
    if id_column is not None:
        settings["es.mapping.id"] = id_column
    df.write.format(CONNECTOR).options(**settings).mode(mode).save()
