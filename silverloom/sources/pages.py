"""Paged listings stored as JSON files, one ``{"page": n, "results": [...]}`` per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.functions.json_cells import UNLIMITED
from silverloom.schemas import LISTING


def read_pages(spark: SparkSession, path: str, record: T.StructType = LISTING) -> DataFrame:
    """Stored pages; a line that is no JSON of this shape fails the job when it is read, as a
    lost page would let records of later pages in."""
    schema = T.StructType(
        [T.StructField("page", T.LongType()), T.StructField("results", T.ArrayType(record))]
    )
    return spark.read.schema(schema).options(mode="FAILFAST", **UNLIMITED).json(path)


def concat_pages(pages: DataFrame, first: int) -> DataFrame:
    """Records of all pages in page order, of which the ``first`` are kept.

    The cut is the feature (a listing of fixed length) and runs as a distributed top-k.
    """
    records = pages.select("page", F.posexplode("results").alias("pos", "record"))
    kept = records.orderBy("page", "pos").limit(first)
    return kept.select("page", "pos", "record.*")
