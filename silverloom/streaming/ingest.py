"""Incremental ingest of part files that arrive over time.

Each run takes the files that are new since the last one and stops (``availableNow``), so it
can be scheduled like a batch job. Progress and state live in the checkpoint location.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverloom.functions.json_cells import NATIVE
from silverloom.operators.dml import absent_rows
from silverloom.plans.silver import build_movies, build_objects
from silverloom.schemas import BRONZE_COLUMNS, OBJECT_TABLES
from silverloom.sources.bronze import CHECKED_HEADER, CSV_OPTIONS


def stream_bronze(
    spark: SparkSession, path: str, entity: str, files_per_batch: int | None = None
) -> DataFrame:
    """Bronze CSV as a stream, with the column order taken from the headers present."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).schema
    reader = spark.readStream.schema(header).options(**CSV_OPTIONS, **CHECKED_HEADER)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path).select(*BRONZE_COLUMNS[entity])


def ingest_table(
    spark: SparkSession,
    source: str,
    table: str,
    target: str,
    checkpoint: str,
    quote_mode: str = NATIVE,
    files_per_batch: int | None = None,
    fmt: str = "parquet",
) -> None:
    """Append one silver table from the new bronze files; every file is taken exactly once."""
    if table == "movies":
        rows = build_movies(stream_bronze(spark, source, "movies", files_per_batch))
    else:
        entity = OBJECT_TABLES[table].source
        bronze = stream_bronze(spark, source, entity, files_per_batch)
        rows = build_objects(bronze, table, quote_mode)
    query = (
        rows.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()


#: Column by which a bucketed target is partitioned.
BUCKET = "key_bucket"


def _bucketed(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    number = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets)).cast("int")
    return df.withColumn(BUCKET, number)


def touched_part(
    spark: SparkSession, target: str, batch: DataFrame, fmt: str = "parquet"
) -> DataFrame:
    """The rows of a bucketed target that a bucketed batch could meet: a scan of its buckets only.

    The bucket numbers are collected; there are no more of them than the target has buckets.
    """
    numbers = [r[0] for r in batch.select(BUCKET).distinct().collect()]
    existing = spark.read.schema(batch.schema).format(fmt).load(target)
    return existing.where(F.col(BUCKET).isin(numbers))


def ingest_absent(
    stream: DataFrame,
    target: str,
    key: str | Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
    fmt: str = "parquet",
    buckets: int | None = None,
) -> None:
    """Append the rows of a stream whose key the target lacks; the first row per key wins.

    A batch that is run again after a failure finds its keys present and adds nothing twice.

    With ``buckets`` the target is partitioned by that many hash buckets of its key, in a column
    ``key_bucket``, and a batch reads only the buckets of its own keys; otherwise it reads
    the keys of the whole target. The number belongs to the target: give the same one each time.
    Small batches touch few buckets; a batch with many keys touches all, and then reads as much
    as without.
    """
    spark = stream.sparkSession
    names = [key] if isinstance(key, str) else list(key)
    if buckets is not None:
        if buckets < 1:
            raise ValueError("a target has one bucket or more")
        stream = _bucketed(stream, names, buckets)
    schema = stream.schema

    def add(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if buckets is None:
            existing = session.read.schema(schema).format(fmt).load(target)
        else:
            existing = touched_part(session, target, batch, fmt)
        writer = absent_rows(existing, batch, names, order_by).write.mode("append").format(fmt)
        (writer if buckets is None else writer.partitionBy(BUCKET)).save(target)

    _ensure_table(spark, schema, target, fmt, buckets is not None)
    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _ensure_table(
    spark: SparkSession, schema: StructType, target: str, fmt: str, bucketed: bool
) -> None:
    """An empty table at a new path, so that the first batch can read it too. A target that is
    there must be bucketed if, and only if, this ingest is."""
    try:
        found = spark.read.format(fmt)
        found = found.load(target) if bucketed else found.schema(schema).load(target)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        writer = spark.createDataFrame([], schema).write.mode("ignore").format(fmt)
        (writer.partitionBy(BUCKET) if bucketed else writer).save(target)
        return
    if bucketed and BUCKET not in found.columns:
        raise ValueError(f"the target at {target} has no buckets")
