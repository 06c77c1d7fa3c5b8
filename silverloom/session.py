"""Session-level helpers: scratch folders, partition counts, independent jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

A = TypeVar("A")
B = TypeVar("B")


def _shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, the checkpoint folder in use, or else the
    warehouse: in each case a place that the cluster's file system resolves for all executors."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_root(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path not used before, in the shared folder."""
    return f"{_shared_root(spark).rstrip('/')}/silverloom/{label}-{uuid.uuid4().hex}"


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate; None where it only has its huge default."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else None


def spread_small(df: DataFrame) -> DataFrame:
    """Deal the rows of a small table out to all cores, ahead of costly row-local work.

    A scan is never split finer than ``spark.sql.files.openCostInBytes``, so a table below
    that size per core leaves cores idle, and is cheap to exchange. Larger tables and streams
    are returned as they are.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    size = estimated_bytes(df)
    return df.repartition(cores) if size is not None and size < cores * split else df


def spread_unsplit(df: DataFrame) -> DataFrame:
    """As :func:`spread_small`, for files that cannot be split, whatever their size."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def run_each(
    spark: SparkSession, items: Iterable[A], job: Callable[[A], B], parallelism: int = 4
) -> list[B]:
    """Run independent jobs side by side, so that one table's last tasks do not leave the
    cluster idle; results keep the order of the items."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(job), items))
