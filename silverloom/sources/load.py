"""Load many tables and report on each."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from threading import Event, Thread
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverloom.session import run_each

REPORT_SCHEMA = "table_name string, target string, status string, row_count bigint, error string"


#: Seconds after a write within which its count should have arrived.
COUNT_WITHIN = 30


def _count(seen: Observation) -> int | None:
    """The observed count of a write that ran; None if it has not arrived in time."""
    found: list[int] = []
    waiting = Thread(target=lambda: found.append(seen.get.get("rows", 0)), daemon=True)
    waiting.start()
    waiting.join(COUNT_WITHIN)
    return found[0] if found else None


def _in_order(tables: Sequence[str], parents: Mapping[str, Sequence[str]]) -> list[str]:
    """Every table after its parents; ValueError for references in a circle."""
    left, placed = list(tables), []
    while left:
        ready = [t for t in left if not set(parents.get(t, ())) & set(left) - {t}]
        if not ready:
            raise ValueError(f"tables refer to each other in a circle: {', '.join(left)}")
        placed += ready
        left = [t for t in left if t not in ready]
    return placed


def load_tables(
    spark: SparkSession,
    mapping: Mapping[str, str],
    read: Callable[[str], DataFrame],
    write: Callable[[DataFrame, str], None],
    parents: Mapping[str, Sequence[str]] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Read and write every ``table -> target``; a failure is reported and the rest go on.

    ``parents`` names for a table those that it refers to. It starts when they are loaded, and
    is reported as ``skipped`` if one of them was not; tables that do not wait for each other are
    loaded side by side. References to tables outside ``mapping`` or to itself bind nothing.

    ``write`` must run an action on the frame it is given; a table whose write ran no job counts
    as failed. Rows are counted while they are written, not by a second scan; a count that is
    late is reported as NULL. Rows of the report are in the order of ``mapping``.
    """
    parents = parents or {}
    done = {table: Event() for table in mapping}
    loaded: set[str] = set()
    tracker = spark.sparkContext.statusTracker()

    def attempt(table: str):
        target = mapping[table]
        above = [p for p in parents.get(table, ()) if p in mapping and p != table]
        for parent in above:
            done[parent].wait()
        lacking = [p for p in above if p not in loaded]
        if lacking:
            return table, target, "skipped", None, f"not loaded: {', '.join(lacking)}"
        group = f"load-{uuid4().hex}"
        spark.sparkContext.setJobGroup(group, f"load {table}")
        seen = Observation()
        write(read(table).observe(seen, F.count(F.lit(1)).alias("rows")), target)
        rows = _count(seen)
        if rows is None and not tracker.getJobIdsForGroup(group):
            raise RuntimeError("write ran no action on the frame that it was given")
        return table, target, "success", rows, None

    def load(table: str):
        try:
            row = attempt(table)
            if row[2] == "success":
                loaded.add(table)
            return row
        except Exception as e:  # any failure belongs in the report
            message = f"{type(e).__name__}: {e}".splitlines()[0]
            return table, mapping[table], "failed", None, message
        finally:
            done[table].set()

    # Tables are taken up in this order, so whoever waits, waits for one that has started.
    order = _in_order(list(mapping), parents)
    rows = dict(zip(order, run_each(spark, order, load, parallelism)))
    return spark.createDataFrame([rows[table] for table in mapping], REPORT_SCHEMA)


def failed_tables(report: DataFrame) -> list[str]:
    """Names of the tables that are not loaded; a job should exit non-zero if there are any."""
    failed = report.where("status <> 'success'").orderBy("table_name")
    return [r.table_name for r in failed.select("table_name").collect()]
