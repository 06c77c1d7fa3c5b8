"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import os
import shutil
import string
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.session import scratch_path

#: ASCII white space, as a character class body for both Java's and Python's expressions.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage, so that a lost executor costs no earlier step, and gives the planner a
    true size. The caller may name (and then owns) the place.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for functions that run there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="code-")  # the driver serves the archive until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def append_columns(
    df: DataFrame,
    source: str,
    new: Mapping[str, str],
    work: Callable[[pa.Array], Iterable[tuple[Sequence[int] | None, Sequence[pa.Array]]]],
) -> DataFrame:
    """``df`` with columns that ``work`` makes from the bytes of one column, batch by batch.

    ``work`` yields pieces of a batch: places of rows (None: all of them, in order) and their new
    columns. ``new`` gives names and types; columns of these names are replaced. Names of
    other columns may hold any characters.
    """
    if source in new:
        raise ValueError("the new columns need names of their own")
    ship_code(df.sparkSession)
    given = df.withColumn("__source", F.col(f"`{source}`").cast("binary")).drop(*new)
    kept = given.drop("__source").columns
    short = [f"c{i}" for i in range(len(kept))]
    made = [f"n{i}" for i in range(len(new))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.select(short)
            for places, columns in work(batch.column("source")):
                rows = part if places is None else part.take(pa.array(places, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, *columns], [*short, *made])

    kinds = [f.dataType.simpleString() for f in given.schema][: len(kept)] + list(new.values())
    schema = ", ".join(f"{n} {kind}" for n, kind in zip([*short, *made], kinds))
    return given.toDF(*short, "source").mapInArrow(run, schema).toDF(*kept, *new)


def words(text: Column) -> Column:
    """The maximal runs of characters other than ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on equally named and typed keys, never null, that stays open to skew splitting.

    A side that was grouped by the keys has no exchange of its own, and then a hot key of the
    other side cannot be cut. The equality of the hashes follows from that of the keys and
    makes both sides exchange.
    """
    names = {k: f"__right_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [left[k] == right[v] for k, v in names.items()])
    hashes = F.xxhash64(*[left[k] for k in keys]) == F.xxhash64(*[right[v] for v in names.values()])
    joined = left.join(right, same & hashes, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names.values())
