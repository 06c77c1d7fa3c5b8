"""Bronze: directories of quoted, multi-line CSV files in which every column is text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from silverloom.schemas import BRONZE_COLUMNS
from silverloom.session import spread_small, spread_unsplit

# A header, line breaks inside quotes, doubled quotes inside quotes.
CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"'}
#: Every file's header must be the one that the columns were read by; else the job fails.
CHECKED_HEADER = {"enforceSchema": False}
#: Records of one CSV file that this library writes: a multi-line file is read whole by one task,
#: so a large table is written as many files, some tens of MB each.
FILE_RECORDS = 100_000


def read_bronze(spark: SparkSession, path: str | Sequence[str], entity: str) -> DataFrame:
    """Read ``credits`` or ``movies``; columns are found by header name, others are ignored.

    The files under one path must have one header, or reading them fails. Part sets with headers
    of their own are given as several paths and are put together by name.

    A multi-line file is read by one task; rows of fewer files than cores are dealt out before
    their cells are parsed.
    """
    wanted = BRONZE_COLUMNS[entity]
    sets = []
    for one in [path] if isinstance(path, str) else path:
        df = spark.read.options(**CSV_OPTIONS, **CHECKED_HEADER).csv(one)
        missing = [c for c in wanted if c not in df.columns]
        if missing:
            raise ValueError(f"{entity}: columns missing from the header: {', '.join(missing)}")
        # All columns are parsed, so that each file's header can be compared with the first.
        sets.append(df.select(*wanted))
    return spread_unsplit(reduce(DataFrame.unionByName, sets))


def land_bronze(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Store a bronze frame in columns and read it back.

    A multi-line CSV file cannot be split, and each table built from it parses every cell of
    every row again. Landed once, each builder reads just the columns it needs in parallel.
    """
    spread_small(df).write.format(fmt).mode("overwrite").save(path)
    return df.sparkSession.read.format(fmt).load(path)
