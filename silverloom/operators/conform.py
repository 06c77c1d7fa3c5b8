"""Fit a frame to a declared schema, and count what the fit would lose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.functions import cast_to


def conversions(df: DataFrame, schema: T.StructType) -> dict[str, tuple[Column, Column]]:
    """Per column of the schema, its value before and after the cast."""
    present = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in schema if f.name not in present]
    if missing:
        raise ValueError(f"columns missing from the frame: {', '.join(missing)}")
    return {
        f.name: (
            F.col(f"`{f.name}`"),
            cast_to(F.col(f"`{f.name}`"), f.dataType, present[f.name]),
        )
        for f in schema
    }


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in its order and types; unconvertible values become NULL."""
    return df.select(*[new.alias(name) for name, (_, new) in conversions(df, schema).items()])


def conform_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per column: type before and after, non-null values, values the cast loses.

    A single scan with one global aggregate, whatever the number of columns.
    """
    before = {f.name: f.dataType.simpleString() for f in df.schema}
    columns = conversions(df, schema)
    counters = []
    for i, (old, new) in enumerate(columns.values()):
        counters.append(F.count(old).alias(f"present_{i}"))
        counters.append(F.count_if(old.isNotNull() & new.isNull()).alias(f"lost_{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(before[f.name]).alias("from_type"),
                F.lit(f.dataType.simpleString()).alias("to_type"),
                F.col(f"present_{i}").alias("present"),
                F.col(f"lost_{i}").alias("lost"),
            )
            for i, f in enumerate(schema)
        ]
    )
    return df.agg(*counters).select(F.inline(rows))
