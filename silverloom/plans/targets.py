"""What a relational target would refuse: run before the load, over all tables at once."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.operators.conform import conversions
from silverloom.operators.ordering import union_all
from silverloom.schemas import TARGETS, TargetTable

PARENT = "movies"
TYPE, LENGTH, PRIMARY, FOREIGN = "type", "length", "primary key", "foreign key"


def check_targets(
    tables: Mapping[str, DataFrame], targets: Mapping[str, TargetTable] = TARGETS
) -> DataFrame:
    """``(table_name, rule, violations)`` for each rule of each table.

    ``type`` counts values lost in the cast to the target's types, ``primary key`` the keys
    that are NULL or repeated, ``foreign key`` the rows without a parent, ``length`` the
    values that are too long. The last three look at the rows as they would be loaded.

    Each table is converted and scanned once. A row gives its key with its own counts, and the
    key that it refers to; all keys of all tables go through one aggregate by (rule, key), which is
    partial before its shuffle, so a key that owns much of a table arrives as one row per task.
    Children and parents meet there too, without a join.
    """
    with_parent = PARENT in tables
    measured = union_all([_measures(df, name, targets[name], with_parent) for name, df in tables.items()])
    total = lambda c: F.sum(c).alias(c)
    by_key = measured.groupBy("rule", "owner", "key").agg(
        total("lost"),
        total("long"),
        total("rows"),
        F.max("partial").alias("partial"),
        F.max("is_parent").alias("is_parent"),
        # Rows of each child that refer to the key.
        *[F.sum(F.when(F.col("table_name") == n, F.col("refers"))).alias(f"refers_{n}") for n in tables],
    )
    broken_key = (F.col("rule") == PRIMARY) & ((F.col("rows") > 1) | F.col("partial"))
    orphaned = (F.col("rule") == FOREIGN) & ~F.col("is_parent")

    def count(test: Column, value: Column | None = None) -> Column:
        value = F.lit(1) if value is None else value
        return F.coalesce(F.sum(F.when(test, value)), F.lit(0)).cast("bigint")

    sums, entries = [], []
    for name, target in tables.items():
        target = targets[name]
        own = F.col("owner") == name
        found = {TYPE: count(own, F.col("lost")), PRIMARY: count(own & broken_key)}
        if target.lengths:
            found[LENGTH] = count(own, F.col("long"))
        if target.foreign_key is not None and with_parent:
            found[FOREIGN] = count(orphaned, F.col(f"refers_{name}"))
        for rule, violations in found.items():
            column = f"v{len(sums)}"
            sums.append(violations.alias(column))
            entries.append(
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(rule).alias("rule"),
                    F.col(column).alias("violations"),
                )
            )
    return by_key.agg(*sums).select(F.inline(F.array(*entries))).orderBy("table_name", "rule")


def _measures(df: DataFrame, name: str, target: TargetTable, with_parent: bool) -> DataFrame:
    """For each row of a table its counts with its primary key, and the key that it refers to."""
    values = conversions(df, target.schema)
    lost = [old.isNotNull() & new.isNull() for old, new in values.values()]
    long = [F.char_length(values[c][1]) > n for c, n in target.lengths.items()]

    def number(tests: list[Column]) -> Column:
        flags = [F.when(test, 1).otherwise(0).cast("bigint") for test in tests]
        return reduce(Column.__add__, flags) if flags else F.lit(0).cast("bigint")

    def entry(rule: str, owner: str, key: Column, **given: Column) -> Column:
        fields = {
            "key": key,
            "lost": F.lit(0).cast("bigint"),
            "long": F.lit(0).cast("bigint"),
            "rows": F.lit(1).cast("bigint"),
            "partial": F.lit(False),
            "is_parent": F.lit(False),
            "refers": F.lit(0).cast("bigint"),
        } | given
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(owner).alias("owner"),
            *[c.alias(n) for n, c in fields.items()],
        )

    def key_text(columns: tuple[str, ...]) -> Column:
        # Parts keep their names, so that a missing one differs from any text.
        return F.to_json(F.struct(*[values[c][1].alias(f"p{i}") for i, c in enumerate(columns)]))

    keys = [values[k][1] for k in target.primary_key]
    has_null = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    counts = {"lost": number(lost), "long": number(long)}
    entries = [entry(PRIMARY, name, key_text(target.primary_key), partial=has_null, **counts)]
    if with_parent and name == PARENT:
        entries.append(entry(FOREIGN, "", key_text(target.primary_key[:1]), is_parent=~keys[0].isNull()))
    elif with_parent and target.foreign_key is not None:
        refers = values[target.foreign_key][1].isNotNull().cast("bigint")
        entries.append(entry(FOREIGN, "", key_text((target.foreign_key,)), refers=refers))
    return df.select(F.inline(F.array(*entries))).select(F.lit(name).alias("table_name"), "*")
