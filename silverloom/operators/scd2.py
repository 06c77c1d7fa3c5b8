"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverloom.operators.dml import ambiguous_rows, shared_keys
from silverloom.operators.skew import exchanged, key_of

_VERSION = "__version"


def _changed(tracked: Sequence[str], flag: str, null_safe: bool) -> Column:
    """The current row differs in a tracked column.

    By default a NULL on either side counts as no change (three-valued ``<>``).
    """

    def differs(c: str) -> Column:
        new, old = F.col(f"u.`{c}`"), F.col(f"d.`{c}`")
        return ~new.eqNullSafe(old) if null_safe else new != old

    any_change = reduce(lambda a, b: a | b, [differs(c) for c in tracked])
    return F.coalesce((F.col(f"d.`{flag}`") == F.lit(True)) & any_change, F.lit(False))


def scd2_stage(
    dim: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    flag: str = "is_current",
    merge_key: str = "merge_key",
    null_safe: bool = False,
) -> DataFrame:
    """Rows to MERGE on ``merge_key``: every update under its key, which closes the current
    version, and once more under a NULL key for each changed current row, which never matches
    and so inserts the new version."""
    u = updates.alias("u")
    fields = [F.col(f"u.`{c}`") for c in updates.columns]
    reopened = u.join(
        dim.alias("d"),
        (F.col(f"u.`{key}`") == F.col(f"d.`{key}`")) & _changed(tracked, flag, null_safe),
    ).select(F.lit(None).cast(updates.schema[key].dataType).alias(merge_key), *fields)
    return reopened.union(u.select(F.col(f"u.`{key}`"), *fields))


def scd2_apply(
    dim: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    flag: str = "is_current",
    start: str = "valid_from",
    end: str = "valid_to",
    null_safe: bool = False,
    reopen_closed: bool = False,
) -> DataFrame:
    """Close changed current rows, add their new versions, add unknown keys.

    Gives the rows that merging :func:`scd2_stage` would give, from one pass over the
    dimension: the left join that finds the row to close already carries its successor, so
    each hit becomes two rows in place. The dimension is the streamed side; its keys are read
    once more, alone, to find unknown keys.

    An update whose key has only closed rows does nothing, unless ``reopen_closed`` makes it
    start a new version. Two updates that would both close the same row make
    the job fail with :data:`AmbiguousMerge`; :func:`scd2_chain` builds their versions instead.
    """
    changed = _changed(tracked, flag, null_safe)
    checked = ambiguous_rows(dim, updates, {key: key}, changed, "d", "u")

    joined = dim.alias("d").join(
        updates.alias("u"),
        exchanged([key_of(dim, key, "d")], [key_of(updates, key, "u")]) & changed,
        "left",
    )
    hit = F.col(f"u.`{key}`").isNotNull()
    versions = F.when(hit, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    is_new = F.col(_VERSION) == 1

    def fresh(name: str) -> Column:
        if name == flag:
            return F.lit(True)
        if name == end or name not in updates.columns:
            return F.lit(None)
        return F.col(f"u.`{name}`")

    def kept(name: str) -> Column:
        if name == flag:
            return F.when(hit, F.lit(False)).otherwise(F.col(f"d.`{name}`"))
        if name == end:
            return F.when(hit, F.col(f"u.`{start}`").cast(dim.schema[end].dataType)).otherwise(
                F.col(f"d.`{name}`")
            )
        return F.col(f"d.`{name}`")

    rows = joined.select("*", F.explode(versions).alias(_VERSION)).select(
        *[
            F.when(is_new, fresh(f.name).cast(f.dataType)).otherwise(kept(f.name)).alias(f.name)
            for f in dim.schema
        ]
    )

    known = dim.where(F.col(f"`{flag}`") == F.lit(True)) if reopen_closed else dim
    present = shared_keys(known, updates, {key: key})
    unknown = exchanged([key_of(updates, key, "u")], [key_of(present, key, "p")])
    added = (
        updates.alias("u")
        .join(present.alias("p"), unknown, "left_anti")
        .alias("u")
        .select(*[fresh(f.name).cast(f.dataType).alias(f.name) for f in dim.schema])
    )
    return rows.unionByName(added).unionByName(checked)


def scd2_chain(
    dim: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    flag: str = "is_current",
    start: str = "valid_from",
    end: str = "valid_to",
) -> DataFrame:
    """Splice any number of updates of a key, early or late, into its versions.

    Versions are intervals by ``start``: the dimension's rows and the updates of a key are put
    in order, a state lasts until the next one begins, and the last one is current. An update
    equal in its tracked columns (NULLs are equal) to the state that it follows changes nothing.
    Of several updates with the same start the greatest by all columns counts, and it replaces a
    version with that start. A late update cuts the version it falls into, which then ends
    earlier. A version that has ended keeps its end; an update after that begins a new one.

    Updates without a key or a start stay out, and rows of the dimension without one are kept
    as they are. Update columns that the dimension lacks are ignored, missing ones are NULL in
    new versions.

    One shuffle by key with its sort; only keys that have an update take part. The others pass
    by an anti join, so a key that owns much of the dimension is moved only if it has updates.
    """
    fields = {f.name: f.dataType for f in dim.schema}
    begins = F.col(f"`{start}`").cast(fields[start])
    known = [c for c in updates.columns if c in fields and c not in (flag, end)]
    fresh = updates.where(F.col(f"`{key}`").isNotNull() & begins.isNotNull()).select(
        *[
            (F.col(f"`{n}`") if n in known else F.lit(None)).cast(t).alias(n)
            for n, t in fields.items()
        ]
    )
    touched = fresh.select(F.col(f"`{key}`").alias("__key")).distinct()
    ours = exchanged([key_of(dim, key, "d")], [key_of(touched, "__key", "k")])
    rest = dim.alias("d").join(touched.alias("k"), ours & F.col(f"d.`{start}`").isNotNull(), "left_anti")
    held = dim.where(F.col(f"`{start}`").isNotNull()).alias("d").join(touched.alias("k"), ours, "left_semi")

    states = held.select("*", F.lit(False).alias("__new")).unionByName(
        fresh.select("*", F.lit(True).alias("__new"))
    )
    by_key = Window.partitionBy(F.col(f"`{key}`"))
    in_time = by_key.orderBy(F.col(f"`{start}`"), F.col("__new"))
    same_start = Window.partitionBy(F.col(f"`{key}`"), F.col(f"`{start}`"))
    rank = same_start.orderBy(
        F.desc("__new"), *[F.desc_nulls_last(F.col(f"`{c}`")) for c in fields]
    )
    # Updates win over versions with the same start; of the updates the last by all columns.
    single = states.withColumn("__rank", F.row_number().over(rank)).withColumn(
        "__updated", F.max("__new").over(same_start)
    )
    single = single.where((F.col("__rank") == 1) | ~F.col("__updated")).drop("__rank", "__updated")

    new, begin = F.col("__new"), F.col(f"`{start}`")
    same = [F.col(f"`{c}`").eqNullSafe(F.lag(F.col(f"`{c}`")).over(in_time)) for c in tracked]
    first = F.row_number().over(in_time) == 1
    marked = single.withColumn("__begins", ~new | first | ~reduce(lambda a, b: a & b, same))
    # What an update follows: the last version or state begun before it, and whether that has
    # ended since the row before this one.
    earlier = in_time.rowsBetween(Window.unboundedPreceding, -1)
    state = F.when(F.col("__begins"), F.struct(new.alias("new"), F.col(f"`{end}`").alias("end")))
    marked = marked.withColumn("__state", F.last(state, ignorenulls=True).over(earlier))
    marked = marked.withColumn("__before", F.lag(begin).over(in_time))
    over = ~F.col("__state.new") & (F.col("__state.end") <= begin) & (F.col("__before") < F.col("__state.end"))
    kept = marked.where(F.col("__begins") | F.coalesce(over, F.lit(False)))

    until = F.lead(F.col(f"`{start}`")).over(in_time)
    closed = F.least(F.when(~new, F.col(f"`{end}`")), until)
    spliced = kept.withColumn("__until", closed).select(
        *[
            F.col("__until").alias(n)
            if n == end
            else F.col("__until").isNull().alias(n)
            if n == flag
            else F.col(f"`{n}`")
            for n in fields
        ]
    )
    return rest.unionByName(spliced)
