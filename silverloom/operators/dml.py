"""Table mutation as pure functions: old frames in, new frame out.

Nothing is changed in place. The caller writes the result as a new snapshot (never over the
path it was read from), so a lost executor or a failed job leaves the old table whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import SparkRuntimeException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverloom.operators.skew import common_type, exchanged, key_of

_COPIES = "__copies"

Expr = Column | str


#: More than one source row would update the same target row; raised by the job that runs the merge.
AmbiguousMerge = SparkRuntimeException


@dataclass(frozen=True)
class Update:
    """``WHEN MATCHED [AND condition] THEN UPDATE``; ``set=None`` takes every source column."""

    set: Mapping[str, Expr] | None = None
    condition: Expr | None = None


@dataclass(frozen=True)
class Insert:
    """``WHEN NOT MATCHED [AND condition] THEN INSERT``; ``values=None`` takes every column."""

    values: Mapping[str, Expr] | None = None
    condition: Expr | None = None


def _expr(e: Expr) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def _holds(e: Expr | None) -> Column:
    """SQL truth: a NULL condition is not met."""
    return F.lit(True) if e is None else F.coalesce(_expr(e), F.lit(False))


def _field(alias: str, column: str) -> Column:
    return F.col(f"{alias}.`{column}`")


def _every(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _key_pairs(on: Mapping[str, str] | Sequence[str] | str) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {c: c for c in on}


def _known(names: Sequence[str], frame: DataFrame, what: str) -> None:
    unknown = sorted(set(names) - set(frame.columns))
    if unknown:
        raise ValueError(f"{what} not found: {', '.join(unknown)}")


def _key_counts(frame: DataFrame, keys: Mapping[str, str], name: str) -> DataFrame:
    """Rows per key, under new names; keys with a NULL part match nothing and are left out."""
    return (
        frame.where(_every([F.col(f"`{c}`").isNotNull() for c in keys]))
        .groupBy(*[F.col(f"`{c}`").alias(alias) for c, alias in keys.items()])
        .agg(F.count(F.lit(1)).alias(name))
    )


def _ambiguous(keys: Sequence[str]) -> Column:
    named = [F.concat(F.lit(f"'{k}': "), F.col(f"`{k}`").cast("string")) for k in keys]
    return F.concat(F.lit("several source rows update the target row with "), F.concat_ws(", ", *named))


def nothing(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df``, known to be empty, with the columns of ``like``: added to a result for its checks."""
    return df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema])


def ambiguous_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Mapping[str, str],
    acts: Column,
    target_alias: str = "t",
    source_alias: str = "s",
) -> DataFrame:
    """No rows, with the target's columns. Running it raises :data:`AmbiguousMerge` if some target
    row has two or more source rows on which ``acts`` holds.

    A merge adds it to its result, so the check is part of the merge's own job. The source is
    counted by its keys; only rows of repeated keys are joined, usually none, and then AQE drops
    the join.
    """
    inner = {c: f"__k{i}" for i, c in enumerate(keys)}
    repeated = _key_counts(source, dict(zip(keys.values(), inner.values())), _COPIES)
    repeated = repeated.where(F.col(_COPIES) > 1).select(*inner.values())

    def within_repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        ours = [key_of(df, c, "__l") for c in columns]
        matches = exchanged(ours, [key_of(repeated, k, "__r") for k in inner.values()])
        return df.alias("__l").join(repeated.alias("__r"), matches, "left_semi")

    # Equal target rows match alike, so their content serves as identity.
    rows = within_repeated(source, list(keys.values()))
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    suspects = within_repeated(target, list(keys)).distinct()
    matched = exchanged(
        [key_of(suspects, a, target_alias) for a in keys],
        [key_of(rows, b, source_alias) for b in keys.values()],
    )
    clashes = (
        suspects.alias(target_alias)
        .join(rows.alias(source_alias), matched & acts)
        .groupBy(*[_field(target_alias, c).alias(c) for c in target.columns])
        .agg(F.sum(_field(source_alias, _COPIES)).alias(_COPIES))
    )
    fails = F.raise_error(_ambiguous(list(keys))).cast("boolean")
    return nothing(clashes.where(F.when(F.col(_COPIES) > 1, fails).otherwise(False)), target)


def shared_keys(
    target: DataFrame, source: DataFrame, keys: Mapping[str, str], once: bool = False
) -> DataFrame:
    """Distinct keys found on both sides, under the source's names.

    Counting first lets a key that owns much of either side collapse before the shuffle. If
    the source is small enough to broadcast, Catalyst moves the semi join below the target's
    aggregate and the target keys are reduced where they are scanned. With ``once`` a shared
    key that the source repeats raises :data:`AmbiguousMerge`; that reads the same counts again.
    """
    names = list(keys.values())
    ours = _key_counts(target, keys, "__rows")
    theirs = _key_counts(source, {s: s for s in names}, _COPIES)
    for s in names:
        common_type(ours.schema[s].dataType, theirs.schema[s].dataType)
    held = ours.join(theirs.select(*names), names, "left_semi")
    if once:
        # Naming both counts keeps the test from being moved to one side of the join.
        clash = (F.col("__rows") > 0) & (F.col(_COPIES) > 1)
        fails = F.when(clash, F.raise_error(_ambiguous(names)).cast("boolean")).otherwise(True)
        held = held.join(theirs, names).where(fails)
    return held.select(*names)


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Mapping[str, str] | Sequence[str] | str,
    *,
    matched: Sequence[Update] = (Update(),),
    not_matched: Sequence[Insert] = (Insert(),),
    source_condition: Expr | None = None,
    target_alias: str = "t",
    source_alias: str = "s",
    check_ambiguous: bool = True,
) -> DataFrame:
    """MERGE semantics over frames.

    ``on`` gives the equality keys (``{target column: source column}`` if names differ);
    ``source_condition`` is a further ON conjunct over the source. A source row failing the
    conjunct matches nothing and is therefore inserted, even beside an existing key. The
    first clause whose condition holds is applied; NULL conditions do not hold, NULL keys
    never match. Expressions name columns as ``t.x`` / ``s.x``.

    Plan: the target is the streamed side of one left join whose condition includes the
    clause conditions, so a small source is broadcast and the target is not shuffled, and a
    hot target key may be split by AQE (a full outer join would allow neither). Inserts come
    from an anti join against the keys both sides share. Two source rows that act on one target
    row make the job that runs the result fail with :data:`AmbiguousMerge`: without conditions
    the shared keys' counts tell, with conditions :func:`ambiguous_rows` does.
    """
    keys = _key_pairs(on)
    _known(list(keys), target, "target key")
    _known(list(keys.values()), source, "source key")
    for clause in matched:
        _known(list(clause.set or ()), target, "updated column")
    for clause in not_matched:
        _known(list(clause.values or ()), target, "inserted column")
    if any(c.set is None for c in matched) or any(c.values is None for c in not_matched):
        _known(target.columns, source, "source column")

    def t(column: str) -> Column:
        return _field(target_alias, column)

    def s(column: str) -> Column:
        return _field(source_alias, column)

    eligible = source
    if source_condition is not None:
        eligible = source.alias(source_alias).where(_expr(source_condition))

    acts, checks = None, []
    if matched:
        if all(c.condition is not None for c in matched):
            acts = reduce(lambda a, b: a | b, [_holds(c.condition) for c in matched])
        if check_ambiguous and acts is not None:
            checks.append(ambiguous_rows(target, eligible, keys, acts, target_alias, source_alias))
        condition = exchanged(
            [key_of(target, a, target_alias) for a in keys],
            [key_of(source, b, source_alias) for b in keys.values()],
        )
        joined = target.alias(target_alias).join(
            eligible.alias(source_alias), condition if acts is None else condition & acts, "left"
        )
        kept = joined.select(*_updated_columns(target, matched, list(keys.values()), t, s))
    else:
        kept = target

    once = bool(matched) and check_ambiguous and acts is None
    shared = shared_keys(target, eligible, keys, once)
    if not_matched:
        kept = kept.unionByName(
            _inserted(target, source, shared, keys, not_matched, source_condition, source_alias)
        )
    elif once:
        # Only its test is wanted: no partition has such a number, which the optimizer can't know.
        checks.append(nothing(shared.where(F.spark_partition_id() < 0), target))
    return reduce(DataFrame.unionByName, checks, kept)


def _updated_columns(target, matched, source_keys, t, s) -> list[Column]:
    hit = _every([s(k).isNotNull() for k in source_keys])
    columns = []
    for f in target.schema:
        value = t(f.name)
        if any(c.set is None or f.name in c.set for c in matched):
            for clause in reversed(matched):
                if clause.set is None:
                    new = s(f.name)
                else:
                    new = _expr(clause.set.get(f.name, t(f.name)))
                value = F.when(hit & _holds(clause.condition), new.cast(f.dataType)).otherwise(value)
        columns.append(value.alias(f.name))
    return columns


def _inserted(
    target, source, present, keys, clauses, source_condition, source_alias
) -> DataFrame:
    matches = exchanged(
        [key_of(source, c, source_alias) for c in keys.values()],
        [key_of(present, c, "__p") for c in keys.values()],
    )
    if source_condition is not None:
        matches = matches & _holds(source_condition)
    fresh = source.alias(source_alias).join(present.alias("__p"), matches, "left_anti").alias(source_alias)

    taken = F.lit(False)
    parts = []
    for clause in clauses:
        condition = _holds(clause.condition)
        rows = fresh
        if clause.condition is not None or parts:
            rows = fresh.where(condition & ~taken)
        taken = taken | condition
        columns = []
        for f in target.schema:
            if clause.values is None:
                value = _field(source_alias, f.name)
            else:
                value = _expr(clause.values.get(f.name, F.lit(None)))
            columns.append(value.cast(f.dataType).alias(f.name))
        parts.append(rows.select(*columns))
    return reduce(DataFrame.unionByName, parts)


def update_where(df: DataFrame, condition: Expr, set: Mapping[str, Expr]) -> DataFrame:
    """UPDATE ... SET ... WHERE: all assignments see the old row; a NULL condition keeps it."""
    _known(list(set), df, "updated column")
    holds = _holds(condition)
    return df.select(
        *[
            F.when(holds, _expr(set[f.name]).cast(f.dataType))
            .otherwise(F.col(f"`{f.name}`"))
            .alias(f.name)
            if f.name in set
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def delete_where(df: DataFrame, condition: Expr) -> DataFrame:
    """DELETE ... WHERE: rows whose condition is NULL stay."""
    return df.where(~_holds(condition))


def cascade_delete(
    parent: DataFrame,
    key: str,
    condition: Expr,
    children: Mapping[str, tuple[DataFrame, str]],
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Delete parent rows and, in each child, the rows that refer to a deleted parent.

    Children are given as ``name -> (frame, foreign key column)``. Rows with a NULL or already
    orphaned foreign key stay, as under ON DELETE CASCADE.
    """
    deleted = parent.where(_holds(condition)).select(F.col(f"`{key}`").alias("__deleted")).distinct()
    remaining = {
        name: child.alias("__c").join(
            deleted, exchanged([key_of(child, fk, "__c")], [key_of(deleted, "__deleted")]), "left_anti"
        )
        for name, (child, fk) in children.items()
    }
    return delete_where(parent, condition), remaining


def absent_rows(
    existing: DataFrame, batch: DataFrame, key: str | Sequence[str], order_by: Sequence[Expr]
) -> DataFrame:
    """Rows of ``batch`` that INSERT ... ON CONFLICT DO NOTHING would add.

    Per new key the first row by ``order_by`` wins, ties falling to the smallest row. The
    first row is a mergeable minimum, so a key that owns much of the batch shrinks to one row
    per map task before the shuffle, which the anti join then reuses. NULL keys are rejected,
    as by a primary key.
    """
    names = [key] if isinstance(key, str) else list(key)
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]
    ranked = F.struct(
        *[o.alias(f"o{i}") for i, o in enumerate(order)],
        F.struct(*[F.col(f"`{c}`") for c in batch.columns]).alias("row"),
    )
    keyed = batch.where(_every([F.col(f"`{c}`").isNotNull() for c in names]))
    first = keyed.groupBy(*names).agg(F.min(ranked).alias("__first"))
    known = shared_keys(existing, keyed, {c: c for c in names})
    return first.join(known, names, "left_anti").select("__first.row.*")


def insert_if_absent(
    existing: DataFrame, batch: DataFrame, key: str | Sequence[str], order_by: Sequence[Expr]
) -> DataFrame:
    """``existing`` plus :func:`absent_rows`; existing rows are never touched."""
    new = absent_rows(existing, batch, key, order_by)
    return existing.unionByName(new.select(*existing.columns))
