"""Keep joins eligible for AQE's skew handling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_REAL = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Key:
    """A join key: how the condition names it, and its type."""

    column: Column
    type: T.DataType


def key_of(frame: DataFrame, name: str, alias: str | None = None) -> Key:
    quoted = f"`{name}`" if alias is None else f"{alias}.`{name}`"
    return Key(F.col(quoted), frame.schema[name].dataType)


def _decimal(t: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return _WHOLE[type(t)], 0


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type to which both sides of a key are cast: numbers, decimals, dates and timestamps
    widen without loss. TypeError for other mixtures (text against a number, say): convert one
    side first."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StringType) and isinstance(b, T.StringType):
        return T.StringType()
    exact = (*_WHOLE, T.DecimalType)
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return a if _WHOLE[type(a)] > _WHOLE[type(b)] else b
    if isinstance(a, exact) and isinstance(b, exact):
        before, after = map(max, zip(_decimal(a), _decimal(b)))
        if before + after <= 38:
            return T.DecimalType(before + after, after)
    elif isinstance(a, (*exact, *_REAL)) and isinstance(b, (*exact, *_REAL)):
        return T.DoubleType()
    elif isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return b if isinstance(a, T.DateType) else a
    raise TypeError(
        f"join keys of types {a.simpleString()} and {b.simpleString()}: convert one side first"
    )


def _cast(key: Key, to: T.DataType) -> Column:
    cast = key.column if key.type == to else key.column.cast(to)
    # Equal, but hashed apart: -0.0 and 0.0.
    return cast + F.lit(0.0).cast(to) if isinstance(to, _REAL) else cast


def exchanged(left: Sequence[Key], right: Sequence[Key], null_safe: bool = False) -> Column:
    """``left = right``, in a form for which both join sides get an exchange of their own.

    AQE splits a hot key only where each side of a sort-merge join is read straight from an
    exchange made for the join. A side that was aggregated by the same key needs no further
    exchange, which switches the splitting off for the other side too. The equality of the
    hashes follows from that of the keys, but makes the planner ask for a partitioning that
    no earlier step provides. It matters only where a side is too large to be broadcast.

    Hashes depend on the type, so both sides of each key are cast to their common one, in
    the equality and in the hash alike.
    """
    types = [common_type(a.type, b.type) for a, b in zip(left, right, strict=True)]
    ours = [_cast(k, t) for k, t in zip(left, types)]
    theirs = [_cast(k, t) for k, t in zip(right, types)]
    same = [a.eqNullSafe(b) if null_safe else a == b for a, b in zip(ours, theirs)]
    return reduce(lambda a, b: a & b, same) & (F.xxhash64(*ours) == F.xxhash64(*theirs))
