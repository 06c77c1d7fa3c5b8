"""One row per object of a JSON cell."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverloom.functions import cast_to, parse_objects
from silverloom.functions.json_cells import NATIVE


def explode_objects(
    df: DataFrame,
    cell: str,
    keep: Mapping[str, str],
    fields: Sequence[str],
    casts: Mapping[str, T.DataType] | None = None,
    fills: Mapping[str, object] | None = None,
    quote_mode: str = NATIVE,
) -> DataFrame:
    """Flatten ``cell`` beside the kept columns: parse, explode, cast, impute.

    Row-local from end to end, so it adds no shuffle, a key that owns many rows costs nothing
    extra, and it runs unchanged on a stream. Imputation follows the cast: a value the cast
    rejects gets the sentinel as well.
    """
    casts = casts or {}
    kept = [F.col(column).alias(name) for name, column in keep.items()]
    exploded = df.select(*kept, F.explode(parse_objects(cell, fields, quote_mode)).alias("_o"))
    values = [
        (cast_to(F.col(f"_o.`{f}`"), casts[f]) if f in casts else F.col(f"_o.`{f}`")).alias(f)
        for f in fields
    ]
    flat = exploded.select(*[F.col(name) for name in keep], *values)
    return flat.fillna(dict(fills)) if fills else flat
