"""JSON held in a text cell: an array of flat objects, with either quote style."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NATIVE = "native"
REPLACE = "replace"

#: A value of any size, a number of any length, any depth: by default the reader gives the
#: whole cell up beyond its limits.
UNLIMITED = {
    name: "2147483647" for name in ("maxStringLen", "maxNumLen", "maxNestingDepth")
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _check_mode(quote_mode: str) -> None:
    if quote_mode not in (NATIVE, REPLACE):
        raise ValueError(f"quote_mode must be {NATIVE!r} or {REPLACE!r}, got {quote_mode!r}")


def _starts_with(c: Column, bracket: str) -> Column:
    return F.ltrim(c, F.lit(" \t\r\n")).startswith(bracket)


def _double_quoted(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit('"'))


def parse_objects(c: Column | str, fields: Sequence[str], quote_mode: str = NATIVE) -> Column:
    """Parse a JSON array of objects into ``array<struct<fields: string>>``.

    ``native`` reads both quote styles and keeps apostrophes inside values. ``replace`` turns
    every ``'`` into ``"`` first and drops the whole cell if the result is not valid JSON, so
    an apostrophe in a value loses the cell; use it only to reproduce output made that way.

    NULL, empty or broken text gives NULL. A missing key or JSON null gives a NULL field, a
    null element stays an element, and the last of two equal keys wins. Only the fields
    asked for are materialised. Size, length of numbers and depth are not limited, but for
    ``replace``, which loses cells nested deeper than 1,000 levels.
    """
    _check_mode(quote_mode)
    text = _col(c)
    element = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    if quote_mode == NATIVE:
        # The reader would wrap a lone root object into a one-element array.
        return F.when(_starts_with(text, "["), F.from_json(text, T.ArrayType(element), UNLIMITED))

    # The reader stops after the first complete value. Placing the cell before a sentinel in
    # an outer object makes anything that follows the array break the parse.
    guarded = F.from_json(
        F.concat(F.lit('{"cell":'), _double_quoted(text), F.lit(',"end":1}')),
        "cell array<string>, end string",
        UNLIMITED,
    )
    elements = F.when(guarded["end"] == "1", guarded["cell"])
    return F.when(
        _starts_with(text, "["), F.transform(elements, lambda e: F.from_json(e, element, UNLIMITED))
    )


def extract_value(c: Column | str, key: str, quote_mode: str = NATIVE) -> Column:
    """Text of one key of a root JSON object; NULL if absent, broken or not an object."""
    _check_mode(quote_mode)
    text = _col(c) if quote_mode == NATIVE else _double_quoted(_col(c))
    schema = T.StructType([T.StructField(key, T.StringType())])
    return F.when(_starts_with(text, "{"), F.from_json(text, schema, UNLIMITED).getField(key))
