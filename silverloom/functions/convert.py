"""Text -> typed conversions that yield NULL on bad input.

With ``spark.sql.ansi.enabled`` (the Spark 4 default) a plain cast of bad text fails the job,
so everything here is a ``try_`` expression. Those pay for an exception inside the JVM
whenever they fail, tens of times the price of a cell that parses; patterns keep text that
cannot succeed away from them. All of it is code-generated; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_DATE = "yyyy-MM-dd"

_FRACTION_ONLY = r"^\s*[+-]?\.\d+\s*$"
_MAYBE_NUMBER = r"(?i)^\s*[+-]?(\.?\d|inf|nan)"
_ISO_DATE_TEXT = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole(c: Column | str, dtype: str, digits: int) -> Column:
    """``'162'`` and ``'162.7'`` -> 162; exponents, words and values out of range -> NULL."""
    text = _col(c).cast("string")
    plain = rf"^\s*[+-]?0*\d{{1,{digits}}}(\.\d*)?\s*$"
    whole = F.substring_index(text, ".", 1).try_cast(dtype)
    return F.when(text.rlike(plain), whole).when(
        text.rlike(_FRACTION_ONLY), F.lit(0).cast(dtype)
    )


def to_int(c: Column | str) -> Column:
    return _whole(c, "int", 10)


def to_long(c: Column | str) -> Column:
    return _whole(c, "bigint", 19)


def _real(c: Column | str, dtype: str) -> Column:
    text = _col(c).cast("string")
    return F.when(text.rlike(_MAYBE_NUMBER), text.try_cast(dtype))


def to_double(c: Column | str) -> Column:
    return _real(c, "double")


def to_float(c: Column | str) -> Column:
    return _real(c, "float")


def to_date(c: Column | str, pattern: str = ISO_DATE) -> Column:
    column = _col(c)
    if pattern == ISO_DATE:
        # Only text has to look like a date; a timestamp is cut to its day.
        typed = F.typeof(column) != "string"
        return F.when(typed | column.rlike(_ISO_DATE_TEXT), column.try_cast("date"))
    return F.try_to_date(column, pattern)


def cast_to(c: Column | str, dtype: T.DataType, source: T.DataType | None = None) -> Column:
    """Convert to ``dtype`` by the rules above; ``source`` lets typed input skip text rules."""
    column = _col(c)
    if source is not None and source == dtype:
        return column
    if source is None or isinstance(source, T.StringType):
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
            return to_int(column).try_cast(dtype)
        if isinstance(dtype, T.LongType):
            return to_long(column)
        if isinstance(dtype, T.DoubleType):
            return to_double(column)
        if isinstance(dtype, T.FloatType):
            return to_float(column)
        if isinstance(dtype, T.DateType):
            return to_date(column)
    return column.try_cast(dtype)
