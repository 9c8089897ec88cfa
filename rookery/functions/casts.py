"""Tolerant casts: ``int(value)`` semantics with a default.

Only strings that are a signed integer (surrounding whitespace allowed)
convert; fractional or junk strings take the default, as Python's ``int``
would. The regex guard also keeps Spark (NULL) and DuckDB (rounds) in
agreement on inputs like ``'12.5'``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_PATTERN = r"^\s*[+-]?\d+\s*$"
FLOAT_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_int(value, default: int | None) -> Column:
    s = _c(value).cast("string")
    ok = s.rlike(INT_PATTERN)
    parsed = F.when(ok, F.trim(s).cast("bigint"))
    return F.coalesce(parsed, F.lit(default).cast("bigint")).cast("int")


def safe_float(value, default: float | None) -> Column:
    s = _c(value).cast("string")
    parsed = F.when(s.rlike(FLOAT_PATTERN), F.trim(s).cast("double"))
    return F.coalesce(parsed, F.lit(default).cast("double"))


def rating_or_default(value, default: int = 1500, zero_is_missing: bool = True) -> Column:
    """``int(value or default)``: NULL, '' (and 0 when ``zero_is_missing``)
    take the default before parsing; unparseable strings take it after."""
    v = _c(value).cast("string")
    missing = v.isNull() | (v == "")
    if zero_is_missing:
        missing = missing | (v == "0")
    return F.when(missing, F.lit(default)).otherwise(safe_int(v, default))
