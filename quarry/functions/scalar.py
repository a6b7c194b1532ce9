"""Scalar Column functions.  All built-in expressions: they stay
inside whole-stage codegen and need no Python worker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower(c: ColumnOrName) -> Column:
    return F.lower(_c(c))


# Python's str.strip() removes every Unicode white-space character; Spark's
# trim() only removes spaces, and plain \s misses U+00A0, hence (?U).
UNICODE_STRIP_PATTERN = r"(?U)^\s+|\s+$"


def strip(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), UNICODE_STRIP_PATTERN, "")


def cast_int(c: ColumnOrName) -> Column:
    """Number to int, truncating toward zero like Python's ``int()``."""
    return _c(c).cast("int")


def try_cast_int(c: ColumnOrName) -> Column:
    """Like ``cast_int`` but NULL instead of an error, for quality reports."""
    return _c(c).try_cast("int")


def substring0(c: ColumnOrName, start: int, stop: int) -> Column:
    """Python slice ``s[start:stop]`` (0-based, end exclusive)."""
    return F.substring(_c(c), start + 1, stop - start)


def fixed(c: ColumnOrName, decimals: int = 2, width: int | None = None) -> Column:
    """``f'{x:.2f}'`` / ``f'{x:7.2f}'``."""
    spec = f"%{width or ''}.{decimals}f"
    return F.format_string(spec, _c(c))


def zero_pad(c: ColumnOrName, width: int = 2) -> Column:
    """``f'{n:02d}'`` for non-negative integers."""
    return F.lpad(_c(c).cast("string"), width, "0")


def money(c: ColumnOrName) -> Column:
    return F.concat(F.lit("$"), fixed(c, 2))


def round_half_even(c: ColumnOrName, digits: int = 2) -> Column:
    return F.bround(_c(c), digits)


def ceil_int(c: ColumnOrName) -> Column:
    """``int(np.ceil(x))``; NULL stays NULL."""
    return F.ceil(_c(c)).cast("bigint")


def capitalize(c: ColumnOrName) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    col = _c(c)
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 1 << 30)))


def between(c: ColumnOrName, lo, hi) -> Column:
    return _c(c).between(lo, hi)


def negate(c: ColumnOrName) -> Column:
    return -_c(c)


def parse_slot(date_col: ColumnOrName, slot_col: ColumnOrName) -> Column:
    """Text date ``yyyy-MM-dd`` plus text slot ``hh:mm AM`` -> timestamp_ntz."""
    return F.to_timestamp_ntz(F.concat_ws(" ", _c(date_col), _c(slot_col)), F.lit("yyyy-MM-dd hh:mm a"))


def case_label(cond: Column, when_true: str, when_false: str) -> Column:
    return F.when(cond, F.lit(when_true)).otherwise(F.lit(when_false))


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; fails on a clash instead of shadowing."""
    names = [c.lower() for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"lower-casing makes duplicate column names: {clashes}")
    return df.toDF(*names)
