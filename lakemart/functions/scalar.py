"""Scalar column helpers (all built-in expressions, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Text -> timestamp; unparsable text becomes NULL instead of failing (ANSI-safe)."""
    c = _col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def lenient_cast(c: ColumnOrName, dtype: T.DataType | str) -> Column:
    """Cast that yields NULL on a bad value (``try_cast``)."""
    return _col(c).try_cast(dtype)


def as_double(c: ColumnOrName) -> Column:
    """Final conversion of an exact (decimal) result to double."""
    return _col(c).cast("double")


def date_key(ts: ColumnOrName) -> Column:
    """``yyyy-MM-dd`` text key of a timestamp (the star's date key)."""
    return F.date_format(_col(ts), "yyyy-MM-dd")








def weekday_short(ts: ColumnOrName) -> Column:
    """Short weekday name, e.g. ``Tue``."""
    return F.date_format(_col(ts), "E")


def calendar_days(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Calendar-day difference (23:50 -> 00:10 next day is 1), INT."""
    return F.datediff(_col(end), _col(start))


def month_label(year: ColumnOrName, month: ColumnOrName) -> Column:
    """``yyyy-MM`` label from integer year and month."""
    return F.concat_ws("-", _col(year).cast("string"), F.lpad(_col(month).cast("string"), 2, "0"))


def safe_pct(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator * 100 / denominator``; NULL when the denominator is 0."""
    return _col(numerator).cast("double") * F.lit(100.0) / F.nullif(_col(denominator), F.lit(0)).cast("double")


def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    return _col(numerator).cast("double") / F.nullif(_col(denominator), F.lit(0)).cast("double")



def round_ratio(numerator: ColumnOrName, denominator: ColumnOrName, digits: int = 2) -> Column:
    """``numerator / denominator`` rounded half away from zero to ``digits``, exactly.

    Integer inputs only. Done in integer arithmetic, so the result does not depend
    on how a double happens to represent a tie (0.145 is 0.14499... in binary).
    NULL when the denominator is 0 or NULL.
    """
    n, d = _col(numerator).cast("long"), F.nullif(_col(denominator).cast("long"), F.lit(0))
    scale = 10**digits
    hundredths = (F.abs(n) * F.lit(2 * scale) + d) / (F.lit(2) * d)
    return F.signum(n) * F.floor(hundredths) / F.lit(float(scale))
