"""Lenient casts: a bad value becomes null, it never fails the job.

Each takes the declared type of the column, so that columns which already fit cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# everything Unicode counts as white space
SPACES = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


#: Read after ISO, in this order: of two readings month first wins, as in ``01/02/2024`` for January.
DATE_FORMATS = ("yyyy/M/d", "yyyyMMdd", "yyyy.M.d", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy")


def to_date(c: Column, dtype: T.DataType | None = None) -> Column:
    """Date from ISO text or one of ``DATE_FORMATS``, a time of day is dropped; anything else is null."""
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    text = F.trim(c.cast("string"))
    day = F.regexp_replace(text, r"[ T]\d{1,2}:\d{2}.*$", "")
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("date"))
    return F.coalesce(iso, *[F.try_to_date(day, f) for f in DATE_FORMATS])


def unread_dates(c: Column, dtype: T.DataType | None = None) -> Column:
    """Count of values that ``to_date`` turns to null."""
    return F.count_if(c.isNotNull() & to_date(c, dtype).isNull())


def to_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """Double, with NaN folded into null so that averages and sorts behave."""
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return c.cast("double")
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_id(c: Column, dtype: T.DataType | None = None) -> Column:
    """Whole number; text such as ``"7.0"`` counts as 7, fractions become null."""
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    number = to_number(c)
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    # plain digits keep all 64 bits; a double would round beyond 2**53
    text = F.trim(c.cast("string"))
    digits = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    return F.coalesce(digits, whole)


def strip(c: Column, dtype: T.DataType | None = None) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c.cast("string"), F.lit(SPACES))
