"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from seriesmill import fixed

DAY_FIRST_FORMATS = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "M/d/yyyy")
SHORT_YEAR_FORMATS = ("d/M/yy", "d-M-yy", "d.M.yy", "M/d/yy")


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_cycle(month: Column) -> tuple[Column, Column]:
    """Sine and cosine of the month on the yearly circle."""
    angle = 2 * F.pi() * month / F.lit(12.0)
    return F.sin(angle), F.cos(angle)


def forecast_month(base: Column, horizon: Column | int) -> Column:
    return F.trunc(F.add_months(base, horizon), "MM")


def month_label(c: Column) -> Column:
    return F.date_format(c, "MM/yyyy")


def day_first(c: Column) -> Column:
    """Date of a text written day first, as ``yyyy-MM-dd``; unreadable text is passed through.

    A time of day after the date is dropped; two digits are a year of this century.
    """
    text = F.trim(c.cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("date"))
    day = F.regexp_replace(text, r"[ T,]+\d{1,2}:\d{2}.*$", "")
    long_year = day.rlike(r"\d{4}$")
    tries = [F.when(long_year, F.try_to_date(day, f)) for f in DAY_FIRST_FORMATS]
    tries += [F.when(~long_year, F.try_to_date(day, f)) for f in SHORT_YEAR_FORMATS]
    return F.coalesce(F.date_format(F.coalesce(iso, *tries), "yyyy-MM-dd"), c.cast("string"))


def url_date(url: Column, fallback: Column) -> Column:
    """Day and month after ``ngay-``/``hom-nay-`` plus the year found in an article address.

    Four digits read ddmm, three dmm, two dm. No match, another length or an impossible
    date keeps ``fallback``.
    """
    digits = F.regexp_extract(url, fixed.URL_DAY, 1)
    year = F.regexp_extract(url, fixed.URL_YEAR, 1)
    size = F.length(digits)
    day_len = F.when(size == 4, 2).otherwise(1)
    day = F.substring(digits, F.lit(1), day_len)
    month = F.substring(digits, day_len + 1, size - day_len)
    built = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")
    return F.coalesce(F.when((size >= 2) & (year != ""), built), fallback)
