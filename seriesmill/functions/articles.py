"""Trend, value and date expressions for price-index articles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from seriesmill import fixed

# flags: any case, Unicode letters, only a line feed ends a line; \\s means every Unicode space
_SPACE = r"[\s\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
INDEX_MOVE = f"(?iud){fixed.INDEX_MOVE}".replace(r"\s", _SPACE)
PERCENT = fixed.PERCENT.replace(r"\s", _SPACE)


def _blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def index_hit(full_text: Column) -> Column:
    """First stretch from keyword over movement to a percent number; empty when there is none."""
    return F.regexp_extract(full_text, INDEX_MOVE, 0)


def trend_and_amount(hit: Column, title: Column) -> tuple[Column, Column]:
    """Trend word and percent value (dot as decimal sign) of an article.

    Both come from the hit; without one the title's own percent value counts, and its trend comes
    from the words in the title. ``hit`` should be a column of its own, it is used several times.
    """
    word = F.lower(F.regexp_extract(hit, INDEX_MOVE, 2))
    title_value = F.regexp_extract(title, PERCENT, 1)
    low_title = F.lower(title)
    up, down = F.lit(fixed.UP.lower()), F.lit(fixed.DOWN.lower())
    title_trend = F.when(F.contains(low_title, up), fixed.UP).when(F.contains(low_title, down), fixed.DOWN)
    trend = F.when(
        hit != "", F.when(word == up, fixed.UP).when(word == down, fixed.DOWN).otherwise(fixed.FLAT)
    ).otherwise(F.coalesce(F.when(title_value != "", title_trend), F.lit(fixed.UNKNOWN)))
    value = F.when(hit != "", F.regexp_extract(hit, INDEX_MOVE, 3)).otherwise(_blank_to_null(title_value))
    return trend, F.replace(value, F.lit(","), F.lit("."))


def article_day(meta: Column, shown: Column, has_meta: Column) -> Column:
    """Publication day as ``dd/MM/yyyy``; the shown text counts only where no meta tag exists."""
    parts = [F.regexp_extract(meta, fixed.ISO_DAY, i) for i in (3, 2, 1)]
    from_meta = F.when(parts[2] != "", F.concat_ws("/", *parts))
    from_text = _blank_to_null(F.regexp_extract(shown, fixed.SHOWN_DAY, 0))
    return F.when(has_meta, from_meta).otherwise(from_text)


def trend_label(value: Column) -> Column:
    """Label of a signed change."""
    return F.when(value > 0, fixed.UP).when(value < 0, fixed.DOWN).when(value == 0, fixed.STABLE)


def signed_change(amount: Column, trend: Column) -> Column:
    """Unsigned amount plus trend word as one signed number."""
    return F.when(trend == fixed.DOWN, -F.abs(amount)).otherwise(amount)
