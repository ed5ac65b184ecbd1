"""Price dictionaries, price ranges and prices found in text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from seriesmill import fixed


def price_map(text: Column) -> Column:
    """JSON or Python-style dictionary text as a map of strings.

    ``None`` is turned into ``null`` first, otherwise the reader gives up on the whole row.
    """
    return F.from_json(F.regexp_replace(text, r":\s*None\b", ": null"), "map<string,string>")


def item_price(
    prices: Column, item: str, spellings: Mapping[str, Sequence[str]] = fixed.FERT_SPELLINGS
) -> Column:
    """Price text of ``item`` under any of its spellings."""
    return F.coalesce(*[prices[name] for name in spellings.get(item, (item,))])


def range_low(text: Column) -> Column:
    """Low end of ``"low-high"``; a single value stands for itself."""
    return F.try_element_at(F.split(text, "-"), F.lit(1)).try_cast("double")


def range_mid(text: Column, per: float = fixed.BAG_KG) -> Column:
    """Midpoint of ``"low-high"`` divided by the pack size."""
    ends = F.split(text, "-")
    low = F.try_element_at(ends, F.lit(1)).try_cast("double")
    high = F.try_element_at(ends, F.lit(-1)).try_cast("double")
    return (low + high) / 2 / F.lit(float(per))


def within(c: Column, low: float, high: float) -> Column:
    """The value when inside the bounds, else null."""
    return F.when(c.between(low, high), c)


# \s of the patterns means every Unicode space; spelled out, which is far faster than the flag
_SPACE = r"[\s\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _pattern(keyword: str) -> str:
    return f"(?iu){keyword}{fixed.PRICE_AFTER_KEYWORD}".replace(r"\s", _SPACE)


def price_hit(alias: str, text: Column) -> Column:
    """The first stretch of text from a keyword to its price; empty when there is none."""
    return F.regexp_extract(text, _pattern(alias), 0)


def hit_numbers(alias: str, hit: Column) -> tuple[Column, Column]:
    """First and second number of a hit, dots removed; empty where there is none."""
    low, high = (F.replace(F.regexp_extract(hit, _pattern(alias), g), F.lit(".")) for g in (1, 2))
    return low, high


def price_of_hit(hit: Column, first: Column, second: Column, text: Column) -> Column:
    """Price of a hit as ``"low"`` or ``"low-high"``.

    The number of a fertilizer formula is not a price; then the next dotted amount after the
    hit counts. A low end outside the accepted bounds gives null. Only the formula case looks at
    the long text again. Hit and numbers should be columns of their own, they are used often.
    """
    # the hit is the leftmost match, so its first occurrence ends where the search ended
    rest = F.substr(text, F.instr(text, hit) + F.length(hit))
    later = F.replace(F.regexp_extract(rest, rf"({fixed.DOTTED_AMOUNT})", 1), F.lit("."))
    low = F.when(first == fixed.FORMULA_NUMBER, later).when(first != "", first)
    accepted = low.try_cast("int").between(fixed.PRICE_LOW, fixed.PRICE_HIGH)
    span = F.when(second != "", F.concat_ws("-", low, second)).otherwise(low)
    return F.when((hit != "") & accepted, span)
