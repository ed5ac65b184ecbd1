"""Raw rows to staging rows: price dictionaries, fixes, duplicates, flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill import fixed
from seriesmill.functions import articles, prices
from seriesmill.operators import fills


def parse_items(
    df: DataFrame, text: str, items: Mapping[str, str], spellings=fixed.FERT_SPELLINGS
) -> DataFrame:
    """Price text of each wanted item as its own column; ``items`` maps item name to column."""
    parsed = df.withColumn("__m", prices.price_map(F.col(text)))
    return parsed.withColumns(
        {col: prices.item_price(F.col("__m"), item, spellings) for item, col in items.items()}
    ).drop("__m")


def unread_maps(df: DataFrame, text: str) -> DataFrame:
    """One row: how many dictionary texts could not be read."""
    bad = F.col(text).isNotNull() & prices.price_map(F.col(text)).isNull()
    return df.agg(F.count_if(bad).alias("n_unread"), F.count(F.lit(1)).alias("n_rows"))


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop copies; hash aggregation merges them before the shuffle, so hot copies stay cheap."""
    return df.dropDuplicates(list(subset) if subset else None)


def overlay(base: DataFrame, fix: DataFrame, replaced: Column) -> DataFrame:
    """Drop the ``replaced`` rows of ``base`` and put the rows of ``fix`` in their place."""
    kept = base.where(~F.coalesce(replaced, F.lit(False)))
    return kept.unionByName(fix, allowMissingColumns=True)


def append_newer(base: DataFrame, newer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``newer`` whose key is unknown are added."""
    unseen = newer.join(base.select(*keys).distinct(), list(keys), "left_anti")
    return base.unionByName(unseen, allowMissingColumns=True)


def signed_changes(df: DataFrame, amount: str, trend: str) -> DataFrame:
    """Sign the amount by its trend word, then relabel the trend from the sign."""
    signed = articles.signed_change(F.col(amount), F.col(trend))
    return df.withColumn(amount, signed).withColumn(trend, articles.trend_label(F.col(amount)))


def derived_yield(production_ton: Column, area_ha: Column) -> Column:
    """Kilograms per hectare."""
    return F.try_divide(production_ton * 1000, area_ha)


def is_spot_reading(avg: Column, high: Column, low: Column) -> Column:
    """A single reading stands for the day: mean, maximum and minimum agree."""
    return (avg == high) & (avg == low)


def stage_rice(raw: DataFrame, items: Mapping[str, str]) -> DataFrame:
    """Rice articles to daily prices: low end of ranges, then forward fill by date."""
    wide = parse_items(raw, "data", items)
    cols = list(items.values())
    daily = wide.select("report_date", *[prices.range_low(F.col(c)).alias(c) for c in cols])
    return fills.forward_fill(daily, [], "report_date", cols)


def stage_fertilizer(
    raw: DataFrame,
    fix: DataFrame,
    replaced: Column,
    items: Mapping[str, str],
    dense_from: str | None = None,
) -> DataFrame:
    """Fertilizer articles to daily prices per kg.

    Copies go, the fix rows take the place of the ``replaced`` rows, ranges become midpoints, gaps
    in known days get the neighbour mean, and days missing since ``dense_from`` are interpolated.
    """
    rows = overlay(dedupe(raw), fix, replaced)
    cols = list(items.values())
    wide = parse_items(rows, "data", items)
    daily = wide.select("report_date", *[prices.range_mid(F.col(c)).alias(c) for c in cols])
    filled = fills.neighbor_mean_fill(daily, [], "report_date", cols, cascade=True)
    if dense_from is None:
        return filled
    return fills.linear_interpolate(filled, [], "report_date", cols, start=dense_from)
