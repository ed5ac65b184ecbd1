"""Monthly panel: one row per month and series with lags, rolling statistics and targets.

All window columns share one specification (series keys, ordered by month), so a single exchange
and a single sort serve the whole panel. A series has one row per month; its window partition is
bounded by the length of the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesmill import fixed
from seriesmill.functions import dates


@dataclass(frozen=True)
class PanelSpec:
    """Column names and window sizes; the defaults describe the price panel."""

    keys: Sequence[str] = ("region_id", "rice_id")
    date: str = "date_id"
    target: str = "price_rice"
    measures: Sequence[str] = fixed.CONTEXT_MEASURES
    measure_prefix: str | None = fixed.FERT_PREFIX
    categories: Sequence[str] = fixed.PANEL_CATEGORIES
    horizons: Sequence[int] = fixed.HORIZONS
    max_target_lag: int = fixed.MAX_TARGET_LAG
    max_feature_lag: int = fixed.MAX_FEATURE_LAG
    rolling_windows: Sequence[int] = fixed.ROLLING_WINDOWS

    def feature_measures(self, df: DataFrame) -> list[str]:
        """Numeric columns other than the target that are present, prefix columns last."""
        found = [c for c in self.measures if c in df.columns]
        if self.measure_prefix:
            found += [c for c in df.columns if c.startswith(self.measure_prefix) and "_lag_" not in c
                      and "_roll_" not in c]
        return found

    def ordered(self) -> Window:
        return Window.partitionBy(*self.keys).orderBy(self.date)


PRICE_PANEL = PanelSpec()


def monthly_aggregate(
    daily: DataFrame, spec: PanelSpec = PRICE_PANEL, unique_days: bool = True
) -> DataFrame:
    """Mean of the numbers and most frequent category per month and series.

    The rows are placed by series first. That one exchange serves the monthly grouping and every
    window that follows. With one row per day and series no placement can be larger than a
    calendar; set ``unique_days`` to False for raw rows, which are then combined before they
    move. Ties between categories go to the smallest.
    """
    numbers = [spec.target, *spec.feature_measures(daily)]
    categories = [c for c in spec.categories if c in daily.columns]
    placed = daily.where(F.col(spec.date).isNotNull() & _all_present(spec.keys))
    if unique_days:
        placed = placed.repartition(*spec.keys)
    month = dates.month_start(F.col(spec.date))
    return (
        placed.groupBy(month.alias("__month"), *spec.keys)
        .agg(
            *[F.avg(F.col(f"`{c}`")).alias(c) for c in numbers],
            *[F.mode(F.col(f"`{c}`"), True).alias(c) for c in categories],
        )
        .withColumnRenamed("__month", spec.date)
    )


def _all_present(cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def frequent_value(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent non-null value per key for raw rows, ties to the smallest.

    Counting per (key, value) combines before the shuffle, so one hot key does not pile up its
    values in one aggregation buffer.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(
        F.count(F.lit(1)).alias("__n")
    )
    # smallest pair of (minus count, value): the most frequent value, ties to the smallest
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col(column).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("__b")).select(*keys, F.col("__b.v").alias(column))


def calendar_columns(spec: PanelSpec = PRICE_PANEL) -> dict[str, Column]:
    month = F.month(spec.date)
    sine, cosine = dates.month_cycle(month)
    return {
        "month_num": month,
        "year_num": F.year(spec.date),
        "month_sin": sine,
        "month_cos": cosine,
    }


def target_lag_columns(spec: PanelSpec = PRICE_PANEL) -> dict[str, Column]:
    w = spec.ordered()
    return {
        f"{spec.target}_lag_{k}": F.lag(spec.target, k).over(w)
        for k in range(1, spec.max_target_lag + 1)
    }


def feature_lag_columns(measures: Sequence[str], spec: PanelSpec = PRICE_PANEL) -> dict[str, Column]:
    w = spec.ordered()
    return {
        f"{c}_lag_{k}": F.lag(F.col(f"`{c}`"), k).over(w)
        for c in measures
        for k in range(1, spec.max_feature_lag + 1)
    }


def rolling_columns(
    columns: Sequence[str], spec: PanelSpec = PRICE_PANEL, stats: Sequence[str] = ("mean", "std")
) -> dict[str, Column]:
    """Trailing mean and sample deviation, current row included; one value has no deviation."""
    make = {"mean": F.avg, "std": F.stddev_samp}
    w = spec.ordered()
    return {
        f"{c}_roll_{stat}_{n}": make[stat](F.col(f"`{c}`")).over(w.rowsBetween(-(n - 1), 0))
        for c in columns
        for n in spec.rolling_windows
        for stat in stats
    }


def change_columns(spec: PanelSpec = PRICE_PANEL) -> dict[str, Column]:
    """Difference and relative change to the previous row; no change relative to 0 or null."""
    now, before = F.col(spec.target), F.lag(spec.target, 1).over(spec.ordered())
    return {
        f"{spec.target}_diff_1": now - before,
        f"{spec.target}_pct_change_1": F.try_divide(now - before, before),
    }


def target_columns(spec: PanelSpec = PRICE_PANEL) -> dict[str, Column]:
    """Future values and their direction; equal or unknown futures have no direction."""
    out = {}
    for h in spec.horizons:
        ahead, now = F.lead(spec.target, h).over(spec.ordered()), F.col(spec.target)
        out[f"target_t_plus_{h}"] = ahead
        out[f"direction_t_plus_{h}"] = F.when(ahead > now, 1.0).when(ahead < now, 0.0)
    return out


def latest_column(spec: PanelSpec = PRICE_PANEL) -> dict[str, Column]:
    """True on the last month of each series; months are unique, so the last has no successor."""
    return {"row_is_latest": F.lead(spec.date, 1).over(spec.ordered()).isNull()}


def monthly_panel(daily: DataFrame, spec: PanelSpec = PRICE_PANEL, calendar: bool = False) -> DataFrame:
    """The full panel in one projection over the monthly rows.

    Lags count rows, as months without data are absent. With ``calendar`` the missing months are
    added first (numbers null), so lags count months.
    """
    monthly = monthly_aggregate(daily, spec)
    if calendar:
        monthly = densify_months(monthly, spec)
    return panel_columns(monthly, spec)


def panel_columns(monthly: DataFrame, spec: PanelSpec = PRICE_PANEL) -> DataFrame:
    measures = spec.feature_measures(monthly)
    added = {
        **calendar_columns(spec),
        **target_lag_columns(spec),
        **feature_lag_columns(measures, spec),
        **rolling_columns([spec.target, *measures], spec),
        **change_columns(spec),
        **target_columns(spec),
        **latest_column(spec),
    }
    return monthly.select("*", *[c.alias(name) for name, c in added.items()])


def densify_months(monthly: DataFrame, spec: PanelSpec = PRICE_PANEL) -> DataFrame:
    """Add the absent months between the rows of each series; all but keys and date are null."""
    upto = F.coalesce(
        F.add_months(F.lead(spec.date).over(spec.ordered()), -1), F.col(spec.date)
    )
    spread = monthly.withColumn("__to", upto).withColumn(
        "__m", F.explode(F.sequence(F.col(spec.date), F.col("__to"), F.expr("interval 1 month")))
    )
    own = F.col("__m") == F.col(spec.date)
    return spread.select(
        *[
            F.col("__m").alias(c) if c == spec.date
            else F.col(c) if c in spec.keys
            else F.when(own, F.col(c)).alias(c)
            for c in monthly.columns
        ]
    )


def latest_rows(df: DataFrame, keys: Sequence[str], date: str, tie: Sequence[str]) -> DataFrame:
    """One row per key: the first row (by ``tie``) of the latest date.

    Works on raw rows. Two aggregates, first per key and date, then per key, both combined before
    the shuffle: the rows of a hot key never meet in one task, and nothing is joined.
    """
    cols = [c for c in df.columns if c not in (*keys, date)]
    per_day = df.groupBy(*keys, date).agg(F.min_by(F.struct(*cols), F.struct(*tie)).alias("__r"))
    last = per_day.groupBy(*keys).agg(
        F.max(date).alias(date), F.max_by("__r", F.col(date)).alias("__r")
    )
    return last.select(*keys, date, "__r.*").select(*df.columns)
