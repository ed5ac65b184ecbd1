"""Forecast rows for the latest month of each series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill import fixed
from seriesmill.functions import dates
from seriesmill.sources import files


def direction_label(direction: Column, labels=None) -> Column:
    labels = labels or fixed.DIRECTION_LABELS
    out = None
    for value, text in labels.items():
        out = F.when(direction == value, text) if out is None else out.when(direction == value, text)
    return out


def horizon_rows(latest: DataFrame, horizons: Sequence[int] = fixed.HORIZONS) -> DataFrame:
    """Every latest row once per horizon, with the month the forecast is for."""
    ahead = F.explode(F.array(*[F.lit(h) for h in horizons]))
    rows = latest.withColumn("forecast_horizon_month", ahead)
    return rows.withColumn(
        "forecast_month", dates.forecast_month(F.col("date_id"), F.col("forecast_horizon_month"))
    )


def finish(rows: DataFrame) -> DataFrame:
    """Round the price, add the label, fix the column order."""
    keep = [c for c in fixed.FORECAST_BASE if c in rows.columns]
    return rows.select(
        *keep,
        "forecast_horizon_month",
        "forecast_month",
        F.round("predicted_price", 2).alias("predicted_price"),
        "predicted_direction",
        direction_label(F.col("predicted_direction")).alias("predicted_direction_label"),
    )


def last_value_forecast(panel: DataFrame, horizons: Sequence[int] = fixed.HORIZONS) -> DataFrame:
    """The plain reference forecast: price stays, direction repeats the last change."""
    rows = horizon_rows(panel.where("row_is_latest"), horizons)
    moved = F.col("price_rice_diff_1")
    return finish(
        rows.withColumn("predicted_price", F.col("price_rice")).withColumn(
            "predicted_direction", F.when(moved > 0, 1.0).otherwise(0.0)
        )
    )


def export(forecast: DataFrame) -> DataFrame:
    """Report layout with month labels, ordered by target month and variety."""
    base, ahead = F.col("date_id"), F.col("forecast_month")
    out = forecast.withColumns(
        {
            "thang_goc_du_bao": dates.month_label(base),
            "thang_du_bao": dates.month_label(ahead),
            "nam_du_bao": F.year(ahead),
            "thang_so_du_bao": F.month(ahead),
        }
    ).withColumnsRenamed(fixed.EXPORT_NAMES)
    return out.select(*fixed.EXPORT_FIELDS).orderBy("nam_du_bao", "thang_so_du_bao", "rice_id")


def write_forecast(forecast: DataFrame, folder: str) -> None:
    """Forecast rows and their report layout as CSV below ``folder``; a repeated run replaces both."""
    base = folder.rstrip("/")
    files.write_csv(forecast, f"{base}/forecast", "overwrite")
    files.write_csv(export(forecast), f"{base}/forecast_export", "overwrite")
