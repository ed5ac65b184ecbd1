"""Expanding-window folds over months."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from seriesmill import fixed


def expanding_folds(
    panel: DataFrame,
    date: str = "date_id",
    min_train: int = fixed.MIN_TRAIN_MONTHS,
    valid: int = fixed.VALID_MONTHS,
    max_splits: int = fixed.MAX_SPLITS,
    embargo: int = 0,
) -> DataFrame:
    """Fold, month and role (``train`` or ``valid``).

    Fold i trains on the first i months and validates on the next ``valid`` months; the last
    ``max_splits`` folds are kept and numbered from 1. ``embargo`` leaves out the last months of
    the training part. Only the distinct months are ranked, so the unpartitioned window sees
    nothing but a calendar.
    """
    months = panel.select(F.trunc(date, "MM").alias("month")).where("month IS NOT NULL").distinct()
    everything = Window.partitionBy(F.lit(1))
    ranked = months.select(
        "month",
        F.row_number().over(everything.orderBy("month")).alias("r"),
        F.count(F.lit(1)).over(everything).alias("n"),
    )
    first_cut = F.greatest(F.lit(min_train), F.col("n") - valid - max_splits + 1)
    cuts = ranked.withColumn(
        "cut",
        F.explode(
            F.when(
                F.col("n") - valid >= first_cut, F.sequence(first_cut, F.col("n") - valid)
            ).otherwise(F.array().cast("array<int>"))
        ),
    )
    role = F.when(F.col("r") <= F.col("cut") - embargo, "train").when(
        (F.col("r") > F.col("cut")) & (F.col("r") <= F.col("cut") + valid), "valid"
    )
    return cuts.select(
        (F.col("cut") - first_cut + 1).cast("int").alias("fold"), "month", role.alias("role")
    ).where(F.col("role").isNotNull())


def fold_bounds(folds: DataFrame) -> list[tuple[int, object, object, object]]:
    """``(fold, last train month, first valid month, last valid month)``: at most ``max_splits`` rows."""
    train, held = F.col("role") == "train", F.col("role") == "valid"
    rows = (
        folds.groupBy("fold")
        .agg(
            F.max(F.when(train, F.col("month"))).alias("t"),
            F.min(F.when(held, F.col("month"))).alias("a"),
            F.max(F.when(held, F.col("month"))).alias("b"),
        )
        .where("t IS NOT NULL AND a IS NOT NULL")
        .orderBy("fold")
        .collect()
    )
    if not rows:
        raise ValueError("not enough months for a time split; lower min_train")
    return [(r["fold"], r["t"], r["a"], r["b"]) for r in rows]


def with_folds(panel: DataFrame, folds: DataFrame, date: str = "date_id") -> DataFrame:
    """Panel rows once per fold they take part in.

    The folds are a calendar, at most ``max_splits`` rows per month, and go to every task: the rows of a
    month are never gathered.
    """
    member = F.broadcast(folds.withColumnRenamed("month", "__month"))
    return panel.withColumn("__month", F.trunc(date, "MM")).join(member, "__month").drop("__month")
