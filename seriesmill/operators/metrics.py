"""Scores of predictions, their summaries and the choice of a model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

NEAR_ZERO = 1e-8
REGRESSION_SCORES = ("rmse", "mae", "mape", "r2")


def regression_aggs(truth: str, guess: str) -> list[Column]:
    """RMSE, MAE, MAPE in percent (truth near zero left out) and R²."""
    y, p = F.col(truth), F.col(guess)
    error = y - p
    relative = F.when(F.abs(y) >= NEAR_ZERO, F.abs(error / F.abs(y)))
    spread = F.var_pop(y) * F.count(y)
    unexplained = F.sum(error * error)
    # a constant truth has no spread to explain: 1 for a perfect guess, else 0
    r2 = (
        F.when(F.count(y) < 2, None)
        .when(F.min(y) == F.max(y), F.when(unexplained == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(unexplained, spread))
    )
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(relative) * 100).alias("mape"),
        r2.alias("r2"),
    ]


def regression_metrics(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    rows = df.where(F.col(truth).isNotNull() & F.col(guess).isNotNull())
    return rows.groupBy(*by).agg(*regression_aggs(truth, guess))


def accuracy(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    rows = df.where(F.col(truth).isNotNull() & F.col(guess).isNotNull())
    hit = F.when(F.col(truth) == F.col(guess), 1.0).otherwise(0.0)
    return rows.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def union_scores(regression: DataFrame, classification: DataFrame) -> DataFrame:
    """All score rows; scores a task does not have are null."""
    return regression.unionByName(classification, allowMissingColumns=True)


def score_summary(scores: DataFrame) -> DataFrame:
    """Mean of every score per task, horizon and model."""
    found = [c for c in (*REGRESSION_SCORES, "accuracy") if c in scores.columns]
    return scores.groupBy("task", "horizon", "model_name").agg(*[F.avg(c).alias(c) for c in found])


def best_models(summary: DataFrame) -> DataFrame:
    """The winner per task and horizon.

    Regression: lowest RMSE, then MAE, then MAPE. Classification: highest accuracy. Remaining
    ties go to the lowest model name. The summary has one row per model, so groups are tiny.
    """
    order = [
        F.when(F.col("task") == "regression", F.col("rmse")).asc_nulls_last(),
        F.when(F.col("task") == "regression", F.col("mae")).asc_nulls_last(),
        F.when(F.col("task") == "regression", F.col("mape")).asc_nulls_last(),
        F.col("accuracy").desc_nulls_last(),
        F.col("model_name"),
    ]
    w = Window.partitionBy("task", "horizon").orderBy(*order)
    return summary.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def majority_class(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent label, ties to the smallest; the label has a handful of values."""
    return df.where(F.col(label).isNotNull()).groupBy(*by).agg(F.mode(label, True).alias("majority"))
