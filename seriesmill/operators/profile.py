"""Shape, completeness and correlation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def _stacked(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    # one row in, one row per column out
    pairs = F.array(
        *[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in columns]
    )
    return row.select(F.explode(pairs).alias("p")).select(f"p.{name}", f"p.{value}")


def shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table, one row each."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        out = part if out is None else out.unionByName(part)
    return out


def nonnull_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Known values per column, fewest gaps first; a single pass for all columns."""
    cols = list(columns or df.columns)
    row = df.agg(*[F.count(f"`{c}`").alias(c) for c in cols])
    return _stacked(row, cols, "column_name", "n_known").orderBy(F.desc("n_known"), "column_name")


def series_lengths(df: DataFrame, keys: Sequence[str], date: str = "date_id") -> DataFrame:
    """Distinct dates per series, shortest series first."""
    return df.groupBy(*keys).agg(F.countDistinct(date).alias("n_months")).orderBy("n_months", *keys)


def value_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(key)


def correlations(df: DataFrame, target: str, candidates: Sequence[str], top: int | None = 30) -> DataFrame:
    """Pearson correlation of each candidate with the target, strongest first.

    Each pair uses the rows where both are known; all pairs share one pass.
    """
    cols = [c for c in candidates if c in df.columns and c != target]
    row = df.agg(*[F.corr(F.col(f"`{target}`"), F.col(f"`{c}`")).alias(c) for c in cols])
    out = _stacked(row, cols, "feature", "corr")
    ranked = out.orderBy(F.abs("corr").desc_nulls_last(), "feature")
    return ranked.limit(top) if top else ranked
