"""Gap fills against plain loops, with small blocks so that anchors cross block borders."""

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as some
from pyspark.sql import functions as F

from seriesmill.operators import fills

D0 = dt.date(2024, 1, 1)


def frame(spark, values, key="a"):
    rows = [(key, i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, i bigint, v double")


def values(df):
    return [r["v"] for r in df.orderBy("i").collect()]


def test_forward_fill(spark):
    df = frame(spark, [None, 6000, None, None, 6100, None])
    got = fills.forward_fill(df, ["k"], "i", ["v"], fills.number_block("i", 2))
    assert values(got) == [None, 6000, 6000, 6000, 6100, 6100]
    assert got.columns == df.columns


def test_neighbor_mean(spark):
    df = frame(spark, [None, 12900, None, 14400, None])
    got = fills.neighbor_mean_fill(df, ["k"], "i", ["v"], block=fills.number_block("i", 2))
    assert values(got) == [12900, 12900, 13650, 14400, 14400]


def test_cascade_blanks_columns_to_the_right(spark):
    rows = [(1, 10.0, 100.0), (2, None, 500.0), (3, 30.0, 200.0)]
    df = spark.createDataFrame(rows, "i bigint, a double, b double")
    got = fills.neighbor_mean_fill(df, [], "i", ["a", "b"], cascade=True, block=fills.number_block("i", 2))
    assert [tuple(r) for r in got.orderBy("i").collect()] == [(1, 10, 100), (2, 20, 150), (3, 30, 200)]


def test_linear_days(spark):
    days = [(dt.date(2026, 3, 13), 13675.0), (dt.date(2026, 3, 16), 12400.0)]
    got = fills.linear_interpolate(spark.createDataFrame(days, "d date, v double"), [], "d", ["v"])
    assert [r["v"] for r in got.orderBy("d").collect()] == [13675, 13250, 12825, 12400]


def test_linear_start_keeps_earlier_gaps(spark):
    days = [(dt.date(2025, 1, 1), 1.0), (dt.date(2025, 1, 4), 4.0), (dt.date(2025, 1, 6), 6.0)]
    got = fills.linear_interpolate(spark.createDataFrame(days, "d date, v double"), [], "d", ["v"], "2025-01-04")
    assert [(r["d"].day, r["v"]) for r in got.orderBy("d").collect()] == [(1, 1), (4, 4), (5, 5), (6, 6)]


def test_unknown_ends_stay_unknown(spark):
    days = [(D0 + dt.timedelta(i), v) for i, v in [(0, None), (1, 2.0), (3, 6.0), (5, None)]]
    got = fills.linear_interpolate(spark.createDataFrame(days, "d date, v double"), [], "d", ["v"])
    assert [r["v"] for r in got.orderBy("d").collect()] == [None, 2, 4, 6, None, None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(some.lists(some.one_of(some.none(), some.integers(0, 99)), min_size=1, max_size=30), some.integers(1, 7))
def test_fills_match_pandas(spark, series, size):
    a, b = frame(spark, series, "a"), frame(spark, series[::-1], None)
    df = a.unionByName(b)
    block = fills.number_block("i", size)
    ff = fills.forward_fill(df, ["k"], "i", ["v"], block).toPandas()
    nm = fills.neighbor_mean_fill(df, ["k"], "i", ["v"], block=block).toPandas()
    for key, vals in (("a", series), (None, series[::-1])):
        s = pd.Series(vals, dtype="float64")
        pick = lambda p: p[p.k.isna() if key is None else p.k == key].sort_values("i").v.reset_index(drop=True)
        pd.testing.assert_series_equal(pick(ff), s.ffill(), check_names=False)
        mean = ((s.ffill() + s.bfill()) / 2).fillna(s.ffill()).fillna(s.bfill())
        pd.testing.assert_series_equal(pick(nm), s.fillna(mean), check_names=False)


def test_hot_series_runs_in_small_windows(spark):
    """One series holds all rows; every row-level window is partitioned by block as well."""
    df = spark.range(20000).select(
        F.lit("hot").alias("k"), F.col("id").alias("i"), F.when(F.col("id") % 3 == 0, F.col("id") * 1.0).alias("v")
    )
    got = fills.forward_fill(df, ["k"], "i", ["v"], fills.number_block("i", 500))
    assert got.where(F.col("v") != F.col("i") - F.col("i") % 3).count() == 0
    assert got.count() == 20000


def test_repeated_days_invent_no_rows(spark):
    rows = [("a", dt.date(2024, 1, d), v) for d, v in ((3, 1.0), (3, 5.0), (6, 4.0), (6, None))]
    dense = fills.densify_daily(spark.createDataFrame(rows, "k string, d date, v double"), ["k"], "d")
    assert sorted((r.d.day, r.v) for r in dense.collect() if r.v is not None) == [(3, 1.0), (3, 5.0), (6, 4.0)]
    assert sorted(r.d.day for r in dense.collect()) == [3, 3, 4, 5, 6, 6]
