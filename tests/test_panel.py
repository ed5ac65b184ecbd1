"""Daily base, monthly panel, folds, scores."""

import datetime as dt
import math

import pytest
from pyspark.sql import Row, functions as F

from seriesmill import fixed
from seriesmill.operators import daily, folds, forecast, metrics, panel, profile, roles

FACT = (
    "date_id date, region_id bigint, eco_id bigint, weather_id bigint, rice_id string, fert_id string, "
    "price_rice double, price_fert double, avg_temperature double, row_key bigint"
)
D = dt.date(2024, 1, 1)


def facts(spark):
    rows = [
        (D, 1, 10, None, "R01", None, 100.0, None, 20.0, 1),
        (D, 1, None, 7, "R01", None, 200.0, None, 30.0, 2),
        (D, 1, 11, 8, "R09", None, 999.0, None, None, 3),
        (D, 1, None, None, None, "F1", None, 50.0, None, 4),
        (D, 1, None, None, None, "F1", None, 70.0, None, 5),
        (D, 2, None, None, "R02", None, None, None, None, 6),
        (D, None, 5, 5, "R01", None, 1.0, None, 1.0, 7),
        (None, 1, 5, 5, "R01", None, 1.0, None, 1.0, 8),
    ]
    return spark.createDataFrame(rows, FACT)


def test_context_takes_last_known_id(spark):
    got = {r["region_id"]: r for r in daily.daily_context(facts(spark), "row_key").collect()}
    assert set(got) == {1, 2}
    assert (got[1]["eco_id"], got[1]["weather_id"], got[1]["avg_temperature"]) == (11, 8, 25.0)
    assert got[2]["eco_id"] is None


def test_target_filters_and_averages(spark):
    got = [tuple(r) for r in daily.daily_target(facts(spark)).collect()]
    assert got == [(D, 1, "R01", 150.0)]


def test_fused_and_joined_facts_agree(spark):
    fused = daily.daily_facts(facts(spark), "row_key", ["R01", "R09"], ["F1"])
    joined = daily.daily_facts(facts(spark), "row_key", None, ["F1"])
    assert sorted(map(repr, fused.select(sorted(fused.columns)).collect())) == sorted(
        map(repr, joined.select(sorted(joined.columns)).collect())
    )
    assert daily.fertilizer_ids(facts(spark)) == ["F1"]
    assert {r["price_fert_F1"] for r in fused.collect()} == {60.0}


def test_null_safe_dimension_join(spark):
    left = spark.createDataFrame([(1,), (None,)], "eco_id bigint")
    dim = spark.createDataFrame([(1, "one"), (None, "unknown")], "eco_id bigint, cpi_status string")
    plain = daily.join_dimension(left, dim, "eco_id", ["cpi_status"])
    safe = daily.join_dimension(left, dim, "eco_id", ["cpi_status"], null_safe=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, [Row(eco_id=1, cpi_status="one"), Row(eco_id=None, cpi_status=None)]))
    assert {r["cpi_status"] for r in safe.collect()} == {"one", "unknown"}


SPEC = panel.PanelSpec(keys=("k",), date="d", target="p", measures=("m",), categories=("c",))


def daily_rows(spark, rows):
    return spark.createDataFrame(rows, "k string, d date, p double, m double, c string")


def build(spark, prices, months=None, **kw):
    months = months or range(1, len(prices) + 1)
    rows = [("a", dt.date(2024, m, 15), p, float(m), "x") for m, p in zip(months, prices)]
    return panel.monthly_panel(daily_rows(spark, rows), SPEC, **kw).orderBy("d").collect()


def test_monthly_mean_and_mode(spark):
    rows = [("a", dt.date(2024, 1, i + 1), p, None, c) for i, (p, c) in enumerate([(1.0, "b"), (2.0, "a"), (3.0, "b"), (6.0, "a")])]
    for unique in (True, False):
        got = panel.monthly_aggregate(daily_rows(spark, rows), SPEC, unique).collect()
        assert [tuple(r[c] for c in ("d", "k", "p", "m", "c")) for r in got] == [(D, "a", 3.0, None, "a")]
    empty = daily_rows(spark, [("a", D, 1.0, None, None)])
    assert panel.monthly_aggregate(empty, SPEC).first()["c"] is None


def test_lags_count_rows_not_months(spark):
    got = build(spark, [1.0, 2.0, 4.0], months=[1, 2, 4])
    assert [r["p_lag_1"] for r in got] == [None, 1.0, 2.0]
    dense = build(spark, [1.0, 2.0, 4.0], months=[1, 2, 4], calendar=True)
    assert [r["p_lag_1"] for r in dense] == [None, 1.0, 2.0, None]
    assert [r["d"].month for r in dense] == [1, 2, 3, 4]


def test_rolling_change_and_direction(spark):
    got = build(spark, [0.0, 5.0, 5.0, 3.0])
    assert got[0]["p_roll_std_2"] is None and got[1]["p_roll_std_2"] == pytest.approx(math.sqrt(12.5))
    assert got[2]["p_roll_mean_3"] == pytest.approx(10 / 3)
    assert [r["p_diff_1"] for r in got] == [None, 5.0, 0.0, -2.0]
    assert [r["p_pct_change_1"] for r in got] == [None, None, 0.0, pytest.approx(-0.4)]
    assert [r["direction_t_plus_1"] for r in got] == [1.0, None, 0.0, None]
    assert [r["target_t_plus_2"] for r in got] == [5.0, 3.0, None, None]
    assert [r["row_is_latest"] for r in got] == [False, False, False, True]


def test_latest_rows_on_raw_ties(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 9, "y"), ("a", 2, 3, "z"), ("b", 1, 1, "w")], "k string, d int, t int, v string")
    assert sorted(map(tuple, panel.latest_rows(df, ["k"], "d", ["t"]).collect())) == [("a", 2, 3, "z"), ("b", 1, 1, "w")]


def test_frequent_value_with_hot_key(spark):
    df = spark.range(9000).select(F.lit("hot").alias("k"), (F.col("id") % 3).cast("string").alias("v"))
    assert panel.frequent_value(df, ["k"], "v").first()["v"] == "0"


def wide_panel(spark, n_months=20):
    rows = [
        (k, dt.date(2022 + (m // 12), m % 12 + 1, 1), 100.0 + m * (1 if k == "a" else -1), float(m), "x")
        for k in "ab" for m in range(n_months)
    ]
    return panel.monthly_panel(daily_rows(spark, rows), SPEC)


def test_panel_has_one_exchange(spark):
    plan = wide_panel(spark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan
    assert plan.count("Window") - plan.count("WindowGroupLimit") <= 2


def test_panel_rows_and_roles(spark):
    p = wide_panel(spark)
    assert p.count() == 40
    r = roles.infer_roles(p, "d", "p", ("k",), as_category=["month_num"])
    assert "c" in r.categorical and "month_num" in r.categorical
    assert not [c for c in r.features if c.startswith(("target_", "direction_"))]
    assert "p" not in r.features and "row_is_latest" not in r.features
    with pytest.raises(ValueError):
        roles.label_name("ranking", 1)


def test_default_panel_width(spark):
    source = spark.createDataFrame([], FACT)
    base = daily.daily_facts(source, "row_key", fert_ids=["A", "B", "C"])
    missing = [c for c in fixed.CONTEXT_MEASURES if c not in base.columns]
    base = base.withColumns({c: F.lit(1.0) for c in missing})
    base = base.withColumns({c: F.lit("x") for c in fixed.PANEL_CATEGORIES if c not in base.columns})
    ferts = [c for c in base.columns if c.startswith("price_fert_")]
    assert len(ferts) == 3 and len(panel.monthly_panel(base).columns) == 163


def test_folds(spark):
    months = spark.range(20).select(F.add_months(F.lit(D), F.col("id").cast("int")).alias("date_id"))
    rows = folds.expanding_folds(months).collect()
    train = {f: sum(r["fold"] == f and r["role"] == "train" for r in rows) for f in range(1, 7)}
    assert train == {1: 14, 2: 15, 3: 16, 4: 17, 5: 18, 6: 19}
    for fold, last_train, first, last in folds.fold_bounds(folds.expanding_folds(months)):
        assert last_train < first == last
    held_back = folds.fold_bounds(folds.expanding_folds(months, embargo=2))
    assert all((b[2].year - b[1].year) * 12 + b[2].month - b[1].month == 3 for b in held_back)
    few = folds.expanding_folds(months, max_splits=50, valid=3)
    assert few.select("fold").distinct().count() == 6
    with pytest.raises(ValueError):
        folds.fold_bounds(folds.expanding_folds(months, min_train=20))


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, 1.0)], "y double, p double")
    m = metrics.regression_metrics(df, "y", "p").first()
    assert m["rmse"] == pytest.approx(math.sqrt(2 / 3)) and m["mae"] == pytest.approx(2 / 3)
    assert m["mape"] == pytest.approx(50.0) and m["r2"] == pytest.approx(1 - 2 / (14 / 3))
    assert metrics.regression_metrics(df.where("y = 3"), "y", "p").first()["r2"] is None
    same = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, p double")
    assert metrics.regression_metrics(same, "y", "p").first()["r2"] == 1.0
    assert metrics.accuracy(df, "y", "p").first()["accuracy"] == pytest.approx(1 / 3)


def test_best_model_ties_go_to_the_lowest_name(spark):
    cls = spark.createDataFrame([("classification", 3, n, 1, a) for n, a in [("z", 1.0), ("b", 1.0), ("a", 0.5)]],
                                "task string, horizon int, model_name string, fold int, accuracy double")
    reg = spark.createDataFrame([("regression", 3, "m", 1, 2.0, 1.0, 1.0, 0.1), ("regression", 3, "n", 1, 2.0, 0.5, 9.0, 0.1)],
                                "task string, horizon int, model_name string, fold int, rmse double, mae double, mape double, r2 double")
    scores = metrics.union_scores(reg, cls)
    assert scores.where("task = 'classification' AND rmse IS NOT NULL").count() == 0
    best = {r["task"]: r["model_name"] for r in metrics.best_models(metrics.score_summary(scores)).collect()}
    assert best == {"classification": "b", "regression": "n"}


def test_forecast_labels(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,)], "x double")
    assert [r[0] for r in df.select(forecast.direction_label(F.col("x"))).collect()] == ["Tăng", "Giảm/Đi ngang", None]


def test_repeated_dimension_keys(spark):
    dims = {name: spark.createDataFrame([(1,), (2,)], f"{key} int") for name, (key, _) in daily.DIM_COLUMNS.items()}
    dims["dim_region"] = spark.createDataFrame([(1,), (1,)], "region_id int")
    assert [tuple(r) for r in daily.repeated_dimension_keys(dims).collect()] == [("dim_region", "1", 2)]


def test_correlations_rank_by_strength(spark):
    df = spark.createDataFrame([(1.0, -1.0, 1.0), (2.0, -2.0, 1.5), (3.0, -3.0, 0.0)], "t double, a double, b double")
    got = profile.correlations(df, "t", ["b", "a", "absent"]).collect()
    assert [r["feature"] for r in got] == ["a", "b"] and got[0]["corr"] == pytest.approx(-1.0)


def test_columns_with_dots_in_their_names(spark):
    """Fertilizer ids come from the data and become column names."""
    days = [dt.date(2023, 1 + m, 3) for m in range(8)]
    rows = [("k", d, float(i), 2.0 * i, "a") for i, d in enumerate(days)]
    name = "price_fert_NPK 16.16.8"
    frame = spark.createDataFrame(rows, ["k", "d", "p", "f", "c"]).withColumnRenamed("f", name)
    spec = panel.PanelSpec(keys=("k",), date="d", target="p", measures=(), categories=("c",))
    last = panel.monthly_panel(frame, spec).orderBy(F.desc("d")).first()
    assert last[name] == 14.0 and last[f"{name}_lag_1"] == 12.0 and last[f"{name}_roll_mean_2"] == 13.0
    assert profile.correlations(frame, "p", [name]).first()["corr"] == pytest.approx(1.0)
