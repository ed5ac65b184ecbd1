"""Features and models on small learnable data."""

import datetime as dt
import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as some
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from seriesmill import session
from seriesmill.operators import features, folds, metrics, models, panel, roles
from seriesmill.session import fresh_dir
from seriesmill.sources import bundles

TINY = models.ModelSettings(trees=10, wide_trees=10, boosts=10, rate=0.3, depth=5, net_steps=100, logit_steps=50)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(some.lists(some.one_of(some.none(), some.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_median_is_exact(spark, xs):
    df = spark.createDataFrame([(x, None) for x in xs], "a double, b double")
    known = [x for x in xs if x is not None]
    got = features.exact_medians(df, ["a", "b"])
    assert got["b"] is None
    assert got["a"] == (pytest.approx(statistics.median(known)) if known else None)


def test_median_in_many_passes(spark, monkeypatch):
    # few parts cost more passes, never a wrong answer; no pass gathers values or windows over a column
    monkeypatch.setattr(features, "RANGES", 8)
    df = spark.range(100_000).select(
        (F.col("id") * 7919 % 100_000).cast("double").alias("x"), F.exp(F.col("id") % 600 - 300.0).alias("y"), F.lit(float("inf")).alias("z")
    )
    found = features.exact_medians(df, ["x", "y", "z"])
    assert found["x"] == 49_999.5 and found["z"] is None
    assert found["y"] == df.selectExpr("median(y)").first()[0]


def test_median_with_one_hot_value(spark):
    df = spark.range(9_999).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("x"))
    want = statistics.median(5.0 if i % 3 == 0 else float(i) for i in range(9_999))
    assert features.exact_medians(df, ["x"])["x"] == want


def test_text_encoding(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", None), (None, 9.0)], "c string, x double")
    new = spark.createDataFrame([("zzz", None), (None, 4.0)], "c string, x double")
    learned = features.learn(train, ["x"], ["c"])
    assert learned.medians == {"x": 2.0} and learned.modes == {"c": "b"}
    hot = PipelineModel(features.preprocessing_stages(train, learned, "onehot")).transform(new)
    assert [list(r[0]) for r in hot.select(vector_to_array("features")).collect()] == [[2.0, 0.0, 0.0], [4.0, 0.0, 1.0]]
    code = PipelineModel(features.preprocessing_stages(train, learned, "ordinal")).transform(new)
    assert [list(r[0]) for r in code.select(vector_to_array("features")).collect()] == [[2.0, -1.0], [4.0, 1.0]]
    scaled = PipelineModel(features.preprocessing_stages(train, learned, "onehot", True)).transform(train)
    assert scaled.agg(F.avg(vector_to_array("features")[0])).first()[0] == pytest.approx(0.0)
    with pytest.raises(ValueError):
        features.preprocessing_stages(train, learned, "other")


def small_panel(spark):
    """Two series that move by a known rule, so that a model can beat the last value."""
    rows = []
    for k, step in (("a", 10.0), ("b", -7.0)):
        for m in range(24):
            price = 500.0 + step * m + (40.0 if m % 2 else 0.0)
            rows.append((k, 1, dt.date(2022 + m // 12, m % 12 + 1, 3), price, float(m % 2), "x" if k == "a" else "y"))
    df = spark.createDataFrame(rows, "rice_id string, region_id bigint, date_id date, price_rice double, avg_temperature double, rice_name string")
    return panel.monthly_panel(df, panel.PanelSpec(max_target_lag=3, max_feature_lag=1, rolling_windows=(2,)))


@pytest.fixture(scope="module")
def trained(spark, request):
    p = small_panel(spark).persist()
    folder = fresh_dir(spark, "models")
    few = {"regression": ["elastic_net", "random_forest"], "classification": ["random_forest_cls"]}
    scores, chosen = models.train_best_models(p, folder, [1], TINY, few, max_splits=2)
    return p, folder, scores, chosen


def test_training_writes_everything(spark, trained):
    p, folder, scores, chosen = trained
    assert scores.where("task = 'regression'").count() == 4
    assert scores.where("rmse IS NULL AND accuracy IS NULL").count() == 0
    assert spark.read.option("header", True).csv(f"{folder}/benchmark_scores").count() == scores.count()
    assert spark.read.option("header", True).csv(f"{folder}/selected_models").count() == 1
    assert spark.read.json(f"{folder}/training_metadata").first()["selected_models"][0]["horizon"] == 1


def test_best_model_beats_the_last_value(spark, trained):
    p, folder, scores, chosen = trained
    best = scores.where("task = 'regression'").groupBy("model_name").agg(F.avg("rmse").alias("r")).agg(F.min("r")).first()[0]
    known = p.where("target_t_plus_1 IS NOT NULL")
    held = folds.with_folds(known, folds.expanding_folds(known, max_splits=2).where("role = 'valid'"))
    naive = metrics.regression_metrics(held, "target_t_plus_1", "price_rice").first()["rmse"]
    assert best < naive


def test_prediction_from_saved_models(spark, trained):
    p, folder, *_ = trained
    p = p.drop("avg_temperature_lag_1")  # a feature the new data lacks
    got = models.predict_latest(p.withColumn("region_name", F.lit("r")).withColumn("rice_group", F.lit("g")), folder, [1]).collect()
    assert len(got) == 2
    for r in got:
        assert r["forecast_month"] == dt.date(2024, 1, 1) and r["predicted_price"] is not None
        assert r["predicted_direction_label"] in ("Tăng", "Giảm/Đi ngang")
    with pytest.raises(FileNotFoundError):
        bundles.load_bundle(spark, folder, 9, "regression")


def test_one_class_folds_are_skipped(spark):
    rows = [("a", 1, dt.date(2022 + m // 12, m % 12 + 1, 3), 100.0 + m, 1.0, "x") for m in range(16)]
    df = spark.createDataFrame(rows, "rice_id string, region_id bigint, date_id date, price_rice double, avg_temperature double, rice_name string")
    p = panel.monthly_panel(df, panel.PanelSpec(max_target_lag=1, max_feature_lag=1, rolling_windows=(2,)))
    few = {"regression": ["elastic_net"], "classification": ["random_forest_cls"]}
    scores = models.evaluate_horizon(p, 1, max_splits=1, settings=TINY, models=few)
    assert [r["task"] for r in scores.collect()] == ["regression"]
    folder = fresh_dir(spark, "models")
    _, chosen = models.train_best_models(p, folder, [1], TINY, few, max_splits=1)
    assert chosen.first()["best_classification_model"] == models.MAJORITY
    bundle = bundles.load_bundle(spark, folder, 1, "classification")
    assert bundle.model.transform(p).select("prediction").distinct().first()[0] == 1.0


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_every_family_fits_the_same_twice(spark, task):
    p = small_panel(spark)
    r, label = roles.infer_roles(p), roles.label_name(task, 1)
    matrix = roles.training_matrix(p, 1, task, r).persist()
    learned = features.learn(matrix, r.numeric, r.categorical)
    for name, recipe in models.recipes(task, TINY).items():
        runs = [
            models.fit_model(matrix, recipe, r, label, learned).transform(matrix).agg(F.sum("prediction")).first()[0]
            for _ in range(2)
        ]
        assert runs[0] == pytest.approx(runs[1]), name
    matrix.unpersist()


def test_fits_start_a_task_per_part_of_rows(spark, monkeypatch):
    # a panel made by many tasks costs the many jobs of a fit no more tasks than its rows need
    made = small_panel(spark).repartition(24, "date_id")
    spread = spark.read.parquet(_written(made))
    assert spread.rdd.getNumPartitions() > 1
    parts = []

    def fit(train, *a, run=models.fit_model, **b):
        parts.append(train.rdd.getNumPartitions())
        return run(train, *a, **b)

    monkeypatch.setattr(models, "fit_model", fit)
    few = {"regression": ["elastic_net"], "classification": ["gradient_boosting_cls"]}
    models.evaluate_horizon(spread, 1, min_train=12, valid=3, max_splits=1, settings=TINY, models=few)
    assert parts and set(parts) == {1}


def _written(df):
    path = fresh_dir(df.sparkSession, "spread")
    df.write.parquet(path)
    return path


def test_compact_keeps_rows_and_bounds_parts(spark, monkeypatch):
    rows = spark.range(100).repartition(10)
    one = session.settle_compact(rows, "compact")
    assert one.rdd.getNumPartitions() == 1 and sorted(r.id for r in one.collect()) == list(range(100))
    monkeypatch.setattr(session, "PART_ROWS", 30)
    assert 1 < session.settle_compact(rows, "compact").rdd.getNumPartitions() <= 4
    assert session.settle_compact(rows.where("id < 0"), "compact").count() == 0


@pytest.mark.parametrize("few", [0, 16_384])
def test_medians_of_few_and_many_rows_agree(spark, monkeypatch, few):
    monkeypatch.setattr(features, "FEW_ROWS", few, raising=False)
    odd = [float("nan"), float("inf"), -float("inf"), None, 0.1, 0.3, -7.0, 0.3, 1e9, 2.0]
    df = spark.createDataFrame([(x, None, i, i % 2 == 0) for i, x in enumerate(odd)], "a double, b double, c int, d boolean")
    assert features.exact_medians(df, ["a", "b", "c"]) == {"a": 0.3, "b": None, "c": 4.5}
    assert features.exact_medians(df.where("c < 0"), ["a"]) == {"a": None}
    wide = df.select(*[(F.col("c") + k).alias(f"x{k}") for k in range(130)])
    assert features.exact_medians(wide, wide.columns) == {f"x{k}": 4.5 + k for k in range(130)}
