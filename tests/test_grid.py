"""The grid of fits inside tasks, beside Spark's own fits of the same families."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from seriesmill import fixed
from seriesmill.operators import extra_trees, features, folds, grid, local_trees as lt, models, panel, roles
from seriesmill.plans import panel_queries
from seriesmill.session import fresh_dir

TINY = models.ModelSettings(trees=7, wide_trees=6, boosts=6, rate=0.3, depth=5, net_steps=2_000, logit_steps=500)
SCHEMA = "rice_id string, region_id bigint, date_id date, price_rice double, avg_temperature double, rice_name string, region_name string, rice_group string"


def rows_of(n, width=4, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)), 2)
    x[:, 1] = x[:, 1] > 0
    x[:, 2] = 1.5  # never cut
    return x, np.round(2 * x[:, 0] - 3 * x[:, 1] + rng.normal(scale=0.3, size=n), 3)


def uneven_panel(spark, months=24):
    """Three series with gaps, unknown numbers and texts, and texts first seen late."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(3):
        for m in range(months):
            if (m + k) % 11:
                price = float(500 + 12 * k + 9 * np.sin(m / 2 + k) + rng.normal(scale=4))
                name = None if m % 7 == 3 else "late" if m > months - 4 else "ab"[k % 2]
                rows.append((f"r{k}", 1, dt.date(2022 + m // 12, m % 12 + 1, 5), price, None if m % 5 == 2 else float(m % 4), name, "south", "x" if k else None))
    return panel.monthly_panel(spark.createDataFrame(rows, SCHEMA), panel.PanelSpec(max_target_lag=2, max_feature_lag=1, rolling_windows=(2,)))


@pytest.fixture(scope="module")
def small(spark):
    return uneven_panel(spark).persist()


def test_forecast_frame_does_the_published_work(spark, small, monkeypatch):
    # all horizons, every family, all six folds and both tasks, at the published sizes
    asked, real = [], grid.Grid.predictions

    def predictions(self, cells):
        asked.append((self.settings, cells))
        return real(self, cells)

    monkeypatch.setattr(panel_queries, "_panel", lambda *_: small)
    monkeypatch.setattr(grid.Grid, "predictions", predictions)
    got = panel_queries.forecast_frame(spark, "unused").collect()
    assert sorted({r.forecast_horizon_month for r in got}) == [1, 2, 3] and len(got) == 9
    assert all(r.predicted_price is not None and r.predicted_direction in (0.0, 1.0) for r in got)
    ((settings, cells),) = asked
    assert settings == models.ModelSettings() and len(cells) == len(set(cells)) == 2 * 3 * 4 * fixed.MAX_SPLITS
    for task in roles.TASKS:
        for h in fixed.HORIZONS:
            assert {(c[2], c[5][0]) for c in cells if c[:2] == (task, h)} == {(n, f) for n in models.recipes(task, settings) for f in range(1, 7)}


def test_cells_equal_the_fits_of_spark(spark, small):
    r = roles.infer_roles(small)
    made = grid.Grid(small.repartition(5), r, TINY)
    for task in roles.TASKS:
        label = roles.label_name(task, 2)
        matrix = roles.training_matrix(small, 2, task, r).persist()
        bounds = folds.fold_bounds(folds.expanding_folds(matrix))[0]
        bounds = (*bounds[:3], dt.date(2030, 1, 1))  # all months that are left
        chosen = models.recipes(task, TINY)
        got = made.predictions([(task, 2, n, c.encoding, c.scale, bounds) for n, c in chosen.items()]).collect()
        train, held = matrix.where(F.col("date_id") <= F.last_day(F.lit(bounds[1]))), matrix.where(F.col("date_id") >= F.lit(bounds[2]))
        learned = features.learn(train, r.numeric, r.categorical)
        for name, recipe in chosen.items():
            mine = sorted((x.truth, x.guess) for x in got if x.model_name == name)
            assert len(mine) == held.count() > 0
            if name.startswith(("random_forest", "gradient_boosting")):
                continue  # other rows are drawn; of two columns that part the training rows alike another may be taken
            want = models.fit_model(train, recipe, r, label, learned).transform(held).select(F.col(label).cast("double").alias("y"), "prediction").collect()
            for a, b in zip(mine, sorted(map(tuple, want))):
                assert a == pytest.approx(b, rel=1e-5, abs=1e-6), name
        matrix.unpersist()


@pytest.mark.parametrize("encoding, scale", [("onehot", True), ("onehot", False), ("ordinal", False)])
def test_inputs_equal_those_of_pipelines(spark, small, encoding, scale):
    r = roles.infer_roles(small)
    matrix = roles.training_matrix(small, 1, "regression", r)
    cut = dt.date(2023, 6, 1)
    train = matrix.where(F.col("date_id") < F.lit(dt.date(2023, 7, 1)))
    prep = features.preprocessing_stages(train, features.learn(train, r.numeric, r.categorical), encoding, scale)
    want = [r[0].toArray() for r in PipelineModel(prep).transform(matrix).orderBy("date_id", "rice_id").select("features").collect()]
    (packed,) = grid.Grid(small, r, TINY).packed.first()
    m = grid.Matrix(bytes(packed), r.numeric, r.categorical, "target_t_plus_1")
    assert len(m.y) == len(want) and sorted(m.y) == sorted(x[0] for x in matrix.select("target_t_plus_1").collect())
    (got,) = grid.inputs(m, m.upto(cut), (np.arange(len(m.y)),), encoding, scale)
    assert got == pytest.approx(np.array(want), rel=1e-9, abs=1e-9)


def test_folds_of_one_class_give_no_rows(spark, small):
    flat = small.withColumn("direction_t_plus_1", F.when(F.col("direction_t_plus_1").isNotNull(), F.lit(1)))
    made = grid.Grid(flat, roles.infer_roles(flat), TINY)
    cell = ("classification", 1, "random_forest_cls", "onehot", False, (1, dt.date(2023, 3, 1), dt.date(2023, 4, 1), dt.date(2023, 9, 1)))
    assert made.predictions([cell]).count() == 0


@pytest.mark.parametrize("reg, cls", [("random_forest", "random_forest_cls"), ("extra_trees", "extra_trees_cls"), ("gradient_boosting", "gradient_boosting_cls"), ("elastic_net", "logistic_regression")])
def test_saved_models_say_what_the_tasks_say(spark, small, reg, cls, monkeypatch):
    monkeypatch.setattr(grid, "SHARE", 5)  # several tasks a forest
    monkeypatch.setattr(grid, "TREES", 2)
    folder = fresh_dir(spark, "models")
    scores, chosen = grid.train_best_models(small, folder, [1], TINY, {"regression": [reg], "classification": [cls]}, max_splits=2)
    assert chosen.first()["best_regression_model"] == reg and scores.where(F.col("model_name") == reg).count() == 2
    assert spark.read.option("header", True).csv(f"{folder}/benchmark_scores").count() == scores.count()
    got = sorted((r.rice_id, r.predicted_price, r.predicted_direction) for r in models.predict_latest(small, folder, [1]).collect())
    # the same families in a task, trained on all labelled rows and asked about the latest ones, which get a label and a month of their own
    asked = small.withColumns({
        "target_t_plus_1": F.when(F.col("row_is_latest"), -1.0).otherwise(F.col("target_t_plus_1")),
        "direction_t_plus_1": F.when(F.col("row_is_latest"), (F.col("rice_id") == "r0").cast("int")).otherwise(F.col("direction_t_plus_1")),
        "date_id": F.when(F.col("row_is_latest"), F.lit(dt.date(2040, 1, 1))).otherwise(F.col("date_id")),
    })
    known = models.recipes("regression", TINY)[reg], models.recipes("classification", TINY)[cls]
    bounds = (1, dt.date(2039, 1, 1), dt.date(2040, 1, 1), dt.date(2040, 1, 1))
    cells = [(t, 1, n, c.encoding, c.scale, bounds) for t, n, c in zip(roles.TASKS, (reg, cls), known)]
    said = grid.Grid(asked, roles.infer_roles(small), TINY).predictions(cells).collect()
    assert sorted(x.guess for x in said if x.task == "regression") == pytest.approx(sorted(p for _, p, _ in got), abs=0.011)
    assert sorted(x.guess for x in said if x.task == "classification") == sorted(d for _, _, d in got)


def test_large_panels_are_fitted_by_spark(spark, small, monkeypatch):
    asked = []
    monkeypatch.setattr(grid, "TASK_CELLS", 100)
    monkeypatch.setattr(models, "train_best_models", lambda *a, **k: asked.append((a[2:], k)))
    grid.train_best_models(small, "unused")
    assert asked == [((fixed.HORIZONS, models.ModelSettings(), None), {"min_train": 12, "valid": 1, "max_splits": 6, "embargo": 0})]


def test_scores_are_those_of_single_horizons(spark, small):
    few = {"regression": ["elastic_net"], "classification": ["logistic_regression"]}
    want = models.evaluate_horizon(small, 1, max_splits=2, settings=TINY, models=few).collect()
    got = grid.evaluate(small, grid.Grid(small, roles.infer_roles(small), TINY), [1], few, (12, 1, 2, 0))
    assert len(got) == len(want) > 0
    for a, b in zip(sorted(got, key=lambda x: x[4:8]), sorted(map(tuple, want), key=lambda x: x[4:8])):
        assert a[4:8] == b[4:8]
        assert [x for x in (*a[:4], a[8]) if x is not None] == pytest.approx([x for x in (*b[:4], b[8]) if x is not None], rel=1e-5)


@pytest.mark.parametrize("classes", [False, True])
def test_extremely_random_trees_equal_those_of_jobs(spark, classes):
    x, y = rows_of(120)
    y = (y > 0).astype(float) if classes else y
    data = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(3)
    jobs = extra_trees.grow(data, 4, 3, 2, 30, 42)
    for number, tree in enumerate(lt.extremely_random_trees(x, y, range(3), 2, 30, 42)):
        own = [i for _, i in sorted((jobs.number[i], i) for i, t in enumerate(jobs.tree) if t == number)]
        assert tree.feature.tolist() == [jobs.feature[i] for i in own]
        assert tree.cut == pytest.approx([jobs.cut[i] for i in own])
        assert tree.stats == pytest.approx(np.array([jobs.stats[i] for i in own]))


@pytest.mark.parametrize("n", [25, 400])
def test_boosted_trees_equal_those_of_spark(spark, n):
    x, y = rows_of(n)
    for classes, kind in ((False, GBTRegressor), (True, GBTClassifier)):
        t = (y > 0).astype(float) if classes else y
        data = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, t)], ["features", "label"]).coalesce(1)
        model = kind(maxIter=12, stepSize=0.2, maxDepth=3).fit(data)
        said = sum((0.2 if i else 1.0) * tree.means()[tree.leaves(x)] for i, tree in enumerate(lt.boosted_trees(x, t, 12, 0.2, 3, classes)))
        want = [r[0] for r in model.transform(data).select("prediction").collect()]
        assert ((said > 0).astype(float) if classes else said) == pytest.approx(want)


@pytest.mark.parametrize("n", [30, 700])
def test_a_tree_equals_that_of_spark(spark, n):
    # large nodes add up parts, small ones sort their rows
    x, y = rows_of(n, 6)
    data = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]).coalesce(1)
    model = DecisionTreeRegressor(maxDepth=12, minInstancesPerNode=2).fit(data)
    tree, at = lt.grow_binned(lt.Binned(x), y, 2, 12)
    assert tree.means()[at] == pytest.approx([r[0] for r in model.transform(data).select("prediction").collect()])
    assert (tree.leaves(x) == at).all() and tree.stats[0] == pytest.approx([n, y.sum(), (y * y).sum()])


def test_weights_count_rows_that_often(monkeypatch):
    monkeypatch.setattr(lt, "CELLS", 40)  # few rows at once
    x, y = rows_of(90, 5)
    w = np.random.default_rng(1).integers(0, 4, 90)
    tree, _ = lt.grow_binned(lt.Binned(x), y, 2, 30, w)
    same, _ = lt.grow_binned(lt.Binned(x), y, 2, 30, w)
    assert (tree.feature == same.feature).all()
    inner = tree.feature >= 0
    at, rows = tree.leaves(x), np.repeat(np.arange(90), w)
    for leaf in np.flatnonzero(~inner):
        here = rows[at[rows] == leaf]
        assert tree.stats[leaf] == pytest.approx([len(here), y[here].sum(), (y[here] ** 2).sum()]) and len(here) >= 2
    left = tree.left[inner]
    assert tree.stats[left] + tree.stats[left + 1] == pytest.approx(tree.stats[inner])


def test_forests_learn_and_can_be_repeated():
    x, y = rows_of(200, 5)
    for classes in (False, True):
        t = (y > 0).astype(float) if classes else y
        runs = [np.mean([f.means()[f.leaves(x)] for f in lt.random_forest(x, t, numbers, 2, 30, 42, classes)], axis=0) for numbers in (range(20), range(20))]
        assert (runs[0] == runs[1]).all()
        assert ((runs[0] - t) ** 2).mean() < 0.3 * t.var()
    assert [len(f.feature) for f in lt.random_forest(np.zeros((9, 0)), y[:9], range(2), 2, 30, 42, True)] == [1, 1]


def test_logistic_reaches_the_optimum():
    x, y = rows_of(150)
    y = (y > 0).astype(float)
    w, b = grid.logistic(x, y, 1 / 150, 5_000)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert x.T @ (p - y) / 150 + w / 150 == pytest.approx(np.zeros(4), abs=1e-8) and (p - y).mean() == pytest.approx(0, abs=1e-8)
