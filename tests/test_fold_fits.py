"""Statistics and elastic nets of all folds at once, against each fold on its own."""

import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from seriesmill.operators import elastic_net, fold_stats, folds, roles

HORIZONS = (1, 2)


def rows():
    rng = np.random.default_rng(6)
    out = []
    for m in range(20):
        for k in range(6):
            x = [float(v) if rng.random() > 0.15 else None for v in rng.normal(size=3) * (1, 50, 1e-3) + (0, 2000, 5)]
            text = None if rng.random() < 0.2 else "abcd"[int(rng.integers(0, 4))] if m < 17 else "new"
            y = [3.0 * (x[0] or 0) + 0.1 * (x[1] or 2000) + ("abcd".find(text or "a") + 1) + float(rng.normal()) if m + h < 20 else None for h in HORIZONS]
            out.append((dt.date(2020 + m // 12, m % 12 + 1, 1), k, "r", *x, 7.0, None, text, *y))
    return out


SCHEMA = (
    "date_id date, region_id int, rice_id string, a double, b double, c double, same double, nothing double, t string, "
    "target_t_plus_1 double, target_t_plus_2 double"
)


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def plan(panel):
    return fold_stats.plan_folds(panel, "regression", HORIZONS, 12, 1, 6, 0)


@pytest.fixture(scope="module")
def long(panel, plan):
    return fold_stats.fold_rows(panel, plan, roles.infer_roles(panel)).persist()


def training(panel, horizon, last):
    label = f"target_t_plus_{horizon}"
    return panel.where(F.col(label).isNotNull() & (F.col("date_id") <= F.lit(last))).toPandas()


def test_plan_is_that_of_single_horizons(panel, plan):
    for h in HORIZONS:
        labelled = panel.where(F.col(f"target_t_plus_{h}").isNotNull())
        assert plan.bounds[h] == folds.fold_bounds(folds.expanding_folds(labelled))


def test_statistics_of_every_fold(panel, plan, long, monkeypatch):
    monkeypatch.setattr(fold_stats, "PARTS", 8)
    names = ["a", "b", "c", "same", "nothing"]
    medians = fold_stats.fold_medians(long, names, plan.keys())
    moments = fold_stats.fold_moments(long, medians)
    modes = {(r.horizon, r.fold): (r.v, r.n) for r in fold_stats.fold_modes(long, ["t"], plan).collect()}
    for h, bounds in plan.bounds.items():
        for fold, last, *_ in bounds:
            train = training(panel, h, last)
            assert set(medians[h, fold]) == {"a", "b", "c", "same"}
            for c in medians[h, fold]:
                known = [v for v in train[c] if not np.isnan(v)]
                assert medians[h, fold][c] == statistics.median(known)
                filled = train[c].fillna(medians[h, fold][c])
                assert moments[h, fold][c] == pytest.approx((filled.mean(), filled.std(ddof=0) or 1.0), rel=1e-9)
            counts = train["t"].dropna().value_counts()
            best = min(counts.index, key=lambda v: (-counts[v], v))
            assert modes[h, fold] == (best, counts[best])


def test_passes_do_not_grow_with_folds(panel, plan, long, monkeypatch):
    passes = []
    grouped = fold_stats._grouped
    monkeypatch.setattr(fold_stats, "_grouped", lambda *a: passes.append(1) or grouped(*a))
    fold_stats.fold_medians(long, ["a"], plan.keys())
    many = len(passes)
    fold_stats.fold_medians(long, ["a"], plan.keys()[:1])
    assert many <= len(passes) - many + 3  # other folds may need a part or two more, never a pass each


def test_changing_rows_are_noticed(spark, monkeypatch):
    """A pass that finds no part for a rank ends with an error, not with another pass."""
    grouped = fold_stats._grouped
    monkeypatch.setattr(fold_stats, "_grouped", lambda rows, brackets: grouped(rows, brackets) if brackets[0][1] is None else {})
    rows = spark.range(50).selectExpr("1 AS horizon", "0 AS segment", "id AS x")
    with pytest.raises(RuntimeError):
        fold_stats.fold_medians(rows, ["x"], [(1, 1)])


def plain_net(x, y, alpha, l1_share, sweeps=20_000):
    """Descent on the rows, one weight at a time."""
    n, w = len(y), np.zeros(x.shape[1])
    xc, yc = x - x.mean(axis=0), y - y.mean()
    rest = yc.copy()
    for _ in range(sweeps):
        before = w.copy()
        for j in range(len(w)):
            held = xc[:, j] @ xc[:, j] / n + alpha * (1 - l1_share)
            rho = xc[:, j] @ rest / n + w[j] * (xc[:, j] @ xc[:, j] / n)
            new = np.sign(rho) * max(abs(rho) - alpha * l1_share, 0) / held
            rest -= xc[:, j] * (new - w[j])
            w[j] = new
        if np.abs(w - before).max() < 1e-13:
            break
    return w, y.mean() - x.mean(axis=0) @ w


@pytest.mark.parametrize("alpha,l1_share", [(0.01, 0.3), (0.5, 0.9)])
def test_all_folds_equal_plain_descent(panel, plan, alpha, l1_share):
    nets = elastic_net.FoldElasticNet(panel, plan, alpha, l1_share)
    guesses = {}
    for r in nets.predictions().collect():
        guesses.setdefault((r.horizon, r.fold), []).append((round(r.y, 9), r.prediction))
    for h, bounds in plan.bounds.items():
        for fold, last, first, end in bounds:
            train = training(panel, h, last)
            held = panel.where(F.col(f"target_t_plus_{h}").isNotNull() & F.col("date_id").between(F.lit(first), F.lit(end))).toPandas()
            names = ["a", "b", "c", "same"]
            median = train[names].median()
            counts = train["t"].dropna().value_counts()
            mode = min(counts.index, key=lambda v: (-counts[v], v))
            known = sorted(counts.index)
            mean, dev = train[names].fillna(median).mean(), train[names].fillna(median).std(ddof=0).replace(0, 1)

            def ready(df):
                numbers = ((df[names].fillna(median) - mean) / dev).to_numpy()
                text = df["t"].where(df["t"].notna(), mode)
                return np.concatenate([numbers, np.array([[float(t == k) for k in known] for t in text])], axis=1)

            w, b = plain_net(ready(train), train[f"target_t_plus_{h}"].to_numpy(), alpha, l1_share)
            want = sorted(zip(held[f"target_t_plus_{h}"].round(9), ready(held) @ w + b))
            assert nets.models[h, fold].train_rows == len(train) and nets.models[h, fold].gap < 1e-6
            assert np.allclose(sorted(guesses[h, fold]), want, atol=1e-6)


def test_estimator_equals_plain_descent(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12))
    x[:, 5] = x[:, 4] + 1e-4 * rng.normal(size=300)  # nearly equal columns
    y = x[:, 0] * 2 - x[:, 4] + 10 + rng.normal(size=300) * 0.1
    data = spark.createDataFrame(
        [(Vectors.dense(v), float(t)) for v, t in zip(x, y)], ["features", "y"]
    ).repartition(5)
    model = elastic_net.GramElasticNet(0.05, 0.3, 20_000).setLabelCol("y").setFeaturesCol("features").fit(data)
    w, b = plain_net(x, y, 0.05, 0.3)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-6) and model.intercept == pytest.approx(b, abs=1e-6)
    with pytest.raises(ValueError):
        elastic_net.GramElasticNet(0.05, 0.3, 10).setLabelCol("y").fit(data.limit(0))
