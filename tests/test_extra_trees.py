"""Extremely randomised trees: cuts by rule, a plain growth beside the Spark one, models that are saved."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel

from seriesmill.operators import extra_trees as et


def rows_of(n, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 3)
    x[:, 3] = 1.5  # a constant feature is never cut
    x[::5, 1] = 0.0
    return x, np.round(2 * x[:, 0] - (x[:, 1] > 0) * 3 + rng.normal(scale=0.1, size=n), 3)


def plain_tree(x, y, tree, min_leaf, depth, seed):
    """(split or None, n, sum) per node in order of their numbers."""
    nodes, front, number = {}, [(0, np.arange(len(y)))], 1
    for level in range(depth + 1):
        following = []
        for node, rows in front:
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            found = []
            for f in range(x.shape[1]):
                cut = low[f] + et.share(seed, tree, node, f) * (high[f] - low[f])
                left = x[rows, f] <= cut
                if min(left.sum(), (~left).sum()) < min_leaf:
                    continue
                gain = sum(y[rows][s].sum() ** 2 / s.sum() for s in (left, ~left)) - y[rows].sum() ** 2 / len(rows)
                found.append((gain, f, cut))
            tie = et.TIES * (y[rows] ** 2).sum()
            most = max(found, default=(0,))[0]
            best = next((b for b in found if b[0] >= most - tie), None) if most > tie else None
            nodes[node] = [None, len(rows), y[rows].sum()]
            if best and level < depth:
                nodes[node][0] = best[1:]
                left = x[rows, best[1]] <= best[2]
                following += [(number, rows[left]), (number + 1, rows[~left])]
                number += 2
        front = following
    return [nodes[i] for i in range(number)]


@pytest.mark.parametrize("depth", [0, 2, 30])
def test_trees_equal_a_plain_growth(spark, depth, monkeypatch):
    monkeypatch.setattr(et, "CELLS", 60)  # several groups of nodes a level
    monkeypatch.setattr(et, "ROWS", 50)
    x, y = rows_of(150)
    data = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(3)
    made = et.grow(data, 4, 3, 2, depth, 42)
    for tree in range(3):
        want = plain_tree(x, y, tree, 2, depth, 42)
        own = sorted((made.number[i], i) for i, t in enumerate(made.tree) if t == tree)
        assert len(own) == len(want)
        for (_, i), (split, n, s) in zip(own, want):
            assert made.stats[i][:2] == (n, pytest.approx(s, abs=1e-9))
            assert (made.feature[i], made.cut[i]) == (split[0], pytest.approx(split[1])) if split else made.feature[i] == -1


def test_model_is_a_forest_of_spark(spark, tmp_path):
    x, y = rows_of(200)
    data = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)] + [(Vectors.dense(x[0]), None)], ["features", "price"])
    model = et.ExtraTrees(5, depth=4).setLabelCol("price").fit(data)
    model.save(f"{tmp_path}/m")
    again = RandomForestRegressionModel.load(f"{tmp_path}/m").transform(data).collect()
    forest = [plain_tree(x, y, t, 2, 4, 42) for t in range(5)]
    first = et.ExtraTrees(5, depth=4).setLabelCol("price").fit(data).transform(data).collect()
    assert [r.prediction for r in again] == [r.prediction for r in first]  # cuts are reproducible
    mean = np.mean([forest[t][0][2] / 200 for t in range(5)])
    assert np.mean([r.prediction for r in again[:200]]) == pytest.approx(mean, abs=0.5)
    error = np.mean([(r.prediction - r.price) ** 2 for r in again[:200]])
    assert error < 0.3 * y.var()


def test_classes(spark):
    x, y = rows_of(200)
    data = spark.createDataFrame([(Vectors.dense(a), float(b > 0)) for a, b in zip(x, y)], ["features", "up"])
    model = et.ExtraTrees(9, classes=True).setLabelCol("up").fit(data)
    assert isinstance(model, RandomForestClassificationModel)
    scored = model.transform(data).collect()
    assert np.mean([r.prediction == r.up for r in scored]) > 0.95
    assert all(r.probability.toArray().sum() == pytest.approx(1) for r in scored)
