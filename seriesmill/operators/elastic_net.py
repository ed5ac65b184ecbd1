"""Elastic net with a penalty on the mean squared error, solved on Gram matrices.

The weights minimise sum((y - b - x w)^2) / (2 n) + alpha l1 |w| + alpha (1 - l1) / 2 |w|^2, on the labels as they
are. Rows are read once: tasks add up their Gram matrices, and what is left, of the size columns x columns, holds all that
descent needs. For expanding folds the matrices are kept per segment of months and a fold is a sum of them; medians,
modes and scaling of a fold are applied to its matrix and not to its rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, functions as F

from seriesmill.operators import fold_stats, roles
from seriesmill.operators.features import text_numbers
from seriesmill.session import settle

#: The steps inside tasks travel with the job, so that only the driver needs this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns up to which a Gram matrix is small (134 MB); wider data is fitted by iterations over the rows.
GRAM_COLUMNS = 4_096
#: Matrix rows that travel together.
STRIP = 32
#: Sweeps between two attempts to solve for the columns in use at once, and the largest gradient left at the optimum.
SWEEPS, GAP = 25, 1e-9


def optimality_gap(gram: np.ndarray, corr: np.ndarray, w: np.ndarray, l1: float, l2: float) -> float:
    """Largest violation of the optimality conditions of the weights."""
    slope = corr - gram @ w - l2 * w
    return float(np.where(w != 0, np.abs(slope - l1 * np.sign(w)), np.maximum(np.abs(slope) - l1, 0)).max(initial=0.0))


def descend(gram: np.ndarray, corr: np.ndarray, l1: float, l2: float, steps: int) -> np.ndarray:
    """Weights by cyclic coordinate descent on a centred Gram matrix (a mean over rows); at most ``steps`` sweeps.

    Every few sweeps the columns in use are solved for directly with their signs held. The solution is taken as far as no weight
    changes its sign; descent goes on from there until the optimality conditions hold.
    """
    w, held = np.zeros(len(corr)), gram.diagonal() + l2
    goal = GAP * max(1.0, float(np.abs(corr).max(initial=0.0)))
    use = np.flatnonzero(held > 0).tolist()
    for sweep in range(steps):
        at = gram @ w
        for j in use:
            rho = corr[j] - at[j] + gram[j, j] * w[j]
            new = math.copysign(max(abs(rho) - l1, 0.0), rho) / held[j]
            if new != w[j]:
                at += gram[:, j] * (new - w[j])
                w[j] = new
        if sweep % SWEEPS == SWEEPS - 1:
            on = np.flatnonzero(w)
            try:
                direct = np.linalg.solve(gram[np.ix_(on, on)] + l2 * np.eye(len(on)), corr[on] - l1 * np.sign(w[on]))
            except np.linalg.LinAlgError:
                continue
            step = direct - w[on]
            flips = np.sign(direct) != np.sign(w[on])
            share = float(np.min(-w[on][flips] / step[flips], initial=1.0))
            w[on] += share * step
            w[np.abs(w) < 1e-14 * np.abs(w).max(initial=0.0)] = 0.0
        if optimality_gap(gram, corr, w, l1, l2) <= goal:
            break
    return w


def _strips(key: tuple, total: np.ndarray, salt: int) -> Iterator[dict]:
    for s in range(0, len(total), STRIP):
        yield {"horizon": key[0], "segment": key[1], "strip": s // STRIP, "salt": salt, "total": total[s : s + STRIP].tobytes()}


STRIPS = pa.schema([("horizon", pa.int32()), ("segment", pa.int32()), ("strip", pa.int32()), ("salt", pa.int32()), ("total", pa.binary())])


def _added(strips: DataFrame, parts: int) -> DataFrame:
    """Strips added up in two steps, so that no task meets the matrices of all others."""

    def add(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b) for b in group.column("total").to_pylist()], axis=0)
        return group.slice(0, 1).set_column(4, "total", pa.array([total.tobytes()], pa.binary()))

    names = ["horizon", "segment", "strip", "salt", "total"]
    ddl = "horizon int, segment int, strip int, salt int, total binary"
    some = strips.withColumn("salt", F.col("salt") % max(1, math.isqrt(parts))).groupBy("horizon", "segment", "strip", "salt").applyInArrow(add, ddl)
    return some.select(*names).groupBy("horizon", "segment", "strip").applyInArrow(add, ddl)


def _matrix(strips: list[bytes], width: int) -> np.ndarray:
    return np.concatenate([np.frombuffer(b).reshape(-1, width) for b in strips])


def _task_number() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def solve(total: np.ndarray, alpha: float, l1_share: float, steps: int, scale: np.ndarray | None = None) -> tuple[np.ndarray, float, float]:
    """(weights, intercept, optimality gap) from the matrix of sums over (columns, 1, label).

    Columns named by ``scale`` are divided by their deviation before they are penalised; the weights are for the columns as given.
    """
    n = total[-2, -2]
    mean = total[-2, :-2] / n
    y = total[-2, -1] / n
    gram = total[:-2, :-2] / n - np.outer(mean, mean)
    corr = total[:-2, -1] / n - mean * y
    dev = np.ones(len(mean))
    if scale is not None:
        spread = gram.diagonal()[scale]
        level = total.diagonal()[:-2][scale] / n
        dev[scale] = np.where(spread > 1e-14 * level, np.sqrt(np.maximum(spread, 0)), 1.0)
    gram, corr = gram / np.outer(dev, dev), corr / dev
    l1, l2 = alpha * l1_share, alpha * (1 - l1_share)
    w = descend(gram, corr, l1, l2, steps)
    return w / dev, float(y - mean @ (w / dev)), optimality_gap(gram, corr, w, l1, l2)


class GramElasticNet:
    """Estimator on a vector column; the fitted model is a ``LinearRegressionModel`` and is saved like one."""

    def __init__(self, alpha: float, l1_share: float, steps: int) -> None:
        self.alpha, self.l1_share, self.steps = alpha, l1_share, steps
        self.label, self.features = "label", "features"

    def setLabelCol(self, name: str) -> GramElasticNet:
        self.label = name
        return self

    def setFeaturesCol(self, name: str) -> GramElasticNet:
        self.features = name
        return self

    def fit(self, data: DataFrame) -> LinearRegressionModel:
        rows = data.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y")).where("y IS NOT NULL")
        first = rows.select(F.size("x")).first()
        if first is None:
            raise ValueError("no rows to fit")
        width = first[0] + 2
        if width > GRAM_COLUMNS:
            net = LinearRegression(maxIter=self.steps, regParam=self.alpha, elasticNetParam=self.l1_share, standardization=False)
            return net.setFeaturesCol(self.features).setLabelCol(self.label).fit(data)

        def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width, width))
            for part in parts:
                x = np.ones((part.num_rows, width))
                x[:, :-2] = part.column("x").flatten().to_numpy().reshape(part.num_rows, -1)
                x[:, -1] = part.column("y").to_numpy()
                total += x.T @ x
            yield pa.RecordBatch.from_pylist(list(_strips((0, 0), total, _task_number())), STRIPS)

        strips = rows.mapInArrow(add, "horizon int, segment int, strip int, salt int, total binary")
        found = _added(strips, rows.rdd.getNumPartitions()).orderBy("strip").collect()
        w, b, _ = solve(_matrix([r["total"] for r in found], width), self.alpha, self.l1_share, self.steps)
        sc = data.sparkSession.sparkContext
        made = sc._jvm.org.apache.spark.ml.regression.LinearRegressionModel(f"elastic_net_{id(self)}", _py2java(sc, Vectors.dense(w)), float(b))
        return LinearRegressionModel(made).setFeaturesCol(self.features)


@dataclass(frozen=True)
class FoldModel:
    """Weights of one horizon and fold for numbers filled with the fold's medians and texts filled with its modes."""

    horizon: int
    fold: int
    train_rows: int
    intercept: float
    weights: np.ndarray
    gap: float


class FoldInputs:
    """Columns of the fold matrices: numbers less a fixed shift, marks of missing numbers, indicators and marks of missing texts."""

    def __init__(self, numeric: Sequence[str], shifts: Sequence[float], texts: dict[str, int]) -> None:
        self.numeric, self.shifts, self.texts = list(numeric), np.array(shifts, float), dict(texts)
        self.offsets = np.concatenate(([0], np.cumsum(list(texts.values())))).astype(int)
        self.width = 2 * len(self.numeric) + int(self.offsets[-1]) + len(texts) + 2

    def rows(self, part: pa.RecordBatch) -> np.ndarray:
        p = len(self.numeric)
        x = np.zeros((part.num_rows, self.width))
        for j, c in enumerate(self.numeric):
            v = part.column(c).to_numpy(zero_copy_only=False).astype(float)
            fine = np.isfinite(v)
            x[:, j] = np.where(fine, v - self.shifts[j], 0.0)
            x[:, p + j] = ~fine
        for k, c in enumerate(self.texts):
            code = part.column(f"{c}__code").to_numpy(zero_copy_only=False).astype(float)
            there = np.flatnonzero(np.isfinite(code))
            x[there, 2 * p + self.offsets[k] + code[there].astype(int)] = 1.0
            x[:, 2 * p + self.offsets[-1] + k] = ~np.isfinite(code)
        x[:, -2] = 1.0
        x[:, -1] = part.column("y").to_numpy(zero_copy_only=False)
        return x

    def filled(self, medians: dict[str, float], modes: dict[str, int]) -> np.ndarray:
        """Matrix that turns these columns into numbers and indicators without gaps, 1 and label kept."""
        p, m = len(self.numeric), int(self.offsets[-1])
        turn = np.zeros((self.width, p + m + 2))
        turn[np.arange(p), np.arange(p)] = 1.0
        for j, c in enumerate(self.numeric):
            if c in medians:
                turn[p + j, j] = medians[c] - self.shifts[j]
            else:
                turn[j, j] = 0.0  # no value known in this fold: the column is left out
        turn[2 * p + np.arange(m), p + np.arange(m)] = 1.0
        for k, c in enumerate(self.texts):
            if c in modes:
                turn[2 * p + m + k, p + self.offsets[k] + modes[c]] = 1.0
        turn[-2, -2] = turn[-1, -1] = 1.0
        return turn


class FoldElasticNet:
    """Elastic nets of all folds and horizons of a panel from one read of its rows (regression)."""

    def __init__(self, panel: DataFrame, plan: fold_stats.FoldPlan, alpha: float = 0.01, l1_share: float = 0.3, steps: int = 20_000) -> None:
        self.plan, r = plan, roles.infer_roles(panel)
        rows = settle(fold_stats.fold_rows(panel, plan, r), "fold-rows")
        sizes, coded = {}, rows
        for c in r.categorical:
            numbers = text_numbers(rows, c).withColumnsRenamed({"__text": "__t", "__code": f"{c}__code"})
            coded = coded.join(numbers, F.col(f"`{c}`").cast("string") == F.col("__t"), "left").drop("__t")
            sizes[c] = numbers.count()
        if 2 * len(r.numeric) + sum(sizes.values()) + len(sizes) + 2 > GRAM_COLUMNS:
            raise ValueError("too many columns for Gram matrices; fit the folds one by one")
        self.rows = settle(coded.withColumns({c: F.col(f"`{c}`").cast("double") for c in r.numeric}), "fold-coded") if r.categorical else rows
        self.medians = fold_stats.fold_medians(self.rows, r.numeric, plan.keys())
        means = self.rows.agg(*[F.avg(F.when(F.abs(f"`{c}`") < float("inf"), F.col(f"`{c}`"))) for c in r.numeric]).first() if r.numeric else ()
        self.inputs = FoldInputs(r.numeric, [m or 0.0 for m in means], sizes)
        self.modes = self._modes(r.categorical)
        self.models = {(m.horizon, m.fold): m for m in self._fit(alpha, l1_share, steps)}

    def _modes(self, categorical: Sequence[str]) -> dict[tuple[int, int], dict[str, int]]:
        """Number of the most frequent text per fold: one value per fold and column."""
        out: dict[tuple[int, int], dict[str, int]] = {k: {} for k in self.plan.keys()}
        if categorical:
            coded = self.rows.withColumns({c: F.format_string("%015.0f", F.col(f"{c}__code")) for c in categorical})
            for x in fold_stats.fold_modes(coded.withColumns({c: F.when(F.col(f"{c}__code").isNotNull(), F.col(c)) for c in categorical}), categorical, self.plan).collect():
                out[x["horizon"], x["fold"]][x["c"]] = int(x["v"])
        return out

    def _columns(self) -> list[str]:
        return [*self.inputs.numeric, *[f"{c}__code" for c in self.inputs.texts], "y"]

    def _fit(self, alpha: float, l1_share: float, steps: int) -> list[FoldModel]:
        inputs, medians, modes = self.inputs, self.medians, self.modes
        last = {h: len(b) for h, b in self.plan.bounds.items()}

        def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[tuple, np.ndarray] = {}
            for part in parts:
                x = inputs.rows(part)
                h, s = part.column("horizon").to_numpy(), part.column("segment").to_numpy()
                for key in set(zip(h.tolist(), s.tolist())):
                    some = x[(h == key[0]) & (s == key[1])]
                    totals[key] = totals.get(key, 0.0) + some.T @ some
            for key, total in totals.items():
                yield pa.RecordBatch.from_pylist(list(_strips(key, total, _task_number())), STRIPS)

        train = self.rows.where(F.col("segment") < F.element_at(F.create_map(*[F.lit(x) for kv in last.items() for x in kv]), F.col("horizon")))
        strips = train.select("horizon", "segment", *self._columns()).mapInArrow(add, "horizon int, segment int, strip int, salt int, total binary")
        sums = _added(strips, train.rdd.getNumPartitions())
        top = F.element_at(F.create_map(*[F.lit(x) for kv in last.items() for x in kv]), F.col("horizon"))
        each = sums.withColumn("fold", F.explode(F.sequence(F.col("segment") + 1, top))).select("horizon", "fold", "segment", "strip", "total")

        def fit(key: tuple, group: pa.Table) -> pa.Table:
            h, f = (k.as_py() for k in key)
            by: dict[int, dict[int, bytes]] = {}
            for x in group.select(["segment", "strip", "total"]).to_pylist():
                by.setdefault(x["segment"], {})[x["strip"]] = x["total"]
            total = sum(_matrix([strips[i] for i in sorted(strips)], inputs.width) for strips in by.values())
            turn = inputs.filled(medians[h, f], modes[h, f])
            w, b, gap = solve(turn.T @ total @ turn, alpha, l1_share, steps, scale=np.arange(len(inputs.numeric)))
            return pa.table(
                {"horizon": pa.array([h], pa.int32()), "fold": pa.array([f], pa.int32()), "train_rows": [int(round(total[-2, -2]))], "intercept": [b], "weights": [w.tolist()], "gap": [gap]}
            )

        found = each.groupBy("horizon", "fold").applyInArrow(fit, "horizon int, fold int, train_rows long, intercept double, weights array<double>, gap double")
        return [FoldModel(x.horizon, x.fold, x.train_rows, x.intercept, np.array(x.weights), x.gap) for x in found.collect()]

    def predictions(self) -> DataFrame:
        """(horizon, fold, y, prediction) of the validation rows of every fold."""
        inputs, models, medians, modes = self.inputs, self.models, self.medians, self.modes

        def predict(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            turned = {k: inputs.filled(medians[k], modes[k])[:, :-2] @ m.weights for k, m in models.items()}
            for part in parts:
                x = inputs.rows(part)
                h, f = part.column("horizon").to_numpy(), part.column("fold").to_numpy()
                guess = np.full(len(x), np.nan)
                for key, w in turned.items():
                    here = (h == key[0]) & (f == key[1])
                    guess[here] = x[here] @ w + models[key].intercept
                yield pa.RecordBatch.from_arrays([part.column("horizon"), part.column("fold"), part.column("y"), pa.array(guess)], ["horizon", "fold", "y", "prediction"])

        held = self.rows.where("size(held) > 0").withColumn("fold", F.explode("held")).select("horizon", "fold", *self._columns())
        return held.mapInArrow(predict, "horizon int, fold int, y double, prediction double")
