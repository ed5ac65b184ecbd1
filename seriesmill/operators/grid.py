"""All families, folds, horizons and tasks of a panel whose rows one task holds: a grid of cells, each fitted inside a task.

A fit of Spark is many small jobs, and the published grid has 144 fits and six refits. Where rows x inputs stay below ``TASK_CELLS`` the
panel travels as one row to a task per cell, which prepares the features as ``features`` does, fits a family
and scores the validation rows of a fold; the chosen families are fitted on all labelled rows in the same way, and their trees
go from the tasks to the shared folder as models of Spark. Larger panels are fitted by Spark, one fit after the other.
"""

from __future__ import annotations

import itertools
import json
import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from seriesmill import fixed
from seriesmill.operators import features, fold_stats, metrics, models, roles
from seriesmill.operators.elastic_net import GRAM_COLUMNS, solve
from seriesmill.operators.local_trees import Tree, boosted_trees, extremely_random_trees, random_forest
from seriesmill.session import fresh_dir, settle, settle_compact

#: The steps inside tasks travel with the job, so that only the driver needs this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Most numbers (rows x inputs) of a matrix that is fitted inside one task.
TASK_CELLS = 4_000_000
#: Trees of a forest that a task grows, and trees that travel together.
SHARE, TREES = 50, 10
#: Small jobs of the driver that run at once: fold bounds, and models that are put together.
AT_ONCE = 3
#: Families from the slowest, so that the last tasks to start are short.
SLOWEST = ("random_forest", "extra_trees", "extra_trees_cls", "random_forest_cls")
NODES = (
    "cell int, tree int, id int, prediction double, impurity double, stats array<double>, n long, gain double, "
    "left int, right int, feature int, cut array<double>"
)


def fits_a_task(panel: DataFrame, r: roles.Roles) -> bool:
    """Whether every matrix of the panel has at most ``TASK_CELLS`` numbers, and columns few enough for a Gram matrix."""
    texts = features.text_counts(panel, r.categorical).count() if r.categorical else 0
    inputs = len(r.numeric) + texts
    return panel.count() * max(inputs, 1) <= TASK_CELLS and inputs + 2 <= GRAM_COLUMNS


# --- inside tasks ----------------------------------------------------------------------


class Matrix:
    """The labelled rows of one task and horizon, in an order that does not depend on how they were written."""

    def __init__(self, packed: bytes, numeric: Sequence[str], categorical: Sequence[str], label: str) -> None:
        table = pa.ipc.open_stream(packed).read_all()
        table = table.filter(pc.is_finite(pc.fill_null(table.column(label), np.nan)))
        table = table.sort_by([(c, "ascending") for c in ("__month", "__keys", *numeric, *categorical, label)])
        self.month = table.column("__month").to_pandas().to_numpy("datetime64[D]")
        self.y = table.column(label).to_numpy(zero_copy_only=False).astype(float)
        self.numbers = {c: _numbers(table.column(c), c) for c in numeric}
        self.texts = {c: np.array(table.column(c).to_pylist(), object) for c in categorical}

    def upto(self, month) -> np.ndarray:
        return np.flatnonzero(self.month <= np.datetime64(month))

    def between(self, first, last) -> np.ndarray:
        return np.flatnonzero((self.month >= np.datetime64(first)) & (self.month <= np.datetime64(last)))


def _numbers(column: pa.ChunkedArray, name: str) -> np.ndarray:
    values = column.to_numpy(zero_copy_only=False).astype(float)
    if np.isnan(values[column.is_valid().to_numpy(zero_copy_only=False)]).any():
        raise ValueError(f"not a number in {name}")
    return values


def inputs(m: Matrix, train: np.ndarray, rows: Sequence[np.ndarray], encoding: str, scale: bool) -> list[np.ndarray]:
    """The inputs of each of ``rows`` as ``features.learn`` and ``features.preprocessing_stages`` make them of the training rows."""
    out: list[list[np.ndarray]] = [[] for _ in rows]
    for values in m.numbers.values():
        known = values[train]
        known = known[np.isfinite(known)]
        if not len(known):
            continue
        median = float(np.median(known))
        filled = np.where(np.isnan(values), median, values)
        if scale:
            seen = filled[train]
            dev = 1.0 if seen.min() == seen.max() else float(seen.std()) or 1.0
            filled = (filled - seen.mean()) / dev
        for part, at in zip(out, rows):
            part.append(filled[at][:, None])
    for values in m.texts.values():
        seen = [v for v in values[train] if v is not None]
        if not seen:
            continue
        counts = Counter(seen)
        names = sorted(counts)
        code = {v: i for i, v in enumerate(names)}
        mode = code[min(names, key=lambda v: (-counts[v], v))]
        codes = np.array([mode if v is None else code.get(v, -1) for v in values])
        for part, at in zip(out, rows):
            part.append((codes[at][:, None] == np.arange(len(names))).astype(float) if encoding == "onehot" else codes[at][:, None].astype(float))
    return [np.concatenate(part, axis=1) if part else np.zeros((len(at), 0)) for part, at in zip(out, rows)]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the mean logistic loss + penalty / 2 |w|^2, by Newton steps that never climb."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    ridge = np.full(x1.shape[1], penalty)
    ridge[-1] = 0.0
    w, sign = np.zeros(x1.shape[1]), 2 * y - 1
    w[-1] = np.log(max(y.mean(), 1e-12) / max(1 - y.mean(), 1e-12))

    def loss(v: np.ndarray) -> float:
        return float(np.logaddexp(0, -sign * (x1 @ v)).mean() + ridge @ (v * v) / 2)

    now = loss(w)
    for _ in range(steps):
        p = 0.5 * (1 + np.tanh(x1 @ w / 2))
        slope = x1.T @ (p - y) / len(y) + ridge * w
        if np.abs(slope).max() < 1e-10:
            break
        step = np.linalg.lstsq((x1.T * (p * (1 - p) / len(y))) @ x1 + np.diag(ridge), slope, rcond=None)[0]
        size = 1.0
        while (then := loss(w - size * step)) > now and size > 1e-10:
            size /= 2
        if then >= now:
            break
        w, now = w - size * step, then
    return w[:-1], float(w[-1])


def trees_of(name: str, s: dict) -> int:
    return s["boosts"] if name.startswith("gradient") else s["wide_trees"] if name.startswith("extra") else s["trees"]


def grown(name: str, s: dict, x: np.ndarray, y: np.ndarray, numbers: Sequence[int]) -> Iterator[Tree]:
    """The trees of a family with these numbers one by one; boosted trees follow each other and are grown all."""
    classes = name.endswith("_cls")
    if name.startswith("random_forest"):
        return random_forest(x, y, numbers, s["min_leaf"], s["depth"], s["seed"], classes)
    if name.startswith("extra_trees"):
        return extremely_random_trees(x, y, numbers, s["min_leaf"], s["depth"], s["seed"])
    if name.startswith("gradient_boosting"):
        return boosted_trees(x, y, s["boosts"], s["rate"], s["boost_depth"], classes)
    raise ValueError(f"unknown family {name}")


def predicted(name: str, s: dict, x: np.ndarray, y: np.ndarray, held: np.ndarray) -> np.ndarray:
    """What the family, fitted on x and y, says of the held rows; trees are dropped as soon as they have spoken."""
    if name == "elastic_net":
        all_ = np.concatenate([x, np.ones((len(x), 1)), y[:, None]], axis=1)
        w, b, _ = solve(all_.T @ all_, s["penalty"], s["l1_share"], s["net_steps"])
        return held @ w + b
    if name == "logistic_regression":
        w, b = logistic(x, y, 1.0 / max(len(y), 1), s["logit_steps"])
        return (held @ w + b > 0).astype(float)
    said, trees = np.zeros(len(held)), 0
    for tree in grown(name, s, x, y, range(trees_of(name, s))):
        weight = s["rate"] if trees and name.startswith("gradient") else 1.0
        said += weight * tree.means()[tree.leaves(held)]
        trees += 1
    if name == "gradient_boosting_cls":
        return (said > 0).astype(float)
    if name.endswith("_cls"):
        return (said / trees > 0.5).astype(float)
    return said if name == "gradient_boosting" else said / trees


def _node_rows(cell: int, trees: Sequence[tuple[int, Tree]], votes: bool) -> pa.RecordBatch:
    """Nodes in the layout of Spark's models; ``votes``: the stats are those of classes 0 and 1."""
    cols: dict[str, list] = {k: [] for k in ("cell", "tree", "id", "prediction", "impurity", "stats", "n", "gain", "left", "right", "feature", "cut")}
    for number, t in trees:
        n, s, q = t.stats.T
        mean = t.means()
        inner = t.feature >= 0
        cols["cell"] += [cell] * len(n)
        cols["tree"] += [number] * len(n)
        cols["id"] += range(len(n))
        cols["prediction"] += ((mean > 0.5).astype(float) if votes else mean).tolist()
        cols["impurity"] += (2 * mean * (1 - mean) if votes else np.maximum(q / np.maximum(n, 1) - mean * mean, 0.0)).tolist()
        cols["stats"] += (np.stack([n - s, s], axis=1) if votes else t.stats).tolist()
        cols["n"] += n.astype(int).tolist()
        cols["gain"] += t.gain.tolist()
        cols["left"] += t.left.tolist()
        cols["right"] += np.where(inner, t.left + 1, -1).tolist()
        cols["feature"] += t.feature.tolist()
        cols["cut"] += [[c] if i else [] for c, i in zip(t.cut.tolist(), inner.tolist())]
    kinds = {"prediction": pa.float64(), "impurity": pa.float64(), "stats": pa.list_(pa.float64()), "n": pa.int64(), "gain": pa.float64(), "cut": pa.list_(pa.float64())}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int32())) for k, v in cols.items()], list(cols))


# --- jobs ------------------------------------------------------------------------------


class Grid:
    """A panel as one row in the shared folder, and the jobs that have a task for each cell of it."""

    def __init__(self, panel: DataFrame, r: roles.Roles, settings: models.ModelSettings) -> None:
        self.spark, self.roles, self.settings = panel.sparkSession, r, settings
        labels = [c for c in panel.columns if c.startswith(tuple(roles.TASKS.values()))]
        keys = F.to_json(F.struct(*r.ids)).alias("__keys")
        columns = [F.col(f"`{c}`").cast("double").alias(c) for c in (*r.numeric, *labels)]
        flat = panel.select(F.trunc(r.date, "MM").alias("__month"), keys, *columns, *[F.col(f"`{c}`").cast("string").alias(c) for c in r.categorical])

        def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = [*parts]
            if whole:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, whole[0].schema) as out:
                    for part in whole:
                        out.write_batch(part)
                yield pa.RecordBatch.from_pydict({"packed": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        self.packed = settle(flat.coalesce(1).mapInArrow(pack, "packed binary"), "packed")

    def _run(self, cells: Sequence[tuple], step, schema: str) -> DataFrame:
        """``step(number, cell, packed)`` for each cell in a task of its own; its record batches are the result."""
        cells = list(cells)

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                for row in part.to_pylist():
                    yield from step(row["id"], cells[row["id"]], row["packed"])

        # the panel is one row, so every task gets it and nothing else
        each = self.spark.range(0, len(cells), 1, max(1, len(cells))).crossJoin(F.broadcast(self.packed))
        return each.mapInArrow(run, schema)

    def predictions(self, cells: Sequence[tuple]) -> DataFrame:
        """(task, horizon, model_name, fold, truth, guess) of the validation rows of cells (task, horizon, family, encoding, scale, fold bounds).

        Classification folds with one class in the training or validation part give no rows.
        """
        s, numeric, categorical = asdict(self.settings), self.roles.numeric, self.roles.categorical
        label_of = {(t, h): roles.label_name(t, h) for t, h, *_ in cells}

        def step(number: int, cell: tuple, packed: bytes) -> Iterator[pa.RecordBatch]:
            task, horizon, name, encoding, scale, (fold, last_train, first, last) = cell
            m = Matrix(packed, numeric, categorical, label_of[task, horizon])
            train, held = m.upto(last_train), m.between(first, last)
            if task == "classification" and min(len(np.unique(m.y[rows])) for rows in (train, held)) < 2:
                return
            x, x_held = inputs(m, train, (train, held), encoding, scale)
            guess = predicted(name, s, x, m.y[train], x_held)
            many = len(held)
            yield pa.RecordBatch.from_pydict({
                "task": [task] * many, "horizon": pa.array([horizon] * many, pa.int32()), "model_name": [name] * many,
                "fold": pa.array([fold] * many, pa.int32()), "truth": m.y[held], "guess": guess,
            })

        return self._run(cells, step, "task string, horizon int, model_name string, fold int, truth double, guess double")

    def nodes(self, cells: Sequence[tuple]) -> DataFrame:
        """The trees of cells (task, horizon, family, encoding) fitted on all labelled rows, as nodes in the shared folder."""
        s, numeric, categorical = asdict(self.settings), self.roles.numeric, self.roles.categorical
        label_of = {(t, h): roles.label_name(t, h) for t, h, *_ in cells}
        shares = []
        for number, cell in enumerate(cells):
            trees = range(trees_of(cell[2], s))
            step_by = len(trees) if cell[2].startswith("gradient") else SHARE
            shares += [(number, *cell, trees[a : a + step_by]) for a in range(0, len(trees), step_by)]

        def step(_: int, share: tuple, packed: bytes) -> Iterator[pa.RecordBatch]:
            number, task, horizon, name, encoding, numbers = share
            m = Matrix(packed, numeric, categorical, label_of[task, horizon])
            every = np.arange(len(m.y))
            (x,) = inputs(m, every, (every,), encoding, False)
            votes = name.endswith("_cls") and not name.startswith("gradient_boosting")
            trees = zip(numbers, grown(name, s, x, m.y, numbers))
            while some := [*itertools.islice(trees, TREES)]:
                yield _node_rows(number, some, votes)

        return settle(self._run(shares, step, NODES), "nodes")


KINDS = {
    "random_forest": RandomForestRegressor,
    "extra_trees": RandomForestRegressor,
    "gradient_boosting": GBTRegressor,
    "random_forest_cls": RandomForestClassifier,
    "extra_trees_cls": RandomForestClassifier,
    "gradient_boosting_cls": GBTClassifier,
}


class GrownPipeline:
    """A pipeline that ends in trees, to be saved: its trees go from the shared folder into its files, and the driver never holds them."""

    def __init__(self, prep: Sequence[Transformer], nodes: DataFrame, name: str, s: models.ModelSettings, width: int) -> None:
        self.nodes, self.name, self.settings, self.boosted = nodes, name, s, name.startswith("gradient_boosting")
        spark, zeros = nodes.sparkSession, Vectors.sparse(width, [])
        form = spark.createDataFrame([(zeros, 0.0), (zeros, 1.0)], ["features", "label"])
        many = {"maxIter": 1, "stepSize": s.rate} if self.boosted else {"numTrees": 1}
        self.form = PipelineModel([*prep, KINDS[name](maxDepth=0, seed=s.seed, **many).fit(form)])

    def write(self) -> GrownPipeline:
        return self

    def overwrite(self) -> GrownPipeline:
        return self

    def save(self, path: str) -> None:
        """One tree of the right form is saved, then its parts are replaced."""
        self.form.write().overwrite().save(path)
        stages = self.form.stages
        at = f"{path}/stages/{len(stages) - 1:0{len(str(len(stages)))}d}_{stages[-1].uid}"
        spark, s, trees = self.nodes.sparkSession, self.settings, trees_of(self.name, asdict(self.settings))
        told = json.loads(spark.read.text(f"{at}/metadata").first()[0])
        told["numTrees"] = trees
        told["paramMap"] |= {"maxIter": trees, "maxDepth": s.boost_depth} if self.boosted else {"numTrees": trees, "maxDepth": s.depth}
        spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(f"{at}/metadata")
        tree = spark.read.parquet(f"{at}/treesMetadata")
        schema, (_, said, _) = tree.schema, tree.first()
        rows = [(i, said, s.rate if self.boosted and i else 1.0) for i in range(trees)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{at}/treesMetadata")
        schema = spark.read.parquet(f"{at}/data").schema
        node = F.struct("id", "prediction", "impurity", "stats", "n", "gain", "left", "right", F.struct("feature", "cut", F.lit(-1)))
        made = self.nodes.select(F.col("tree").alias("treeID"), node.cast(schema["nodeData"].dataType).alias("nodeData"))
        made.write.mode("overwrite").parquet(f"{at}/data")


def _bounds(panel: DataFrame, horizons: Sequence[int], split: tuple) -> dict[tuple[str, int], list[tuple]]:
    cells = [(t, h) for t in roles.TASKS for h in horizons]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        found = [*pool.map(lambda cell: fold_stats.plan_folds(panel, cell[0], [cell[1]], *split).bounds, cells)]
    if not all(found):
        raise ValueError("not enough months for a time split; lower min_train")
    return {(t, h): bounds[h] for (t, h), bounds in zip(cells, found)}


def evaluate(panel: DataFrame, grid: Grid, horizons: Sequence[int], families: dict[str, Sequence[str]] | None, split: tuple) -> list[tuple]:
    """Scores of every family on every fold of all horizons and both tasks, from one job."""
    cells = []
    for (task, h), bounds in _bounds(panel, horizons, split).items():
        for name, recipe in models.recipes(task, grid.settings, (families or {}).get(task)).items():
            cells += [(task, h, name, recipe.encoding, recipe.scale, b) for b in bounds]
    cells.sort(key=lambda c: SLOWEST.index(c[2]) if c[2] in SLOWEST else len(SLOWEST))
    said = settle(grid.predictions(cells), "predictions")
    by = ["task", "horizon", "model_name", "fold"]
    numbers = metrics.regression_metrics(said.where("task = 'regression'"), "truth", "guess", by)
    hits = metrics.accuracy(said.where("task = 'classification'"), "truth", "guess", by)
    names = [p.split()[0] for p in models.SCORE_SCHEMA.split(", ")]
    return [tuple(r) for r in metrics.union_scores(numbers, hits).select(*names).orderBy(*by).collect()]


def train_best_models(
    panel: DataFrame,
    model_dir: str,
    horizons: Sequence[int] = fixed.HORIZONS,
    settings: models.ModelSettings = models.ModelSettings(),
    families: dict[str, Sequence[str]] | None = None,
    min_train: int = fixed.MIN_TRAIN_MONTHS,
    valid: int = fixed.VALID_MONTHS,
    max_splits: int = fixed.MAX_SPLITS,
    embargo: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """As ``models.train_best_models``; the fits of a panel that one task holds run side by side inside tasks."""
    panel = settle_compact(panel, "panel")
    r = roles.infer_roles(panel)
    split = (min_train, valid, max_splits, embargo)
    if not fits_a_task(panel, r):
        names = dict(zip(("min_train", "valid", "max_splits", "embargo"), split))
        return models.train_best_models(panel, model_dir, horizons, settings, families, **names)
    grid = Grid(panel, r, settings)
    scores = panel.sparkSession.createDataFrame(evaluate(panel, grid, horizons, families, split), models.SCORE_SCHEMA)
    winners = {(w["task"], w["horizon"]): w["model_name"] for w in metrics.best_models(metrics.score_summary(scores)).collect()}
    known = {task: models.recipes(task, settings) for task in roles.TASKS}
    cells = [(t, h, n, known[t][n].encoding) for (t, h), n in sorted(winners.items()) if n in KINDS]
    nodes = grid.nodes(cells) if cells else None
    numbers = {c[:2]: i for i, c in enumerate(cells)}

    def refit(matrix: DataFrame, task: str, horizon: int, name: str) -> PipelineModel | GrownPipeline:
        label, recipe = roles.label_name(task, horizon), known[task][name]
        if (task, horizon) not in numbers:
            return models.fit_model(matrix, recipe, r, label)
        matrix = settle_compact(matrix, f"matrix-{task}-h{horizon}")
        learned = features.learn(matrix, r.numeric, r.categorical)
        prep = features.preprocessing_stages(matrix, learned, recipe.encoding, recipe.scale)
        first = PipelineModel(prep).transform(matrix).select("features").first()
        own = nodes.where(F.col("cell") == numbers[task, horizon])
        return GrownPipeline(prep, own, name, settings, first["features"].size)

    return models.save_best_models(panel, model_dir, scores, winners, horizons, refit, AT_ONCE)
