"""Extremely randomised trees, grown level by level: one random cut per feature and node, no bootstrap.

A level takes two aggregates over the rows. The first finds the range of each feature in each node, in which a
cut is drawn; the second adds up what lies left of each cut. Tasks add up their own rows first, and partial
sums meet in groups of (tree, node), so no task sees all rows. Cuts depend on nothing but seed, tree,
node, feature and range: a fit can be repeated. As with other forests of Spark, the driver holds the splits; nodes are
worked on in groups, so that what a level sends to the tasks stays below ``CELLS`` numbers whatever the size of the trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from seriesmill.session import fresh_dir, settle

#: Most numbers (nodes x features) of one group of nodes.
CELLS = 2_000_000
#: Share of the sum of squares up to which gains are equal, as sums have no fixed order.
TIES = 1e-9
#: Rows that a task works on at once.
ROWS = 4_096
_PRIME = 2_147_483_647


def mix(x):
    """Next number below 2^31 - 1 of a sequence; for whole numbers, arrays and columns alike."""
    return (x * x % _PRIME + x * 48_271 + 11) % _PRIME


def share(seed: int, tree, node, feature):
    """Where in its range the cut lies, from 0 to below 1."""
    return mix(mix(mix(mix(mix(seed + tree) + node) + feature))) / float(_PRIME)


def cuts(seed: int, tree: int, node: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One cut per feature; values up to it go left."""
    return low + share(seed, tree, node, np.arange(len(low), dtype=np.int64)) * (high - low)


def gains(n: float, s: float, nl: np.ndarray, sl: np.ndarray, min_leaf: int) -> np.ndarray:
    """What each cut takes off the squared error, -inf where a side is too small; for classes 0 and 1 half of the Gini loss."""
    nr, sr = n - nl, s - sl
    found = sl * sl / np.maximum(nl, 1) + sr * sr / np.maximum(nr, 1) - s * s / n
    return np.where((nl >= min_leaf) & (nr >= min_leaf), found, -np.inf)


class Trees:
    """Splits of all trees as one list of nodes; the first ``trees`` nodes are the roots."""

    def __init__(self, trees: int) -> None:
        self.tree, self.number = list(range(trees)), [0] * trees
        self.feature, self.cut, self.left = [-1] * trees, [0.0] * trees, [-1] * trees
        self.stats = [(0.0, 0.0, 0.0)] * trees
        self.gain = [-1.0] * trees
        self.grown = [1] * trees  # nodes of each tree

    def split(self, at: int, feature: int, cut: float, gain: float) -> list[int]:
        tree = self.tree[at]
        self.feature[at], self.cut[at], self.gain[at], self.left[at] = feature, cut, gain, len(self.tree)
        for _ in range(2):
            self.tree.append(tree)
            self.number.append(self.grown[tree])
            self.grown[tree] += 1
            for values, empty in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.stats, (0.0, 0.0, 0.0)), (self.gain, -1.0)):
                values.append(empty)
        return [len(self.tree) - 2, len(self.tree) - 1]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature, np.int64), np.array(self.cut), np.array(self.left, np.int64)


def reached(x: np.ndarray, root: int, arrays: tuple[np.ndarray, ...]) -> np.ndarray:
    """The node of one tree at which each row stands."""
    feature, cut, left = arrays
    at = np.full(len(x), root)
    moving = np.arange(len(x))
    while len(moving):
        now = at[moving]
        inner = feature[now] >= 0
        moving, now = moving[inner], now[inner]
        at[moving] = left[now] + (x[moving, feature[now]] > cut[now])
    return at


def _blocks(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for part in parts:
        for a in range(0, len(part), ROWS):
            cut = part.iloc[a : a + ROWS]
            yield np.stack(cut["x"].to_numpy()).astype(float), cut["y"].to_numpy(float)


def _in_nodes(x: np.ndarray, roots: Sequence[int], arrays: tuple, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(nodes, rows in their order, where each node starts) of each tree, for the wanted nodes."""
    for root in roots:
        at = reached(x, root, arrays)
        place = np.minimum(np.searchsorted(wanted, at), len(wanted) - 1)
        rows = np.flatnonzero(wanted[place] == at)
        if len(rows):
            rows = rows[np.argsort(at[rows], kind="stable")]
            nodes, starts = np.unique(at[rows], return_index=True)
            yield nodes, rows, starts


def _ranges(rows: DataFrame, roots, arrays, wanted) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = {}, {}
        for x, _ in _blocks(parts):
            for nodes, order, starts in _in_nodes(x, roots, arrays, wanted):
                least, most = np.minimum.reduceat(x[order], starts), np.maximum.reduceat(x[order], starts)
                for i, node in enumerate(nodes):
                    low[node] = np.minimum(low.get(node, np.inf), least[i])
                    high[node] = np.maximum(high.get(node, -np.inf), most[i])
        if low:
            yield pd.DataFrame({"node": list(low), "low": list(low.values()), "high": list(high.values())})

    told = rows.mapInPandas(run, "node long, low array<double>, high array<double>")

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        low, high = np.min(np.stack(group["low"].to_numpy()), axis=0), np.max(np.stack(group["high"].to_numpy()), axis=0)
        return pd.DataFrame({"node": [group["node"].iloc[0]], "low": [low], "high": [high]})

    return told.groupBy("node").applyInPandas(merge, "node long, low array<double>, high array<double>")


def _sums(rows: DataFrame, roots, arrays, wanted, drawn: np.ndarray) -> DataFrame:
    schema = "node long, part long, n double, s double, q double, nl array<double>, sl array<double>"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, list] = {}
        for x, y in _blocks(parts):
            for nodes, order, starts in _in_nodes(x, roots, arrays, wanted):
                sizes = np.diff(starts, append=len(order))
                cut = drawn[np.repeat(np.searchsorted(wanted, nodes), sizes)]
                left, t = x[order] <= cut, y[order]
                add = np.add.reduceat
                sums = zip(sizes, add(t, starts), add(t * t, starts), add(left, starts, dtype=float), add(left * t[:, None], starts))
                for node, values in zip(nodes, sums):
                    held = found.get(node)
                    found[node] = list(values) if held is None else [a + b for a, b in zip(held, values)]
        if found:
            n, s, q, nl, sl = zip(*found.values())
            part = TaskContext.get().partitionId()
            yield pd.DataFrame({"node": list(found), "part": part, "n": np.array(n, float), "s": s, "q": q, "nl": nl, "sl": sl})

    return rows.mapInPandas(run, schema)


def _best(sums: DataFrame, wanted: np.ndarray, drawn: np.ndarray, min_leaf: int) -> DataFrame:
    """The cut of each node that gains most, the first of those that are equal but for rounding (``TIES``); feature -1 where none may be made."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        node = int(group["node"].iloc[0])
        n, s, q = (float(group[c].sum()) for c in ("n", "s", "q"))
        nl, sl = (np.sum(np.stack(group[c].to_numpy()), axis=0) for c in ("nl", "sl"))
        gain = gains(n, s, nl, sl, min_leaf)
        f = int(np.argmax(gain >= gain.max() - TIES * q))
        found = gain[f] > TIES * q
        cut = drawn[np.searchsorted(wanted, node)][f]
        return pd.DataFrame({"node": [node], "n": n, "s": s, "q": q, "feature": f if found else -1, "cut": cut, "gain": gain[f] if found else -1.0})

    return sums.groupBy("node").applyInPandas(merge, "node long, n double, s double, q double, feature long, cut double, gain double")


def grow(rows: DataFrame, width: int, trees: int, min_leaf: int, depth: int, seed: int) -> Trees:
    """Trees on ``rows`` (x array<double> of ``width`` finite values, y double); an empty table gives roots without rows."""
    made, front = Trees(trees), list(range(trees))
    for level in range(depth + 1):
        following = []
        step = max(1, CELLS // max(width, 1))
        for a in range(0, len(front), step):
            wanted = np.array(front[a : a + step])
            roots = sorted({made.tree[i] for i in wanted})
            arrays = made.arrays()
            drawn = np.zeros((len(wanted), width))
            for r in _ranges(rows, roots, arrays, wanted).toLocalIterator():
                at = int(np.searchsorted(wanted, r.node))
                drawn[at] = cuts(seed, made.tree[r.node], made.number[r.node], np.array(r.low), np.array(r.high))
            for r in sorted(_best(_sums(rows, roots, arrays, wanted, drawn), wanted, drawn, min_leaf).collect()):
                made.stats[r.node] = (r.n, r.s, r.q)
                if r.feature >= 0 and r.n >= 2 * min_leaf:
                    following.append((r.node, r.feature, r.cut, r.gain))
        if level == depth:
            break
        front = [child for node, feature, cut, gain in sorted(following) for child in made.split(node, feature, cut, gain)]
        if not front:
            break
    return made


class ExtraTrees:
    """Estimator with the interface of Spark's own; what it fits is a forest model of Spark, saved and loaded as such."""

    def __init__(self, trees: int, min_leaf: int = 2, depth: int = 30, seed: int = 42, classes: bool = False) -> None:
        self.trees, self.min_leaf, self.depth, self.seed, self.classes = trees, min_leaf, depth, seed, classes
        self.label, self.features = "label", "features"

    def setLabelCol(self, name: str) -> ExtraTrees:
        self.label = name
        return self

    def setFeaturesCol(self, name: str) -> ExtraTrees:
        self.features = name
        return self

    def fit(self, data: DataFrame) -> Model:
        """Rows without a label are left out; labels of ``classes`` are 0 and 1."""
        rows = data.where(F.col(self.label).isNotNull()).select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y"))
        rows = settle(rows, "tree-rows")
        width = rows.select(F.size("x")).first()[0]
        return self._model(data.sparkSession, grow(rows, width, self.trees, self.min_leaf, self.depth, self.seed), width)

    def _model(self, spark, made: Trees, width: int) -> Model:
        """A forest of the right form, written, with its nodes replaced."""
        kind = (RandomForestClassifier, RandomForestClassificationModel) if self.classes else (RandomForestRegressor, RandomForestRegressionModel)
        zeros = Vectors.sparse(width, [])
        form = spark.createDataFrame([(zeros, 0.0), (zeros, 1.0)], [self.features, self.label])
        empty = kind[0](numTrees=self.trees, maxDepth=0, seed=self.seed, labelCol=self.label, featuresCol=self.features).fit(form)
        path = fresh_dir(spark, "forest")
        empty.save(path)
        schema = spark.read.parquet(f"{path}/data").schema
        rows = []
        for at, tree in enumerate(made.tree):
            n, s, q = made.stats[at]
            mean = s / n if n else 0.0
            stats = [n - s, s] if self.classes else [n, s, q]
            impurity = 2 * mean * (1 - mean) if self.classes else max(q / n - mean * mean, 0.0) if n else 0.0
            inner, left = made.feature[at] >= 0, made.left[at]
            children = (made.number[left], made.number[left + 1]) if inner else (-1, -1)
            split = (made.feature[at], [float(made.cut[at])], -1) if inner else (-1, [], -1)
            said = float(mean > 0.5) if self.classes else float(mean)
            rows.append((tree, (made.number[at], said, impurity, [float(v) for v in stats], int(n), float(made.gain[at]), *children, split)))
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/data")
        return kind[1].load(path)
