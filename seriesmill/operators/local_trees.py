"""Forests, extremely randomised trees and boosted trees on a matrix that one task holds.

The same families as those of Spark and of ``extra_trees``, for the many small fits of a grid: a fit runs inside
one task and starts no job. Forests and boosted trees cut numbers into at most ``BINS`` parts at the points that Spark takes;
boosting starts from the label and follows the gradients of Spark's losses, forests draw rows with replacement.
Extremely randomised trees draw the cuts of ``extra_trees`` and so equal its trees.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

from seriesmill.operators import extra_trees
from seriesmill.operators.extra_trees import TIES, gains, reached, share

#: The steps inside tasks travel with the job, so that only the driver needs this package.
for _module in (sys.modules[__name__], extra_trees):
    cloudpickle.register_pickle_by_value(_module)

#: Most parts of a number's range, as in Spark's trees.
BINS = 32
#: Most histogram cells at once.
CELLS = 2_000_000


@dataclass(frozen=True)
class Tree:
    """Nodes by number from the root 0: split (feature -1 at a leaf), left child (the right one follows), rows, sums of labels and their squares."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    stats: np.ndarray
    gain: np.ndarray

    def means(self) -> np.ndarray:
        return self.stats[:, 1] / np.maximum(self.stats[:, 0], 1e-300)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        return reached(x, 0, (self.feature, self.cut, self.left))


def cut_points(v: np.ndarray, bins: int) -> np.ndarray:
    """Where a number is cut: between all its values if they are few, else near equal shares of the rows."""
    values, counts = np.unique(v, return_counts=True)
    middles = values[:-1] / 2 + values[1:] / 2
    if len(middles) < bins:
        return middles
    stride, taken, seen = len(v) / bins, [], 0
    goal, counts = stride, counts.tolist()
    for i, n in enumerate(counts[:-1]):
        seen += n
        if abs(seen - goal) < abs(seen + counts[i + 1] - goal):
            taken.append(i)
            goal += stride
    return middles[taken]


class Binned:
    """Columns as codes of their parts; ``use`` names the columns that can be cut."""

    def __init__(self, x: np.ndarray) -> None:
        self.rows, self.width = x.shape
        self.points = [cut_points(x[:, f], min(BINS, len(x))) for f in range(self.width)]
        self.codes = np.zeros((self.width, self.rows), np.uint8)
        for f, points in enumerate(self.points):
            self.codes[f] = np.searchsorted(points, x[:, f])
        self.use = np.flatnonzero([len(p) for p in self.points])
        self.used = self.codes[self.use]


def _gains(nl, sl, n, s, min_leaf: int) -> np.ndarray:
    """What each cut takes off the squared error, -inf where a side is too small; ``sl`` is used up."""
    nr = n - nl
    bad = (nl < min_leaf) | (nr < min_leaf)
    gain = s - sl
    np.square(gain, out=gain)
    gain /= np.maximum(nr, 1)
    np.square(sl, out=sl)
    sl /= np.maximum(nl, 1)
    gain += sl
    gain -= s * s / n
    gain[np.broadcast_to(bad, gain.shape)] = -np.inf
    return gain


def _best(codes: np.ndarray, sizes: np.ndarray, w: np.ndarray | None, wy: np.ndarray, stats: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """(row of ``codes`` or -1, code, gain) per node: the cut that gains most, in the first column of those that are equal but for rounding.

    The rows of a node lie side by side. Large nodes add up their rows by part; for small ones, which have fewer rows than parts, the
    rows are sorted by their codes and all cuts come from running sums.
    """
    many, starts = len(sizes), np.cumsum(sizes) - sizes
    slot = np.repeat(np.arange(many), sizes)
    n, s, q = stats.T
    if many * BINS <= len(slot):
        keys = (codes + (slot * BINS + np.arange(len(codes))[:, None] * (many * BINS))).ravel()
        shape = (len(codes), many, BINS)
        nl = np.bincount(keys, weights=None if w is None else np.tile(w, len(codes)), minlength=codes.shape[0] * many * BINS).reshape(shape)
        sl = np.bincount(keys, weights=np.tile(wy, len(codes)), minlength=codes.shape[0] * many * BINS).reshape(shape)
        gain = _gains(nl.cumsum(axis=2), sl.cumsum(axis=2), n[:, None], s[:, None], min_leaf)
        top = gain.max(axis=2)
        code_at = lambda c, i: gain[c, i].argmax()
    else:
        keys = codes + (slot * BINS).astype(np.uint16 if many * BINS <= 65_536 else np.int64)
        order = keys.argsort(axis=1, kind="stable")
        keys = np.take_along_axis(keys, order, axis=1)
        sl = np.cumsum(wy[order], axis=1)
        sl -= np.repeat(np.where(starts > 0, sl[:, starts - 1], 0.0), sizes, axis=1)
        if w is None:
            nl = (np.arange(len(slot)) - starts[slot] + 1.0)[None, :]
        else:
            nl = np.cumsum(w[order], axis=1)
            nl -= np.repeat(np.where(starts > 0, nl[:, starts - 1], 0.0), sizes, axis=1)
        gain = _gains(nl, sl, n[slot], s[slot], min_leaf)
        gain[:, :-1][keys[:, 1:] == keys[:, :-1]] = -np.inf  # rows of one part stay together
        top = np.maximum.reduceat(gain, starts, axis=1)
        code_at = lambda c, i: keys[c, starts[i] + gain[c, starts[i] : starts[i] + sizes[i]].argmax()] % BINS
    most = top.max(axis=0)
    column = (top >= most - TIES * q).argmax(axis=0)
    column[~(most > TIES * q)] = -1
    code = np.zeros(many, np.int64)
    for i in np.flatnonzero(column >= 0):
        code[i] = code_at(column[i], i)
    return column, code, most


def grow_binned(
    binned: Binned, y: np.ndarray, min_leaf: int, depth: int, w: np.ndarray | None = None, pick: int = 0, draw: np.random.Generator | None = None
) -> tuple[Tree, np.ndarray]:
    """A tree on rows of weight ``w``, and the node of each row of weight; ``pick`` columns are drawn for each node (0: all)."""
    rows = np.arange(binned.rows) if w is None else np.flatnonzero(w)
    weight = np.ones(len(rows)) if w is None else w[rows].astype(float)
    shift = float(weight @ y[rows] / weight.sum())
    wy = weight * (y[rows] - shift)
    wyy = wy * (y[rows] - shift)
    feature, cut, left, gain = [-1], [0.0], [-1], [-1.0]
    stats = [(weight.sum(), wy.sum(), wyy.sum())]
    few = 0 < pick < binned.width
    span = max(1, CELLS // max(1, len(binned.use)))
    at = np.zeros(len(rows), np.int64)
    live, nodes, sizes = np.arange(len(rows)), np.array([0]), np.array([len(rows)])  # rows of nodes that may be cut, node by node
    for _ in range(depth if len(binned.use) else 0):
        known = np.array([stats[i] for i in nodes])
        able = (known[:, 0] >= 2 * min_leaf) & (known[:, 2] > 0)
        live, nodes, sizes, known = live[np.repeat(able, sizes)], nodes[able], sizes[able], known[able]
        if not len(nodes):
            break
        following, ends, a = [], np.cumsum(sizes), 0
        while a < len(nodes):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + span, side="right")))
            some = live[(ends[a - 1] if a else 0) : ends[b - 1]]
            slot = np.repeat(np.arange(b - a), sizes[a:b])
            if few:
                names = np.sort(draw.random((b - a, binned.width)).argpartition(pick - 1, axis=1)[:, :pick], axis=1)
                codes = binned.codes[names[slot].T, rows[some]]
            else:
                names = np.broadcast_to(binned.use, (b - a, len(binned.use)))
                codes = binned.used.take(rows[some], axis=1)
            c, k, g = _best(codes, sizes[a:b], None if w is None else weight[some], wy[some], known[a:b], min_leaf)
            split = np.flatnonzero(c >= 0)
            if len(split):
                child, base, many = np.full(b - a, -1), len(feature), 2 * len(split)
                child[split] = base + 2 * np.arange(len(split))
                kept = np.flatnonzero(child[slot] >= 0)
                slot = slot[kept]
                new = child[slot] + (codes[c[slot], kept] > k[slot])
                kept = some[kept]
                at[kept] = new
                following.append((kept[new.argsort(kind="stable")], np.arange(base, base + many), np.bincount(new - base, minlength=many)))
                stats += zip(*[np.bincount(new - base, weights=v[kept], minlength=many) for v in (weight, wy, wyy)])
                for i in split:
                    f, node = int(names[i, c[i]]), nodes[a + i]
                    feature[node], cut[node], left[node], gain[node] = f, float(binned.points[f][k[i]]), int(child[i]), float(g[i])
                for values, empty in ((feature, -1), (cut, 0.0), (left, -1), (gain, -1.0)):
                    values += [empty] * many
            a = b
        if not following:
            break
        live, nodes, sizes = (np.concatenate(v) for v in zip(*following))
    n, s, q = np.array(stats).T
    raw = np.stack([n, s + n * shift, q + 2 * shift * s + n * shift * shift], axis=1)
    return Tree(np.array(feature, np.int64), np.array(cut), np.array(left, np.int64), raw, np.array(gain)), at


def random_forest(x: np.ndarray, y: np.ndarray, trees: Sequence[int], min_leaf: int, depth: int, seed: int, classes: bool) -> Iterator[Tree]:
    """The trees of these numbers, on rows drawn with replacement; each node sees all columns, for ``classes`` the square root of their number."""
    binned = Binned(x)
    pick = int(np.ceil(np.sqrt(binned.width))) if classes else 0
    for tree in trees:
        draw = np.random.default_rng([seed, tree])
        w = np.bincount(draw.integers(0, len(y), len(y)), minlength=len(y))
        yield grow_binned(binned, y, min_leaf, depth, w, pick, draw)[0]


def boosted_trees(x: np.ndarray, y: np.ndarray, boosts: int, rate: float, depth: int, classes: bool) -> Iterator[Tree]:
    """The first tree follows the label (of ``classes`` -1 and 1) and has weight 1, the others what the loss still asks for, with weight ``rate``."""
    binned = Binned(x)
    goal = 2 * y - 1 if classes else y
    said, wanted = np.zeros(len(y)), goal
    for i in range(boosts):
        tree, at = grow_binned(binned, wanted, 1, depth)
        yield tree
        said = said + (rate if i else 1.0) * tree.means()[at]
        wanted = 4 * goal / (1 + np.exp(np.minimum(2 * goal * said, 700))) if classes else 2 * (y - said)


def extremely_random_trees(x: np.ndarray, y: np.ndarray, trees: Sequence[int], min_leaf: int, depth: int, seed: int) -> Iterator[Tree]:
    """The trees of these numbers of ``extra_trees.grow``, one after the other."""
    columns = np.ascontiguousarray(x.T, float)
    for tree in trees:
        yield _random_tree(columns, y, tree, min_leaf, depth, seed)


def _random_tree(columns: np.ndarray, y: np.ndarray, tree: int, min_leaf: int, depth: int, seed: int) -> Tree:
    width = len(columns)
    feature, cut, left, gain, stats = [-1], [0.0], [-1], [-1.0], [(float(len(y)), y.sum(), (y * y).sum())]
    x, t, nodes, starts = columns, y, np.array([0]), np.array([0])
    for _ in range(depth if width else 0):
        sizes = np.diff(starts, append=len(t))
        able = sizes >= 2 * min_leaf
        if not able.all():
            keep = np.repeat(able, sizes)
            x, t, nodes, sizes = x[:, keep], t[keep], nodes[able], sizes[able]
            starts = np.cumsum(sizes) - sizes
        if not len(nodes):
            break
        low, high = np.minimum.reduceat(x, starts, axis=1), np.maximum.reduceat(x, starts, axis=1)
        drawn = low + share(seed, tree, nodes[None, :], np.arange(width, dtype=np.int64)[:, None]) * (high - low)
        goes = x <= np.repeat(drawn, sizes, axis=1)
        nl, sl = np.add.reduceat(goes, starts, axis=1, dtype=float), np.add.reduceat(goes * t, starts, axis=1)
        n, s, q = np.array([stats[i] for i in nodes]).T
        found = gains(n, s, nl, sl, min_leaf)
        most = found.max(axis=0)
        best = (found >= most - TIES * q).argmax(axis=0)
        each = np.arange(len(nodes))
        splits = found[best, each] > TIES * q
        if not splits.any():
            break
        for i in np.flatnonzero(splits):
            node, f = nodes[i], best[i]
            feature[node], cut[node], left[node], gain[node] = int(f), float(drawn[f, i]), len(feature), float(found[f, i])
            for values, empty in ((feature, -1), (cut, 0.0), (left, -1), (gain, -1.0)):
                values += [empty, empty]
        keep = np.flatnonzero(np.repeat(splits, sizes))
        owner = np.repeat(each, sizes)[keep]
        right = ~goes[best[owner], keep]
        child = np.array(left)[nodes[owner]] + right
        order = np.argsort(child, kind="stable")
        x, t, child = x[:, keep[order]], t[keep[order]], child[order]
        nodes, starts = np.unique(child, return_index=True)
        sizes = np.diff(starts, append=len(t))
        stats += zip(sizes.astype(float), np.add.reduceat(t, starts), np.add.reduceat(t * t, starts))
    return Tree(np.array(feature, np.int64), np.array(cut), np.array(left, np.int64), np.array(stats, float).reshape(-1, 3), np.array(gain))
