"""Hard negatives by an inverted multi-index: cells of two half-space codebooks, visited in the order of certified bounds.

The two halves of a vector are coded by a codebook each; a pair of codes is a cell. For an anchor, the inner
product with a row of cell (i, j) is at most the sum of two half scores, half anchor x centre + |half anchor| x radius. A
heap over the two sorted lists of half scores (multi-sequence) yields the cells by falling bound. An anchor stops as soon as
each of its score windows is certified: it holds as many rows as wanted and the last one beats the bound of all cells to come,
or that bound lies below the window. Anchors travel to the cells in rounds; results are exact, whatever the codebooks are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.ann import counted
from seriesmill.llm.meeting import BLOCK, first_of, groups, matrix, meet, usable
from seriesmill.llm.work import Work

POSITIVES, NEGATIVES = 5, 3
#: Rows that a cell is meant to have, and codes of a half at most.
CELL, CODES = 1_024, 512
#: Rows on which the codebooks are fitted at most, and rounds of the fit.
SAMPLE, STEPS = 16_384, 8
#: Cells that an anchor visits in the first round, and the factor from round to round.
FIRST, FACTOR = 8, 8
ASKS, GATHER = 256, 200_000
SEED = 13
ROWS = "key long, kind int, id long, vec_id long, label long, vector array<int>"
WINDOWS = "array<struct<w:int,lo:long,hi:long>>"


def _centres(x: np.ndarray, codes: int) -> np.ndarray:
    """Lloyd's centres of the rows; the first ones are rows drawn by a fixed seed."""
    rng = np.random.default_rng([SEED, x.shape[1]])
    centres = np.unique(x[rng.permutation(len(x))[:codes]], axis=0)
    for _ in range(STEPS):
        code = _codes(x, centres)
        sums, n = np.zeros_like(centres), np.bincount(code, minlength=len(centres))
        np.add.at(sums, code, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _codes(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T)).argmin(axis=1)


class Codebooks:
    """Centres per vector length and half; a length that the sample does not hold has one centre, zero."""

    def __init__(self, sample: dict[int, np.ndarray], rows: int) -> None:
        size = sum(map(len, sample.values()))
        self.centres = {}
        for dim, x in sample.items():
            codes = max(1, min(CODES, int(np.ceil(np.sqrt(rows * len(x) / size / CELL)))))
            self.centres[dim] = [_centres(part.astype(float), codes) for part in (x[:, : dim // 2], x[:, dim // 2 :])]

    def halves(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, centres) of both halves."""
        dim = x.shape[1]
        known = self.centres.get(dim) or [np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2))]
        return list(zip((x[:, : dim // 2], x[:, dim // 2 :]), known))


def cell_key(dim: int, i: np.ndarray | int, j: np.ndarray | int) -> np.ndarray | int:
    return (i * CODES + j) * 65_536 + dim % 65_536


def cells(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(key, kind, id, vec_id, label, vector): rows with the key of their cell."""

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for dim, batch in _by_dim(part):
                (a, first), (b, second) = books.halves(matrix(batch.column("vector")))
                key = cell_key(dim, _codes(a, first), _codes(b, second))
                cols = [pa.array(key), pa.array(np.zeros(len(key), np.int32)), *(batch.column(c) for c in ("id", "vec_id", "label", "vector"))]
                yield pa.RecordBatch.from_arrays(cols, ["key", "kind", "id", "vec_id", "label", "vector"])

    return rows.select("id", "vec_id", "label", "vector").mapInArrow(assign, ROWS)


def radii(celled: DataFrame, books: Codebooks) -> dict[tuple[int, int], dict[int, float]]:
    """Largest distance of a row from its centre per (length, half) and code in use: a number per code."""

    def widest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], float] = {}
        for part in parts:
            for dim, batch in _by_dim(part):
                for half, (x, centres) in enumerate(books.halves(matrix(batch.column("vector")))):
                    code = _codes(x, centres)
                    far = np.sqrt(((x - centres[code]) ** 2).sum(axis=1))
                    for c in np.unique(code).tolist():
                        found[dim, half, c] = max(found.get((dim, half, c), 0.0), float(far[code == c].max()))
        yield pa.RecordBatch.from_pylist(
            [{"dim": d, "half": h, "code": c, "radius": r} for (d, h, c), r in found.items()],
            pa.schema([("dim", pa.int64()), ("half", pa.int64()), ("code", pa.int64()), ("radius", pa.float64())]),
        )

    rows = celled.select("vector").mapInArrow(widest, "dim long, half long, code long, radius double")
    out: dict[tuple[int, int], dict[int, float]] = {}
    for r in rows.groupBy("dim", "half", "code").agg(F.max("radius").alias("radius")).collect():
        out.setdefault((r.dim, r.half), {})[r.code] = r.radius
    return out


def visits(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(sum, place in first, place in second) by falling sum of two lists of half scores."""
    a, b = (-first).argsort(kind="stable").tolist(), (-second).argsort(kind="stable").tolist()
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        yield -total, a[i], b[j]
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


def _asks(anchors: DataFrame, books: Codebooks, wide: dict, start: int, stop: int) -> DataFrame:
    """Each anchor once per cell among its visits ``start`` to ``stop`` that its windows still need.

    ``anchors`` (id, vec_id, label, vector, windows, full): full holds the last score of each window that has all its rows.
    """

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for dim, batch in _by_dim(part):
                halves = books.halves(matrix(batch.column("vector")))
                used = [sorted(wide.get((dim, h), {}).items()) for h in (0, 1)]
                if not all(used):
                    continue
                bounds = []
                for (x, centres), codes in zip(halves, used):
                    at, radius = np.array([c for c, _ in codes]), np.array([r for _, r in codes])
                    bounds.append(x @ centres[at].T + np.sqrt((x * x).sum(axis=1))[:, None] * radius[None, :])
                place, keys = [], []
                windows, full = batch.column("windows").to_pylist(), batch.column("full").to_pylist()
                for row in range(batch.num_rows):
                    last = {f["w"]: f["last"] for f in full[row] or []}
                    # a window needs cells whose bound reaches its least score, or beats or ties its last row
                    least = min((max(w["lo"], last[w["w"]]) if w["w"] in last else w["lo"] for w in windows[row] or [] if w["lo"] <= w["hi"]), default=None)
                    if least is None:
                        continue
                    for n, (bound, i, j) in enumerate(visits(bounds[0][row], bounds[1][row])):
                        if n >= stop or bound + 1e-6 * (1 + abs(bound)) < least:
                            break
                        if n >= start:
                            place.append(row)
                            keys.append(cell_key(dim, used[0][i][0], used[1][j][0]))
                for at in range(0, len(keys), 65_536):
                    some = batch.take(pa.array(place[at : at + 65_536]))
                    cols = [pa.array(keys[at : at + 65_536], pa.int64()), pa.array(np.ones(some.num_rows, np.int32))]
                    yield pa.RecordBatch.from_arrays(
                        [*cols, *(some.column(c) for c in ("id", "vec_id", "label", "vector", "windows"))],
                        ["key", "kind", "id", "vec_id", "label", "vector", "windows"],
                    )

    return anchors.mapInArrow(ask, f"{ROWS}, windows {WINDOWS}")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows; sums below 2^53 are exact in doubles, others are taken in longs."""
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


FOUND = "owner long, w int, id long, vec_id long, score long"
LOWEST = np.iinfo(np.int64).min


def _compare(same: bool, want: int):
    def combine(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        owner, w, row, vec_id, score = (np.concatenate([p[k] for p in parts]) for k in range(5))
        keep = first_of(owner * 8 + w, (-score, vec_id, row), want)
        return owner[keep], w[keep], row[keep], vec_id[keep], score[keep]

    def batch(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        owner, w, row, vec_id, score = found
        return pa.RecordBatch.from_arrays(
            [pa.array(owner), pa.array(w.astype(np.int32)), pa.array(row), pa.array(vec_id), pa.array(score)], ["owner", "w", "id", "vec_id", "score"]
        )

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for rows, asks in groups(parts):
            x, row_label = matrix(rows.column("vector"), np.int64), rows.column("label").to_numpy()
            row_id, vec_id = rows.column("id").to_numpy(), rows.column("vec_id").to_numpy()
            for at in range(0, asks.num_rows, ASKS):
                some = asks.slice(at, ASKS)
                score = products(matrix(some.column("vector"), np.int64), x)
                fits = (some.column("label").to_numpy()[:, None] == row_label[None, :]) == same
                if same:
                    fits &= some.column("vec_id").to_numpy()[:, None] != vec_id[None, :]
                windows = some.column("windows").combine_chunks()
                of, flat = np.repeat(np.arange(some.num_rows), windows.value_lengths().fill_null(0).to_numpy()), windows.flatten()
                w, lo, hi = (flat.field(k).to_numpy() for k in range(3))
                asker = some.column("id").to_numpy()
                for number in np.unique(w).tolist():
                    here = np.flatnonzero(w == number)
                    i = of[here]
                    s = score[i]
                    s = np.where(fits[i] & (s >= lo[here, None]) & (s <= hi[here, None]), s, LOWEST)
                    floor = -np.partition(-np.maximum(s, LOWEST + 1), want - 1, axis=1)[:, want - 1] if s.shape[1] > want else np.full(len(s), LOWEST + 1)
                    a, j = np.nonzero((s >= floor[:, None]) & (s > LOWEST))
                    keep = first_of(a, (-s[a, j], vec_id[j], row_id[j]), want)
                    a, j = a[keep], j[keep]
                    gathered.append((asker[i[a]], np.full(len(a), number), row_id[j], vec_id[j], s[a, j]))
                    size += len(a)
            if size > GATHER:
                gathered = [combine(gathered)]
                size = len(gathered[0][0])
                if size > GATHER // 2:
                    yield batch(gathered[0])
                    gathered, size = [], 0
        if gathered:
            yield batch(combine(gathered))

    return compare


def _first(found: DataFrame, want: int) -> DataFrame:
    order = Window.partitionBy("owner", "w").orderBy(F.col("score").desc(), "vec_id", "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= want)


def search(anchors: DataFrame, celled: DataFrame, books: Codebooks, wide: dict, work: Work, same: bool, want: int, block: int = BLOCK) -> DataFrame:
    """(owner, w, id, vec_id, score, rank): per anchor and window the first ``want`` rows of the same label, or of others.

    ``anchors``: id, vec_id, label, vector, windows (w, lo, hi). Visits grow by ``FACTOR`` from round to round, until no anchor needs a cell.
    """
    shapes = [(wide.get((d, 0), {}), wide.get((d, 1), {})) for d in {d for d, _ in wide}]
    all_cells = max((len(a) * len(b) for a, b in shapes), default=0)
    found, start, stop = None, 0, FIRST
    plain = celled.withColumn("windows", F.lit(None).cast(WINDOWS))
    while start < all_cells:
        if found is None:
            state = anchors.withColumn("full", F.lit(None).cast("array<struct<w:int,last:long>>"))
        else:
            last = found.groupBy("owner", "w").agg(F.count("*").alias("n"), F.min("score").alias("last")).filter(F.col("n") == want)
            full = last.groupBy("owner").agg(F.collect_list(F.struct("w", "last")).alias("full"))
            state = anchors.join(full, F.col("id") == F.col("owner"), "left").drop("owner")
        asks = work.settle(_asks(state, books, wide, start, stop), "asks")
        if asks.isEmpty():
            break
        posts = plain.join(asks.select("key").distinct(), "key", "left_semi").unionByName(asks)
        new = meet(posts, counted(posts), work, block).mapInArrow(_compare(same, want), FOUND)
        found, old = work.settle(_first(new if found is None else found.drop("rank").unionByName(new), want), "found"), found
        work.drop(asks, *([old] if old is not None else []))
        start, stop = stop, stop * FACTOR
    if found is None:
        return anchors.sparkSession.createDataFrame([], f"{FOUND}, rank int")
    return found


def prepared(vectors: DataFrame) -> DataFrame:
    """(id, vec_id, label, vector) of the rows that take part: whole-number vectors and labels as they count.

    Components beyond 2^28 / sqrt(length) after the scaling by 256 would take a score out of the longs; such rows take no part.
    """
    x, vec_id, label = F.col("embedding"), F.col("vec_id"), F.col("label").cast("long")
    limit = F.lit(2.0**28) / F.sqrt(F.size(x).cast("double"))
    small = F.forall(x, lambda c: F.abs(c.cast("double") * 256) <= limit)
    shifted = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return vectors.filter(vec_id.isNotNull() & label.isNotNull() & usable(x, zero=True) & F.coalesce(small, F.lit(False))).select(
        F.monotonically_increasing_id().alias("id"), "vec_id", shifted.alias("label"), F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("int")).alias("vector")
    )


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = pa.compute.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        yield dim, batch.filter(pa.array(dims == dim))


def percent_window(score: Column) -> tuple[Column, Column]:
    """Least and largest whole number n with 50 x score <= 100 x n <= 95 x score."""
    upper = score * 19
    return F.shiftright(score + 1, 1), F.floor((upper - F.pmod(upper, F.lit(20))).cast("decimal(20,0)") / 20).cast("long")


def mine(vectors: DataFrame, work: Work, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``vectors`` (vec_id, embedding, label).

    Anchors are rows whose vec_id is divisible by ``every``; their positives the first rows of the same label by score, ties
    to the smaller vec_id; the negatives of a positive the first rows of other labels whose score is 50 to 95 percent of the
    positive's. Rows with a null vec_id, label or vector, an empty vector, or a null or non-finite component take no part; vectors of
    different lengths have no score. Rows that share a vec_id are rows of their own, but none is a positive of another of that id. Of
    equal vectors with one label only the ``positives`` + 1 smallest ids can be in a result (``negatives`` is no larger), so only
    these are indexed, and the limit is applied before the shuffle. A positive without negatives gives no row; an
    empty table gives no rows.
    """
    keep = max(positives + 1, negatives)
    if positives > 8:
        raise ValueError("at most 8 positives: windows are numbered in three bits")
    rows = work.settle(prepared(vectors), "vectors")
    anchors = rows.filter(F.col("vec_id") % every == 0)
    copy = Window.partitionBy("vector", "label").orderBy("vec_id", "id")
    few = work.settle(rows.withColumn("copy", F.row_number().over(copy)).filter(F.col("copy") <= keep).drop("copy"), "few")
    sample = few.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "id").limit(SAMPLE).select("vector").toArrow().column("vector").combine_chunks()
    dims = sample.value_lengths().to_numpy()
    books = Codebooks({d: matrix(sample.filter(pa.array(dims == d))) for d in np.unique(dims).tolist()}, few.count())
    celled = work.settle(cells(few, books), "cells")
    wide = radii(celled, books)
    everything = F.array(F.struct(F.lit(0).alias("w"), F.lit(int(LOWEST + 2)).alias("lo"), F.lit(int(-(LOWEST + 2))).alias("hi")))
    near = search(anchors.withColumn("windows", everything.cast(WINDOWS)), celled, books, wide, work, True, positives, block)
    lo, hi = percent_window(F.col("score"))
    pairs = near.select("owner", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), lo.alias("lo"), hi.alias("hi"))
    pairs = work.settle(pairs, "positives")
    windows = pairs.filter("lo <= hi").groupBy("owner").agg(F.collect_list(F.struct("w", "lo", "hi")).cast(WINDOWS).alias("windows"))
    again = work.settle(anchors.join(windows, F.col("id") == F.col("owner")).drop("owner"), "anchors")
    far = search(again, celled, books, wide, work, False, negatives, block)
    named = far.select("owner", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("id").alias("owner"), F.col("vec_id").alias("anchor_id"))
    return named.join(pairs, ["owner", "w"]).join(ids, "owner").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
