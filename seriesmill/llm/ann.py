"""Approximate nearest neighbours by cross-polytope hashing, with multiprobe tables and exact reranking.

A table rotates a unit vector by three rounds of random sign flips and fast Hadamard transforms and names the signed axis
nearest to it. The buckets follow the number of rows: one full polytope, then a second and a third, the last of them reduced
to its first axes. A query visits the buckets of a table in the order of its squared gaps to the axes, so that close misses come
first. Number of tables and probes are fitted: for a bounded sample of queries the true neighbours are
found by an exact scan, and the cheapest pair that reaches the recall on them is taken. Every row is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.meeting import BLOCK, first_of, groups, matrix, meet, usable
from seriesmill.llm.work import Work

WANT = 5
#: Queries whose exact neighbours fit tables and probes, and the share of those neighbours to be found.
SAMPLE, RECALL = 256, 0.96
#: Rows of a bucket that the number of buckets aims at, and polytopes at most (beyond them buckets grow and are cut into blocks).
BUCKET, POLYTOPES = 256, 3
TABLES = (2, 4, 8, 16)
#: Cosines by matrix product and one by one agree within this; only closer ones are taken again one by one.
SLACK = 1e-9
#: A cosine in a bucket against a vector in a shuffle.
COMPARE_COST = 1 / 150
SEED = 11
#: Asks compared at once, and found rows gathered before a task combines them.
ASKS, GATHER = 256, 200_000


def shape(rows: int, dim: int) -> tuple[int, ...]:
    """Axes of each polytope for ``rows`` vectors of length ``dim``: twice their product is about rows / BUCKET buckets."""
    full, axes, buckets = 1 << max(0, dim - 1).bit_length(), [], 1
    while True:
        wanted = max(1.0, rows / BUCKET / buckets / 2)
        axes.append(min(full, 1 << max(0, int(np.ceil(np.log2(wanted))))))
        buckets *= 2 * axes[-1]
        if buckets * BUCKET >= rows or len(axes) == POLYTOPES:
            return tuple(axes)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix of their power-of-two length."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x


class Hashes:
    """Buckets of vectors of one length, and the order in which a query visits them."""

    def __init__(self, rows: int, dim: int) -> None:
        self.dim, self.axes = dim, shape(rows, dim)
        self.full = 1 << max(0, dim - 1).bit_length()
        self.buckets = int(np.prod([2 * a for a in self.axes]))
        self.signs: dict[tuple[int, int], np.ndarray] = {}

    def _gaps(self, x: np.ndarray, table: int) -> list[np.ndarray]:
        """Per polytope the squared gaps to all signed axes: first the negative ends, then the positive ones."""
        unit = np.zeros((len(x), self.full))
        unit[:, : self.dim] = unit_rows(x)
        out = []
        for part, axes in enumerate(self.axes):
            if (table, part) not in self.signs:
                self.signs[table, part] = np.random.default_rng([SEED, self.dim, table, part]).choice([-1.0, 1.0], (3, self.full))
            y = unit
            for flips in self.signs[table, part]:
                y = hadamard(y * flips) / np.sqrt(self.full)
            ends = np.concatenate([-y[:, :axes], y[:, :axes]], axis=1)
            out.append((ends.max(axis=1, keepdims=True) - ends) ** 2)
        return out

    def own(self, x: np.ndarray, table: int) -> np.ndarray:
        """Bucket of each row: its nearest signed axes."""
        code = np.zeros(len(x), np.int64)
        for gaps in self._gaps(x, table):
            code = code * gaps.shape[1] + gaps.argmin(axis=1)
        return code

    def probes(self, x: np.ndarray, table: int, count: int) -> np.ndarray:
        """The first ``count`` buckets of each row, nearest first."""
        count = min(count, self.buckets)
        gaps = self._gaps(x, table)
        order = [g.argsort(axis=1, kind="stable") for g in gaps]
        places = _staircase(count, tuple(g.shape[1] for g in gaps))
        total, code = np.zeros((len(x), len(places))), np.zeros((len(x), len(places)), np.int64)
        for part, g in enumerate(gaps):
            axis = order[part][:, places[:, part]]
            total += np.take_along_axis(g, axis, axis=1)
            code = code * g.shape[1] + axis
        first = total.argsort(axis=1, kind="stable")[:, :count]
        return np.take_along_axis(code, first, axis=1)

    def rank(self, query: np.ndarray, near: np.ndarray, table: int) -> np.ndarray:
        """How many buckets the query visits before those of each row of ``near``."""
        gaps = [g[0] for g in self._gaps(query[None, :], table)]
        code, total = self.own(near, table), np.zeros(len(near))
        for g in reversed(gaps):
            total += g[code % len(g)]
            code = code // len(g)
        rest = np.zeros(1)
        for g in gaps[1:]:
            rest = (rest[:, None] + g[None, :]).ravel()
        rest.sort()
        return np.searchsorted(rest, total[:, None] - gaps[0][None, :] - 1e-12).sum(axis=1)


@lru_cache(maxsize=8)
def _staircase(count: int, sizes: tuple[int, ...]) -> np.ndarray:
    """Places in the sorted gaps that can be among the ``count`` smallest sums: all places before them are, too."""
    tops = [range(min(s, count)) for s in sizes]
    if len(sizes) == 1:
        return np.array([(a,) for a in tops[0]])
    found = []
    for head in product(*tops[:-1]):
        room = count // int(np.prod([a + 1 for a in head]))
        found += [(*head, last) for last in range(min(room, len(tops[-1])))]
    return np.array(found)


def unit_rows(x: np.ndarray) -> np.ndarray:
    scaled = scaled_rows(x)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def scaled_rows(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no cosine and keeps their squares in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, the same whatever the other rows are."""
    a, b = scaled_rows(a), scaled_rows(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def nearest(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, vec_id: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, cosine) of the ``want`` nearest rows of each query; rows with the query's own id do not count."""
    unit, found = unit_rows(rows).T, []
    for at in range(0, len(queries), ASKS):
        score = unit_rows(queries[at : at + ASKS]) @ unit
        score[own[at : at + ASKS, None] == vec_id[None, :]] = -np.inf
        floor = -np.partition(-score, want - 1, axis=1)[:, want - 1] if score.shape[1] > want else np.full(len(score), -2.0)
        i, j = np.nonzero(score >= np.maximum(floor, -2.0)[:, None] - SLACK)
        exact = np.empty(len(i))
        for s in range(0, len(i), 1 << 16):
            exact[s : s + (1 << 16)] = cosines(queries[at + i[s : s + (1 << 16)]], rows[j[s : s + (1 << 16)]])
        keep = first_of(i, (-exact, vec_id[j], j), want)
        found.append((at + i[keep], j[keep], exact[keep]))
    return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


FOUND = "query long, query_id long, id long, vec_id long, score double"


def _found(parts: list[tuple[np.ndarray, ...]], want: int) -> pa.RecordBatch:
    """The first ``want`` different rows of each query among what a task gathered."""
    query, query_id, row, vec_id, score = (np.concatenate([p[k] for p in parts]) for k in range(5))
    _, first = np.unique(np.stack([query, row]), axis=1, return_index=True)
    keep = first[first_of(query[first], (-score[first], vec_id[first], row[first]), want)]
    return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (query, query_id, row, vec_id, score)], ["query", "query_id", "id", "vec_id", "score"])


def _compare(want: int):
    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for rows, asks in groups(parts):
            vec_id = rows.column("vec_id").to_numpy()
            asker, query_id = asks.column("id").to_numpy(), asks.column("vec_id").to_numpy()
            i, j, score = nearest(matrix(asks.column("vector")), query_id, matrix(rows.column("vector")), vec_id, want)
            gathered.append((asker[i], query_id[i], rows.column("id").to_numpy()[j], vec_id[j], score))
            size += len(i)
            if size > GATHER:
                gathered = [tuple(c.to_numpy() for c in _found(gathered, want).columns)]
                if len(gathered[0][0]) > GATHER // 2:
                    yield _found(gathered, want)
                    gathered = []
                size = len(gathered[0][0]) if gathered else 0
        if gathered:
            yield _found(gathered, want)

    return compare


def best(found: DataFrame, want: int) -> DataFrame:
    """The first ``want`` different rows of each query with their rank; a query has few found rows per task."""
    once = found.repartition("query").groupBy("query", "query_id", "id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= want)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = pa.compute.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        yield dim, batch.filter(pa.array(dims == dim))


def posts(rows: DataFrame, total: int, tables: int, probes: int, vectors: bool = True) -> DataFrame:
    """(key, kind, id, vec_id, vector) of each row once per table, of each query once per table and probe."""
    kind = rows.schema["vector"].dataType.simpleString()

    def post(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Hashes] = {}
        for part in parts:
            for dim, batch in _by_dim(part):
                hashes = known.setdefault(dim, Hashes(total, dim))
                for is_ask in (False, True):
                    some = batch.filter(pa.compute.equal(batch.column("kind"), int(is_ask)))
                    step = max(1, 65_536 // (probes if is_ask else 1))
                    for at in range(0, some.num_rows, step):
                        piece = some.slice(at, step)
                        x = matrix(piece.column("vector"))
                        for table in range(tables):
                            code = hashes.probes(x, table, probes) if is_ask else hashes.own(x, table)[:, None]
                            # a key also tells tables and lengths apart
                            key = (code * tables + table) * 65_536 + dim % 65_536
                            if not vectors:
                                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.full(key.size, int(is_ask), np.int32))], ["key", "kind"])
                                continue
                            rep = piece.take(pa.array(np.repeat(np.arange(len(x)), key.shape[1])))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(key.ravel()), *(rep.column(c) for c in ("kind", "id", "vec_id", "vector"))], ["key", "kind", "id", "vec_id", "vector"]
                            )

    return rows.select("kind", "id", "vec_id", "vector").mapInArrow(
        post, f"key long, kind int, id long, vec_id long, vector {kind}" if vectors else "key long, kind int"
    )


def counted(keys: DataFrame) -> DataFrame:
    return keys.groupBy("key").agg(F.count_if(F.col("kind") == 0).alias("rows"), F.count_if(F.col("kind") == 1).alias("asks"))


def fit(rows: DataFrame, total: int, queries: int, want: int, sample: int = SAMPLE, recall: float = RECALL) -> tuple[int, int]:
    """(tables, probes): the cheapest that finds ``recall`` of the true neighbours of a sample of queries.

    The sample holds at most ``sample`` queries, those with the smallest hash of their id; an exact scan of all rows finds their
    neighbours, each task keeping ``want`` per query.
    """
    asked = rows.filter("kind = 1").orderBy(F.xxhash64("vec_id", F.lit(SEED)), "id").limit(sample).select("id", "vec_id", "vector").collect()
    by_dim: dict[int, list] = {}
    for a in asked:
        by_dim.setdefault(len(a.vector), []).append(a)
    held = {d: (np.array([a.id for a in s]), np.array([a.vec_id for a in s]), np.array([a.vector for a in s], float)) for d, s in by_dim.items()}

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for dim, batch in _by_dim(part):
                if dim in held:
                    ids, own, x = held[dim]
                    vec_id = batch.column("vec_id").to_numpy()
                    i, j, score = nearest(x, own, matrix(batch.column("vector")), vec_id, want)
                    yield _found([(ids[i], own[i], batch.column("id").to_numpy()[j], vec_id[j], score)], want)

    true = best(rows.filter("kind = 0").select("id", "vec_id", "vector").mapInArrow(scan, FOUND), want).select("query", "id")
    near: dict[int, list] = {}
    for r in rows.filter("kind = 0").join(true, "id").select("query", "vector").collect():  # want x sample rows
        near.setdefault(r.query, []).append(r.vector)
    ranks = []
    for a in asked:
        if a.id in near:
            hashes, close = _hashes(total, len(a.vector)), np.array(near[a.id], float)
            ranks.append(np.stack([hashes.rank(np.array(a.vector, float), close, t) for t in range(max(TABLES))]))
    if not ranks:
        return TABLES[0], 1
    ranks = np.concatenate(ranks, axis=1)
    buckets = max(_hashes(total, d).buckets for d in by_dim)
    costs = {}
    for tables in TABLES:
        reached = np.sort(ranks[:tables].min(axis=0))
        probes = int(reached[min(len(reached) - 1, int(np.ceil(recall * len(reached))) - 1)]) + 1
        costs[tables, probes] = tables * (total + queries * probes * (1 + max(1, total / buckets) * COMPARE_COST))
    return min(costs, key=costs.get)


@lru_cache(maxsize=64)
def _hashes(total: int, dim: int) -> Hashes:
    return Hashes(total, dim)


def neighbours(vectors: DataFrame, work: Work, every: int = 50, want: int = WANT, block: int = BLOCK, probing: tuple[int, int] | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``want`` nearest found rows of each row of ``vectors`` (vec_id, embedding) whose id is divisible by ``every``.

    Score is the cosine in double precision of the original vectors; ties go to the smaller vec_id. A row takes no part when its
    vec_id is null or its vector is null, empty, zero or holds a null or non-finite component; vectors of different lengths
    are no neighbours. Rows that share a vec_id are rows of their own: each is searched when it is a query, and none finds
    another of that id. Of equal vectors only the ``want`` + 1 smallest ids can be in a result, so no more are indexed, and
    copies never fill a bucket; the limit is applied before the shuffle. A query that found fewer than it could is
    searched exactly, in blocks, against all rows of its length. An empty table gives no rows. ``probing`` overrides the
    fitted (tables, probes).
    """
    embedding = F.col("embedding")
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(embedding)).select("vec_id", embedding.alias("vector"))
    rows = work.settle(rows.withColumn("id", F.monotonically_increasing_id()), "vectors")
    copy = Window.partitionBy("vector").orderBy("vec_id", "id")
    few = rows.withColumn("copy", F.row_number().over(copy)).filter(F.col("copy") <= want + 1)
    asks = rows.filter(F.col("vec_id") % every == 0)
    of_kind = lambda df, k: df.select(F.lit(k).alias("kind"), "id", "vec_id", "vector")
    rows = work.settle(of_kind(few, 0).unionByName(of_kind(asks, 1)), "kinds")
    sizes = {r.kind: r.n for r in rows.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    total, queries = sizes.get(0, 0), sizes.get(1, 0)
    tables, probes = probing or fit(rows, total, queries, want)
    counts = counted(posts(rows, total, tables, probes, vectors=False))
    groups_ = meet(posts(rows, total, tables, probes), counts, work, block)
    found = work.settle(best(groups_.mapInArrow(_compare(want), FOUND), want), "found")
    # whoever found too few: every query that could name more rows of its length
    dim = F.size("vector").cast("long")
    lengths = rows.filter("kind = 0").groupBy(dim.alias("key")).agg(F.count("*").alias("n"))
    had = found.groupBy(F.col("query").alias("id")).agg(F.count("*").alias("had")).filter(F.col("had") == want)
    missing = rows.filter("kind = 1").join(had, "id", "left_anti").withColumn("key", dim)
    # its own row and those of its id aside, a length with one row has nothing to find
    missing = work.settle(missing.join(lengths.filter("n > 1"), "key").select("key", "kind", "id", "vec_id", "vector"), "missing")
    if not missing.isEmpty():
        there = missing.select("key").distinct()
        all_ = rows.filter("kind = 0").withColumn("key", dim).join(there, "key").select("key", "kind", "id", "vec_id", "vector").unionByName(missing)
        more = meet(all_, counted(all_), work, block).mapInArrow(_compare(want), FOUND)
        found = work.settle(best(found.drop("rank").unionByName(more), want), "found")
    return found.select("query_id", "rank", "vec_id", "score")
