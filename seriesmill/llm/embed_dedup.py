"""Near duplicates among embeddings: random-hyperplane sign hashing in several tables, exact cosines, components.

Each table hashes a vector to the signs of its products with ``bits`` random normals. Two vectors at angle a
share one sign with probability 1 - a / pi. The bits grow with the logarithm of the number of
vectors, so that a bucket of unrelated vectors keeps its size, and the tables follow from the
recall asked for at the threshold itself; closer pairs are found more surely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.graph import components
from seriesmill.llm.simhash import BLOCK, in_blocks, spanning, whole_groups
from seriesmill.llm.work import Work

THRESHOLD = 0.9
#: Share of the pairs exactly at the threshold that at least one table brings together.
RECALL = 0.995
#: Unrelated vectors that share a bucket, as a power of two.
BUCKET_BITS = 5
#: Pairs whose cosines are taken at once.
PAIRS = 1 << 17


def tables_for(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits per table and number of tables."""
    bits = max(4, math.ceil(math.log2(max(2, vectors))) - BUCKET_BITS)
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def usable(embedding: Column) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    fine = lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)
    return F.coalesce(F.forall(embedding, fine) & F.exists(embedding, lambda x: x != 0), F.lit(False))


def hyperplanes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([dim, 17]).standard_normal((tables * bits, dim)).T


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    return column.combine_chunks().values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim) if isinstance(
        column, pa.ChunkedArray
    ) else column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def postings(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """(key, cid, n, vector, signs) of each class once per table; ``signs`` holds the hashes of all tables."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits, dtype=np.int64)
        for part in parts:
            dims = pa.compute.list_value_length(part.column("vector")).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                rows = part.filter(pa.array(dims == dim))
                x = _matrix(rows.column("vector"), dim)
                if dim not in planes:
                    planes[dim] = hyperplanes(dim, bits, tables)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                signs = ((x @ planes[dim] > 0).reshape(len(x), tables, bits) * powers).sum(axis=2)
                # a table's key also tells vectors of different lengths apart
                keys = (signs * tables + np.arange(tables)) * 65_536 + dim % 65_536
                packed = [s.astype(np.int32).tobytes() for s in signs]
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[:, t]), rows.column("cid"), rows.column("n"), rows.column("vector"), pa.array(packed, pa.binary())],
                        ["key", "cid", "n", "vector", "signs"],
                    )

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("cid", "n", "vector").mapInArrow(batches, f"key long, cid long, n long, vector {kind}, signs binary")


def _links(table: pa.Table, tables: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one bucket whose cosine reaches the threshold and that no earlier table brings together."""
    key, lo, hi, own = (table.column(c).to_numpy() for c in ("key", "lo", "hi", "own"))
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    group = np.cumsum(new)
    last = np.searchsorted(group, group, side="right") - 1
    number = key // 65_536 % tables
    signs = np.frombuffer(b"".join(table.column("signs").to_pylist()), np.int32).reshape(-1, tables)
    lengths = pa.compute.list_value_length(table.column("vector")).to_numpy()
    vectors: dict[int, np.ndarray] = {}
    place = np.empty(len(key), np.int64)
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        x = _matrix(table.column("vector").take(pa.array(rows)), dim)
        vectors[dim] = x / np.linalg.norm(x, axis=1, keepdims=True)
        place[rows] = np.arange(len(rows))
    upto = np.arange(tables)
    left, step, found = np.arange(len(key)), 0, [(np.empty(0, np.int64),) * 2]
    while True:
        step += 1
        left = left[left + step <= last[left]]
        if not len(left):
            break
        for at in range(0, len(left), PAIRS):
            i = left[at : at + PAIRS]
            j = i + step
            keep = ((lo[i] == hi[i]) | (own[i] != own[j])) & (lengths[i] == lengths[j])
            i, j = i[keep], j[keep]
            for dim, x in vectors.items():
                here = lengths[i] == dim
                a, b = i[here], j[here]
                near = np.einsum("ij,ij->i", x[place[a]], x[place[b]]) >= threshold
                a, b = a[near], b[near]
                met = ((signs[a] == signs[b]) & (upto < number[a][:, None])).any(axis=1)
                # a pair that met before is counted there, and linked there
                found.append((a[~met], b[~met]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_links(classes: DataFrame, work: Work, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(a, b, links): links of class ``a`` found in one bucket, counted in vectors, and a class ``b`` that it reaches there.

    Pairs are verified and counted in their bucket, in the first table that brings them together;
    what leaves a task grows with the bucket, not with its pairs.
    """
    bits, tables = tables_for(classes.count(), threshold, recall)
    rows = in_blocks(work.settle(postings(classes, bits, tables), "postings"), work, "cid", block)
    rows = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(parts, ("key", "lo", "hi")):
            cid, n = table.column("cid").to_numpy(), table.column("n").to_numpy()
            i, j = _links(table, tables, threshold)
            links = np.zeros(len(cid), np.int64)
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            root, some = spanning(len(cid), i, j), np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(cid[some]), pa.array(cid[root[some]]), pa.array(links[some])], ["a", "b", "links"])

    return rows.mapInArrow(compare, "a long, b long, links long")


def near_duplicates(vectors: DataFrame, work: Work, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Equal vectors are one class, counted before any shuffle; the links of a vector are the vectors
    of the classes it links with and the others of its own. Vectors that are null, empty, zero or hold
    a null or non-finite component, and vectors of different lengths, link with nothing. Rows that repeat a vec_id are
    vectors of their own; a null vec_id is never the smallest. An empty table gives no rows.
    """
    rows = work.settle(
        vectors.select(
            "vec_id",
            F.when(usable(F.col("embedding")), F.col("embedding")).alias("vector"),
        ),
        "vectors",
    )
    grouped = rows.filter("vector IS NOT NULL").groupBy("vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    classes = work.settle(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    links = work.settle(near_links(classes, work, threshold, recall, block), "links")
    roots = components(links.select("a", "b"), work)
    counts = links.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    known = (
        classes.join(counts, "cid", "left")
        .join(roots, classes.cid == roots.node, "left")
        .select("cid", "vector", "first", F.coalesce("root", "cid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    known = work.settle(known, "known")
    heads = known.groupBy("root").agg(F.min("first").alias("component_id"))
    members = work.settle(known.join(heads, "root").select("vector", "n_links", "component_id"), "members")
    linked = rows.filter("vector IS NOT NULL").join(members, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.filter("vector IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
