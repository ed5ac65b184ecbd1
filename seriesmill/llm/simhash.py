"""Near duplicates by SimHash, found through a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so at
least 5 positional bytes are shared. Of 5 shared positions, 3 lie in the first or in the last four
bytes: the index therefore posts each fingerprint under the 4 + 4 triples of positions within
a half, and a pair that qualifies meets under at least one triple. Pairs that meet have their
shared positional bytes tallied, stay when the tally reaches 5, and are verified by their bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.graph import components
from seriesmill.llm.sift import sift
from seriesmill.llm.work import Work, whole_row

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Postings that are compared in one task; longer posting lists are cut into blocks, and blocks are paired.
BLOCK = 1_024
SEED = 42


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """SimHash of one text as an unsigned number; no words give 0."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space divides
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    ends = (ends[width - 1 :] - 1).tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])], np.uint64)
        total += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(starts))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, extra: tuple[Column, ...] = ()) -> DataFrame:
    """(doc_id, rid, fp, extra...) per row of ``docs``: fp as a signed long, rid a number of the row."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    text = F.col("text").cast("string")
    return docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), fp(text).alias("fp"), *extra)


def _position_keys() -> list:
    """The index keys of a fingerprint: number of the triple, then its three bytes."""
    keys = []
    for number, triple in enumerate([t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]):
        parts = [F.shiftleft(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255).cast("long")), 8 * i) for i, p in enumerate(triple)]
        keys.append(parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]).bitwiseOR(F.lit(number << 24).cast("long")))
    return keys


def linked_in_groups(code: np.ndarray, group: np.ndarray, block: np.ndarray, same: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that qualify; rows are sorted by group. Across two blocks only mixed pairs count."""
    last = np.searchsorted(group, group, side="right") - 1
    left, step, found = np.arange(len(code)), 0, []
    while True:
        step += 1
        left = left[left + step <= last[left]]
        if not len(left):
            break
        i, j = left, left + step
        keep = same[i] | (block[i] != block[j])
        i, j = i[keep], j[keep]
        diff = code[i] ^ code[j]
        shared = (diff.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # tally of shared positional bytes
        pair = shared >= 8 - max_bits
        pair[pair] = np.bitwise_count(diff[pair].view(np.uint64)) <= max_bits  # of signed numbers it would count the absolute value
        found.append((i[pair], j[pair]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that each of ``n`` rows reaches by the links i-j."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def whole_groups(parts: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Sorted batches again as tables that never divide a group; a group is held back until it is complete."""
    held = None
    for part in parts:
        table = pa.Table.from_batches([part])
        if held is not None:
            table = pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        cols = [table.column(k).to_numpy() for k in keys]
        differs = np.zeros(table.num_rows, bool)
        for c in cols:
            differs |= c != c[-1]
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held


def in_blocks(postings: DataFrame, work: Work, item: str, block: int = BLOCK) -> DataFrame:
    """``postings`` (key, item...) that share their key, with the pair of blocks (lo, hi) in which they are compared.

    Keys of one posting go. A list longer than ``block`` is cut by a hash of the item, and every
    two blocks of a list meet in a group of their own: no group is larger than about two blocks.
    """
    sizes = work.settle(postings.groupBy("key").agg(F.count("*").alias("posted")).filter("posted > 1"), "posting-sizes")
    rows = postings.join(sizes, "key")
    blocks = F.ceil(F.col("posted") / F.lit(block)).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64(item, F.lit(3)), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("posted", "other")


def near_pairs(codes: DataFrame, work: Work, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between different fingerprints ``fp``, enough of them to connect all that are within ``max_bits``.

    ``codes`` holds each fingerprint once. Links found in a group are thinned to a forest before they leave the task.
    """
    if max_bits > 3:
        raise ValueError("the position triples guarantee a meeting up to 3 bits only")
    postings = codes.select("fp", F.explode(F.array(*_position_keys())).alias("key"))
    rows = in_blocks(postings, work, "fp", block)
    rows = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(parts, ("key", "lo", "hi")):
            code = table.column("fp").to_numpy()
            key, lo, hi, own = (table.column(c).to_numpy() for c in ("key", "lo", "hi", "own"))
            new = np.ones(len(code), bool)
            new[1:] = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            i, j = linked_in_groups(code, np.cumsum(new), own, lo == hi, max_bits)
            root = spanning(len(code), i, j)
            moved = np.flatnonzero(root != np.arange(len(code)))
            yield pa.RecordBatch.from_arrays([pa.array(code[moved]), pa.array(code[root[moved]])], ["a", "b"])

    return rows.mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, work: Work, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, extra: tuple[Column, ...] = (), block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint, component_id, kept, and the ``extra`` columns.

    Rows link when their fingerprints differ in at most ``max_bits`` bits. A null text is empty, a
    text without words has fingerprint zero, rows that repeat fall into one component, and of each
    component one row is kept: one of those with the smallest doc_id. Empty tables give no rows. Equal
    fingerprints are one node, counted before any shuffle, so copies are never paired.
    """
    rows = work.settle(fingerprints(docs, width, extra), "fingerprints")
    first = rows.groupBy("fp", "doc_id").agg(F.min("rid").alias("rid")).groupBy("fp")
    codes = work.settle(first.agg(F.min("doc_id").alias("doc_id"), F.coalesce(F.min_by("rid", "doc_id"), F.min("rid")).alias("rid")), "codes")
    links = work.settle(near_pairs(codes.select("fp"), work, max_bits, block), "pairs")
    roots = components(links, work)
    classes = codes.join(roots, codes.fp == roots.node, "left").select("fp", "doc_id", "rid", F.coalesce("root", "fp").alias("root"))
    classes = work.settle(classes, "classes")
    heads = classes.groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.coalesce(F.min_by("rid", "doc_id"), F.min("rid")).alias("keep_rid")
    )
    members = work.settle(classes.select("fp", "root").join(heads, "root").drop("root"), "members")
    return rows.join(members, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        (F.col("rid") == F.col("keep_rid")).alias("kept"),
        *(c for c in rows.columns if c not in ("doc_id", "rid", "fp")),
    )


def keep_one(docs: DataFrame, work: Work, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the first by doc_id, all columns kept.

    Decisions are looked up by doc_id and text, by a join of only those rows that a bitmap of the changed ones may name; rows
    that repeat both are grouped once more, and only these.
    """
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("mark")
    found = near_duplicates(docs.select("doc_id", "text"), work, width, max_bits, extra=(mark,))
    per_row = work.settle(found.select("doc_id", "mark", "kept"), "decisions").groupBy(F.col("doc_id").alias("of_id"), F.col("mark").alias("of_mark"))
    changes = per_row.agg(F.count("*").alias("n"), F.max("kept").alias("kept")).filter("NOT kept OR n > 1")
    changes = work.settle(changes, "changes")
    again = changes.filter("kept")
    rows = docs.select(whole_row(docs), F.col("doc_id").alias("id"), mark)
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark"))
    rest, maybe = sift(rows, F.col("mark"), changes, "of_mark")
    kept = rest.select("row.*").unionByName(maybe.join(changes.drop("kept", "n"), same, "left_anti").select("row.*"))
    if again.isEmpty():
        return kept
    twice = maybe.join(again.drop("kept", "n"), same, "left_semi")
    return kept.unionByName(twice.dropDuplicates(["id", "mark"]).select("row.*"))
