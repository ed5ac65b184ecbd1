"""Best-fit packing of token sequences by exact-complement hashing.

Pieces are packed by length, not one by one: a table of (length, pieces) has at most as many rows as a
sequence has tokens, whatever the corpus holds, so the plan is made on it alone. The plan hashes the
sums of single lengths, pairs and triples; for each length, longest first, a combination that fills
the gap exactly is consumed as often as the counts allow. What finds no exact complement is placed
by best fit. A plan step says "this many sequences hold these lengths"; pieces, ranked within their length
by a distributed count, then look up their step, sequence and offset.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm import tokens
from seriesmill.llm.work import Work

CAPACITY = 2_048
#: Id put after each document.
END_ID = 0


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full pieces, the first one may be shorter."""
    first = n - (n - 1) // capacity * capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, vocabulary: str, work: Work, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, task, local_rank (and ids, on demand).

    ``local_rank`` counts the pieces of one length within the task that made them, from 0; it is
    written with the piece, so that a repeated task gives the same numbers.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4").tobytes()
        for part in parts:
            texts = part.column("text")
            rows, owner = [], []
            for at, found in enumerate(tokens.encode_all((t.as_py() or "" for t in texts), vocabulary)):
                ids = found + end
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((number, start, length, zlib.crc32(own), task, seen[length], own if with_ids else None))
                    owner.append(at)
                    seen[length] += 1
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [part.column("doc_id").take(pa.array(owner, pa.int64()))] + [pa.array(c, k) for c, k in zip(cols, kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "local_rank"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in cols[6]], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, local_rank long"
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return work.settle(rows.mapInArrow(batches, schema + (", ids array<long>" if with_ids else "")), "pieces")


class _Sums:
    """Lengths, pairs and triples by their sum; entries whose counts have run out are passed over."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        there = counts > 0
        there[:1] = False
        lengths = np.flatnonzero(there).astype(np.int32)
        #: Per sum the larger lengths, longest first; made sum by sum, so that no table of all pairs is held.
        self.pairs: dict[int, np.ndarray] = {}
        for total in range(2, len(counts)):
            larger = lengths[np.searchsorted(lengths, (total + 1) // 2) : np.searchsorted(lengths, total)][::-1]
            larger = larger[there[total - larger]]
            if len(larger):
                self.pairs[total] = larger

    def _pair(self, total: int) -> tuple[int, int] | None:
        larger = self.pairs.get(total)
        if larger is None:
            return None
        c = self.counts
        fits = (c[larger] > 0) & (c[total - larger] > 0) & ((2 * larger != total) | (c[larger] > 1))
        at = int(np.argmax(fits))
        return (int(larger[at]), int(total - larger[at])) if fits[at] else None

    def fill(self, gap: int) -> tuple[int, ...] | None:
        """Up to three available lengths that fill ``gap`` exactly, the fewest and longest first."""
        c = self.counts
        if c[gap] > 0:
            return (gap,)
        pair = self._pair(gap)
        if pair:
            return pair
        for a in np.flatnonzero(c[: max(gap - 1, 0)])[::-1].tolist():
            c[a] -= 1
            rest = self._pair(gap - a)
            c[a] += 1
            if rest:
                return (a, *rest)
        return None


def plan(counts: np.ndarray) -> list[tuple[int, dict[int, int]]]:
    """Steps (sequences, {length: times in each}) that use up ``counts``; counts[n] pieces have length n."""
    c = counts.astype(np.int64).copy()
    capacity = len(c) - 1
    steps: list[tuple[int, dict[int, int]]] = []
    if c[capacity]:
        steps.append((int(c[capacity]), {capacity: 1}))
        c[capacity] = 0
    sums, alone = _Sums(c), np.zeros_like(c)
    for length in range(capacity - 1, 0, -1):
        while c[length]:
            c[length] -= 1
            others = sums.fill(capacity - length)
            c[length] += 1
            if others is None:
                alone[length], c[length] = c[length], 0
                break
            need: dict[int, int] = defaultdict(int)
            for x in (length, *others):
                need[x] += 1
            times = min(int(c[x]) // k for x, k in need.items())
            for x, k in need.items():
                c[x] -= times * k
            steps.append((times, dict(need)))
    return steps + _best_fit(alone, capacity)


def _best_fit(c: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit, longest first, for many pieces of a length at a time: into the fullest sequences that still take it."""
    open_at: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)
    gaps = np.zeros(capacity + 1, np.int64)
    for length in np.flatnonzero(c)[::-1].tolist():
        left = int(c[length])
        while left:
            fitting = np.flatnonzero(gaps[length:])
            if len(fitting):
                gap = int(fitting[0]) + length
                have, inside = open_at[gap].pop()
                gaps[gap] -= have
                each = min(gap // length, max(1, left // have))
                used = min(have, left // each)
                if used < have:
                    open_at[gap].append((have - used, inside))
                    gaps[gap] += have - used
            else:
                each = min(capacity // length, left)
                gap, used, inside = capacity, left // each, {}
            rest = gap - each * length
            open_at[rest].append((used, inside | {length: inside.get(length, 0) + each}))
            gaps[rest] += used
            left -= used * each
    return [step for steps in open_at.values() for step in steps]


def slots(steps: list[tuple[int, dict[int, int]]]) -> pd.DataFrame:
    """Where the pieces of a length go: from rank ``first`` on, ``times`` in each sequence from ``sequence`` on, at ``offset``."""
    used, sequence, out = defaultdict(int), 0, []
    for count, inside in steps:
        offset = 0
        for length, times in inside.items():
            out.append((length, used[length], times, sequence, offset))
            used[length] += count * times
            offset += times * length
        sequence += count
    table = pd.DataFrame(out, columns=["length", "first", "times", "sequence", "offset"], dtype="int64")
    return table.sort_values(["length", "first"], ignore_index=True)


def place(pieces: DataFrame, work: Work, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (length, task, local_rank, ...) with ``sequence_id`` and ``offset``.

    The driver sees one row per length, at most ``capacity``. The plan's slots, a few per step,
    are bounded by the same number and go to every task. Ranks before a task are joined by (length, task), of which
    no key holds more than one task's pieces.
    """
    per_task = work.settle(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row.length] = row.n
    table = slots(plan(counts))
    shared = pieces.sparkSession.sparkContext.broadcast({k: table[k].to_numpy() for k in table})
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = work.settle(per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "bases")
    # bases grow with the tasks: merged, never broadcast
    ranked = pieces.join(base.hint("merge"), ["length", "task"]).withColumn("rank", F.col("base") + F.col("local_rank")).drop("base", "task", "local_rank")
    names = [*ranked.columns]

    def look_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        lengths, firsts = t["length"], t["first"]
        span = int(firsts.max(initial=0)) + 1
        key = lengths * span + firsts
        for part in parts:
            length, rank = part.column("length").to_numpy(), part.column("rank").to_numpy()
            at = np.searchsorted(key, length * span + np.minimum(rank, span - 1), side="right") - 1
            into = rank - firsts[at]
            times = t["times"][at]
            sequence = t["sequence"][at] + into // times
            offset = t["offset"][at] + into % times * length
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    return ranked.mapInArrow(look_up, schema + ", sequence_id long, offset long").drop("rank")


def pack(docs: DataFrame, vocabulary: str, work: Work, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece of each row of ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the single end id. Only documents longer than a sequence are cut. Rows
    that repeat are packed each for itself, an empty table gives no rows, other columns are not
    read. ``with_ids`` adds the ids of the piece; the ids of a sequence are its pieces by offset.
    """
    return place(tokenized_pieces(docs, vocabulary, work, capacity, with_ids), work, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences (sequence_id, ids) of pieces packed ``with_ids``."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(pieces, lambda p: p["ids"])).alias("ids"))
