"""Rows and asks that share a key, brought together in groups of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.simhash import whole_groups
from seriesmill.llm.work import Work

#: Rows, and asks, that meet in one group; longer lists are cut and every two blocks meet.
BLOCK = 4_096
GROUP = ("key", "row_block", "ask_block")


def meet(posts: DataFrame, counts: DataFrame, work: Work, block: int = BLOCK) -> DataFrame:
    """``posts`` (key, kind, id...) in groups (key, row_block, ask_block), sorted by group and kind.

    Kind 0 is a row, kind 1 an ask. ``counts`` holds (key, rows, asks) of the posts, or more keys. A key with more than ``block``
    of either is cut by a hash of the id: every block of its rows then meets every block of its asks in a group of its own, so
    no group grows with a hot key. Few keys are that long; their list is joined by the planner's choice, which checks its size.
    """
    hot = work.settle(counts.filter((F.col("rows") > block) | (F.col("asks") > block)), "hot-keys")
    is_row = F.col("kind") == 0
    if hot.isEmpty():
        cut = posts.withColumns({"row_block": F.lit(0), "ask_block": F.lit(0)})
    else:
        parts = lambda c: F.coalesce(F.ceil(F.col(c) / F.lit(block)).cast("int"), F.lit(1))
        cut = posts.join(hot, "key", "left").withColumns({"rows": F.greatest(parts("rows"), F.lit(1)), "asks": F.greatest(parts("asks"), F.lit(1))})
        cut = cut.withColumn("own", F.pmod(F.xxhash64("id", F.lit(5)), F.when(is_row, F.col("rows")).otherwise(F.col("asks"))).cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(is_row, F.col("asks")).otherwise(F.col("rows")) - 1)))
        cut = cut.withColumns(
            {"row_block": F.when(is_row, F.col("own")).otherwise(F.col("other")), "ask_block": F.when(is_row, F.col("other")).otherwise(F.col("own"))}
        ).drop("rows", "asks", "own", "other")
    return cut.repartition(*GROUP).sortWithinPartitions(*GROUP, "kind")


def groups(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, pa.Table]]:
    """(rows, asks) of each group that has both, from the sorted batches of ``meet``."""
    for table in whole_groups(parts, GROUP):
        cols = [table.column(c).to_numpy() for c in GROUP]
        new = np.zeros(table.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = np.concatenate(([0], np.flatnonzero(new), [table.num_rows]))
        kind = table.column("kind").to_numpy()
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            cut = s + int(np.searchsorted(kind[s:e], 1))
            if s < cut < e:
                yield table.slice(s, cut - s), table.slice(cut, e - cut)


def usable(vector: Column, zero: bool = False) -> Column:
    """Not null, not empty, without null or non-finite components, and unless ``zero`` not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & (F.size(vector) > 0)
    if not zero:
        fine = fine & F.exists(vector, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dtype: type = np.float64) -> np.ndarray:
    """Vectors of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def first_of(owner: np.ndarray, order: tuple[np.ndarray, ...], want: int) -> np.ndarray:
    """Places of the first ``want`` entries of each owner in the given order (most important first)."""
    by = np.lexsort((*reversed(order), owner))
    sorted_owner = owner[by]
    rank = np.arange(len(by)) - np.searchsorted(sorted_owner, sorted_owner, side="left")
    return by[rank < want]
