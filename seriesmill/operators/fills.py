"""Gap filling inside ordered series.

All fills share one pattern that keeps a long series from landing in a single task. The order
column is cut into blocks (months for dates). A first aggregate keeps, per block, the earliest
and latest known value, a second one the same per block of blocks. Windows over the blocks of one
group and over the groups of a series tell each block what lies before and after it. The two facts
join the block as marker rows, so the row-level windows run inside one block only. With blocks of
n rows and groups of n blocks, a task sees n rows, n blocks, or a series' length / n^2 groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

_SIDE, _BLOCK, _GROUP = "__side", "__block", "__group"
#: Number blocks that form one block of blocks.
BLOCKS = 4_096


def month_block(order: str) -> Column:
    """Block of a date or timestamp column."""
    return F.trunc(F.col(order), "MM")


def number_block(order: str, size: int) -> Column:
    """Block of an integer column: runs of ``size`` consecutive values."""
    return F.floor(F.col(order) / F.lit(size))


def _coarser(rows: DataFrame) -> Column:
    """Block of blocks: years of months, runs of numbers."""
    if isinstance(rows.schema[_BLOCK].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.trunc(F.col(_BLOCK), "YEAR")
    return F.floor(F.col(_BLOCK) / F.lit(BLOCKS))


def _ends(name: str, first: Column, last: Column, first_at: Column, last_at: Column) -> list[Column]:
    """Earliest and latest known value of a group; places and values are aggregates of their own, of fixed width."""
    pair = lambda at, v: F.when(at.isNotNull(), F.struct(at.alias("at"), v.alias("v")))
    return [
        pair(F.min(first_at), F.min_by(first, first_at)).alias(f"{name}__first"),
        pair(F.max(last_at), F.max_by(last, last_at)).alias(f"{name}__last"),
    ]


def _carried(edges: DataFrame, keys: Sequence[str], block: str, values: Sequence[str]) -> DataFrame:
    """``edges`` with ``b`` and ``a``: what the nearest blocks before and after hold, within ``keys``."""
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col(block).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(
        *keys,
        block,
        F.struct(*[F.last(f"{v}__last", ignorenulls=True).over(before).alias(v) for v in values]).alias("b"),
        F.struct(*[F.last(f"{v}__first", ignorenulls=True).over(after).alias(v) for v in values]).alias("a"),
    )


def with_anchors(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    block: Column | None = None,
) -> DataFrame:
    """Add ``<v>__prev`` and ``<v>__next`` structs (``at``, ``v``) for every value column.

    They hold the nearest known value at or before and at or after the row; both equal the row's
    own value where that is known. ``order`` should be unique within ``keys``.
    """
    block = month_block(order) if block is None else block
    known = {
        v: F.when(F.col(v).isNotNull(), F.struct(F.col(order).alias("at"), F.col(v).alias("v")))
        for v in values
    }
    rows = df.withColumns({_BLOCK: block, **{f"{v}__known": c for v, c in known.items()}})

    at = {v: F.when(F.col(v).isNotNull(), F.col(order)) for v in values}
    edges = rows.withColumn(_GROUP, _coarser(rows)).groupBy(*keys, _GROUP, _BLOCK).agg(
        *[c for v in values for c in _ends(v, F.col(v), F.col(v), at[v], at[v])]
    )
    # blocks of blocks first, then the blocks inside each: no window sees more than one of the two
    groups = edges.groupBy(*keys, _GROUP).agg(
        *[
            c for v in values for c in _ends(
                v, F.col(f"{v}__first.v"), F.col(f"{v}__last.v"), F.col(f"{v}__first.at"), F.col(f"{v}__last.at")
            )
        ]
    )
    outer = _carried(groups, keys, _GROUP, values).select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        F.col(_GROUP).alias("__of"), F.col("b").alias("outer_b"), F.col("a").alias("outer_a"),
    )
    same = F.col(_GROUP).eqNullSafe(F.col("__of"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{i}"))
    nearest = lambda side: F.struct(
        *[F.coalesce(F.col(f"{side}.{v}"), F.col(f"outer_{side}.{v}")).alias(v) for v in values]
    )
    inner = _carried(edges, [*keys, _GROUP], _BLOCK, values).join(outer, same)
    edges = inner.select(*keys, _BLOCK, nearest("b").alias("b"), nearest("a").alias("a"))
    # one marker sorts before the block's rows, one after them
    markers = edges.select(
        *keys,
        _BLOCK,
        F.explode(
            F.array(
                F.struct(F.lit(-1).alias("side"), F.col("b").alias("edge")),
                F.struct(F.lit(1).alias("side"), F.col("a").alias("edge")),
            )
        ).alias("m"),
    ).select(
        *keys,
        _BLOCK,
        F.col("m.side").alias(_SIDE),
        *[F.col(f"m.edge.{v}").alias(f"{v}__known") for v in values],
    )
    merged = rows.withColumn(_SIDE, F.lit(0)).unionByName(markers, allowMissingColumns=True)
    forward = Window.partitionBy(*keys, _BLOCK).orderBy(_SIDE, order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    backward = Window.partitionBy(*keys, _BLOCK).orderBy(
        F.col(_SIDE).desc(), F.col(order).desc()
    ).rowsBetween(Window.unboundedPreceding, 0)
    return (
        merged.select(
            *df.columns,
            _SIDE,
            *[F.last(f"{v}__known", True).over(forward).alias(f"{v}__prev") for v in values],
            *[F.last(f"{v}__known", True).over(backward).alias(f"{v}__next") for v in values],
        )
        .where(F.col(_SIDE) == 0)
        .drop(_SIDE)
    )


def _replace(df: DataFrame, columns: Sequence[str], new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in columns])


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    block: Column | None = None,
) -> DataFrame:
    """Last earlier known value; leading nulls stay null."""
    anchored = with_anchors(df, keys, order, values, block)
    return _replace(anchored, df.columns, {v: F.col(f"{v}__prev.v") for v in values})


def neighbor_mean_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[str],
    cascade: bool = False,
    block: Column | None = None,
) -> DataFrame:
    """Null becomes the mean of the previous and next known value, or the one that exists.

    With ``cascade`` a null also blanks the columns to its right in the same row, before any
    neighbour is looked up.
    """
    masked = df
    if cascade:
        gap, new = F.lit(False), {}
        for v in values:
            gap = gap | F.col(v).isNull()
            new[v] = F.when(~gap, F.col(v))
        masked = _replace(df, df.columns, new)
    anchored = with_anchors(masked, keys, order, values, block)
    filled = {}
    for v in values:
        prev, nxt = F.col(f"{v}__prev.v"), F.col(f"{v}__next.v")
        filled[v] = F.coalesce(F.col(v), (prev + nxt) / 2, prev, nxt)
    return _replace(anchored, df.columns, filled)


def densify_daily(
    df: DataFrame, keys: Sequence[str], date: str, start: str | None = None
) -> DataFrame:
    """Add the missing calendar days between the rows of each series, other columns null.

    Every row emits the days up to its successor, so no calendar is built and nothing is joined.
    Rows that repeat a day all stay; the gap after them is filled once. Days before ``start`` are not added.
    """
    after = Window.partitionBy(*keys).orderBy(date)
    # a successor on the same day leaves no gap
    last_day = F.greatest(F.date_sub(F.lead(date).over(after), 1), F.col(date))
    if start is not None:
        last_day = F.when(last_day >= F.lit(start).cast("date"), last_day).otherwise(F.col(date))
    days = df.withColumn("__last", last_day).withColumn(
        "__day", F.explode(F.sequence(F.col(date), F.col("__last")))
    )
    if start is not None:
        days = days.where((F.col("__day") == F.col(date)) | (F.col("__day") >= F.lit(start).cast("date")))
    own = F.col("__day") == F.col(date)
    return days.select(
        *[
            F.col("__day").alias(c) if c == date
            else F.col(c) if c in keys
            else F.when(own, F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def linear_interpolate(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    values: Sequence[str],
    start: str | None = None,
) -> DataFrame:
    """Densify to days, then put unknown values on the line between their known neighbours."""
    dense = densify_daily(df, keys, date, start)
    anchored = with_anchors(dense, keys, date, values)
    filled = {}
    for v in values:
        prev, nxt = F.col(f"{v}__prev"), F.col(f"{v}__next")
        step = F.datediff(F.col(date), prev["at"]) / F.datediff(nxt["at"], prev["at"])
        inside = prev["v"] + (nxt["v"] - prev["v"]) * step
        known = F.col(v).isNotNull()
        gap = F.when(prev["at"] < nxt["at"], inside)
        filled[v] = F.when(known, F.col(v)).otherwise(gap)
    return _replace(anchored, dense.columns, filled)
