"""Medians, modes and moments of the training part of every fold of every horizon, in shared passes.

Expanding folds nest: the training months of a fold are those of the one before and some more. Rows therefore carry the segment
of their month (how many folds' training parts end before it), every aggregate is grouped by segment, and a fold is the sum
of the segments up to it. The number of passes over the data does not depend on the number of folds or horizons.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from seriesmill.operators import folds, roles
from seriesmill.operators.features import AGGREGATES

#: Parts into which a pass cuts the range of a wanted rank.
PARTS = 32


@dataclass(frozen=True)
class FoldPlan:
    """Fold bounds per horizon: (fold, last training month, first and last validation month)."""

    task: str
    bounds: dict[int, list[tuple]]

    def keys(self) -> list[tuple[int, int]]:
        return [(h, b[0]) for h, found in self.bounds.items() for b in found]


def plan_folds(panel: DataFrame, task: str, horizons: Sequence[int], *split) -> FoldPlan:
    """Bounds of the folds of each horizon over the months with a known label; horizons without a fold are left out."""
    r, bounds = roles.infer_roles(panel), {}
    for h in horizons:
        labelled = panel.where(F.col(roles.label_name(task, h)).isNotNull())
        try:
            bounds[h] = folds.fold_bounds(folds.expanding_folds(labelled, r.date, *split))
        except ValueError:
            continue
    return FoldPlan(task, bounds)


def fold_rows(panel: DataFrame, plan: FoldPlan, r: roles.Roles) -> DataFrame:
    """Panel features once per horizon with a known label: horizon, segment, folds that validate the row, y, ids and features.

    A row of segment s trains the folds numbered s + 1 and higher.
    """
    month = F.trunc(r.date, "MM")
    parts = []
    for h, bounds in plan.bounds.items():
        label = F.col(roles.label_name(plan.task, h)).cast("double")
        ended = [F.when(month > F.lit(b[1]), 1).otherwise(0) for b in bounds]
        held = F.filter(F.array(*[F.when(month.between(F.lit(b[2]), F.lit(b[3])), F.lit(b[0])) for b in bounds]), lambda x: x.isNotNull())
        part = F.struct(F.lit(h).alias("horizon"), sum(ended[1:], ended[0]).alias("segment"), held.alias("held"), label.alias("y"))
        parts.append(F.when(label.isNotNull() & month.isNotNull(), part))
    if not parts:
        raise ValueError("not enough months for a time split; lower min_train")
    each = panel.select(*r.ids, *r.features, F.explode(F.array(*parts)).alias("__part")).where("__part IS NOT NULL")
    return each.select("__part.*", *r.ids, *r.features)


def _grouped(rows: DataFrame, brackets: Sequence[tuple]) -> dict[int, dict[int, list]]:
    """Per bracket (column, low, high) and part in order: [smallest, largest, {(horizon, segment): values}]."""
    cells = []
    for i, (c, low, high) in enumerate(brackets):
        v, part = f"CAST(`{c}` AS DOUBLE)", "0"
        if low is not None:
            share = f"({v} / 2 - {low / 2!r}D) / {high / 2 - low / 2!r}D" if high / 2 > low / 2 else f"IF({v} > {low!r}D, 1D, 0D)"
            inside = f"{v} BETWEEN {low!r}D AND {high!r}D"
            part = f"IF({inside}, CAST(floor(least({share}, 1D) * {PARTS - 1}) AS INT), 0)"
            v = f"IF({inside}, {v}, NULL)"
        cells.append(f"named_struct('i', {i}, 'part', {part}, 'v', {v})")
    out: dict[int, dict[int, list]] = {}
    for at in range(0, len(cells), AGGREGATES):
        found = (
            rows.selectExpr("horizon", "segment", f"inline(array({', '.join(cells[at : at + AGGREGATES])}))")
            .where("abs(v) < double('infinity')")
            .groupBy("i", "part", "horizon", "segment")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()
        )
        for x in found:
            seen = out.setdefault(x["i"], {}).setdefault(x["part"], [x["low"], x["high"], {}])
            seen[0], seen[1] = min(seen[0], x["low"]), max(seen[1], x["high"])
            seen[2][x["horizon"], x["segment"]] = x["n"]
    return {i: dict(sorted(parts.items())) for i, parts in out.items()}


def _in_fold(counts: dict, horizon: int, fold: int) -> int:
    return sum(n for (h, s), n in counts.items() if h == horizon and s < fold)


def fold_medians(rows: DataFrame, columns: Sequence[str], keys: Sequence[tuple[int, int]]) -> dict[tuple[int, int], dict[str, float]]:
    """Exact median per (horizon, fold) and column over the training rows; columns without a finite value are left out.

    ``rows`` as by ``fold_rows``, written: they are read several times. Values are counted, never gathered. All folds share the
    ranges that a pass cuts, so a pass looks at few ranges more than for one fold.
    """
    names = list(columns)
    extent = _grouped(rows, [(c, None, None) for c in names])
    open_: dict[tuple, tuple] = {}
    ranks: dict[tuple, tuple[int, int]] = {}
    for i, parts in extent.items():
        low, high, counts = parts[0]
        for h, f in keys:
            n = _in_fold(counts, h, f)
            if n:
                ranks[names[i], h, f] = ((n - 1) // 2, n // 2)
                for rank in ranks[names[i], h, f]:
                    open_[names[i], h, f, rank] = (0, low, high)
    value: dict[tuple, float] = {}
    while open_:
        value |= {k: low for k, (_, low, high) in open_.items() if low == high}
        open_ = {k: v for k, v in open_.items() if v[1] < v[2]}
        brackets = sorted({(k[0], low, high) for k, (_, low, high) in open_.items()})
        parts = _grouped(rows, brackets) if brackets else {}
        place = {b: i for i, b in enumerate(brackets)}
        for (c, h, f, rank), (below, low, high) in open_.items():
            for first, last, counts in parts.get(place[c, low, high], {}).values():
                n = _in_fold(counts, h, f)
                if rank < below + n:
                    open_[c, h, f, rank] = (below, first, last)
                    break
                below += n
            else:
                raise RuntimeError(f"values of {c} changed between two passes: write the rows first")
    out: dict[tuple[int, int], dict[str, float]] = {k: {} for k in keys}
    for (c, h, f), (a, b) in ranks.items():
        out[h, f][c] = (value[c, h, f, a] + value[c, h, f, b]) / 2
    return out


def fold_modes(rows: DataFrame, columns: Sequence[str], plan: FoldPlan) -> DataFrame:
    """(horizon, fold, c, v, n): most frequent text of each column over the training rows, ties to the smallest.

    Texts are counted per segment before any shuffle; nothing but the winners is left at the end.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])
    counts = (
        rows.select("horizon", "segment", F.explode(cells).alias("s"))
        .where("s.v IS NOT NULL")
        .groupBy("horizon", "segment", "s.c", "s.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    last = F.element_at(F.create_map(*[F.lit(x) for h, b in plan.bounds.items() for x in (h, len(b))]), F.col("horizon"))
    each = counts.where(F.col("segment") < last).withColumn("fold", F.explode(F.sequence(F.col("segment") + 1, last)))
    summed = each.groupBy("horizon", "fold", "c", "v").agg(F.sum("n").alias("n"))
    best = summed.groupBy("horizon", "fold", "c").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("b"))
    return best.select("horizon", "fold", "c", "b.v", (-F.col("b.n")).alias("n"))


def fold_moments(rows: DataFrame, medians: dict[tuple[int, int], dict[str, float]]) -> dict[tuple[int, int], dict[str, tuple[float, float]]]:
    """(mean, population deviation) per (horizon, fold) and column with nulls filled by the fold's median; zero deviation counts as one.

    Sums are taken around one value per column, so that a far mean costs no digits.
    """
    names = sorted({c for found in medians.values() for c in found})
    sums: dict[tuple, tuple] = {}
    for at in range(0, len(names), AGGREGATES):
        some = names[at : at + AGGREGATES]
        fine = {c: f"IF(abs(CAST(`{c}` AS DOUBLE)) < double('infinity'), CAST(`{c}` AS DOUBLE), NULL)" for c in some}
        near = rows.agg(*[F.avg(F.expr(fine[c])).alias(f"m{i}") for i, c in enumerate(some)]).first()
        aggs = []
        for i, c in enumerate(some):
            d = f"({fine[c]} - {near[i] or 0.0!r}D)"
            aggs += [F.expr(f"count({fine[c]})"), F.expr(f"sum({d})"), F.expr(f"sum({d} * {d})")]
        for x in rows.groupBy("horizon", "segment").agg(F.count(F.lit(1)).alias("rows"), *aggs).collect():
            for i, c in enumerate(some):
                sums[c, x[0], x[1]] = (near[i] or 0.0, x[2], *(x[3 + 3 * i + k] or 0.0 for k in range(3)))
    out: dict[tuple[int, int], dict[str, tuple[float, float]]] = {}
    for (h, f), known in medians.items():
        for c, median in known.items():
            found = [v for (name, horizon, s), v in sums.items() if name == c and horizon == h and s < f]
            near, rows_, n = found[0][0], sum(v[1] for v in found), sum(v[2] for v in found)
            gap, fill = rows_ - n, median - found[0][0]
            mean = (sum(v[3] for v in found) + gap * fill) / rows_
            spread = (sum(v[4] for v in found) + gap * fill * fill) / rows_ - mean * mean
            out.setdefault((h, f), {})[c] = (near + mean, max(spread, 0.0) ** 0.5 or 1.0)
    return out
