"""Hard negatives against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score int, id string"


def vectors(n=700, dim=6, clusters=9):
    """Clusters of different density, ties, copies with equal and other labels."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(clusters, dim))
    rows = []
    for i in range(n):
        v = centres[i % clusters] + rng.normal(size=dim) * (0.05 + 0.05 * (i % 4))
        rows.append((i, (np.round(v * 16) / 16).tolist(), int(rng.integers(0, 4))))
    rows += [(1000 + i, rows[50][1], i % 3) for i in range(120)]  # one very common vector
    return rows


def plain(rows, every=50):
    known = [
        (i, [int(np.floor(256 * x)) for x in v], (label + 1) % 10 if i % 7 == 0 else label)
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, v, label in known:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other == label) for j, w, other in known if len(w) == len(v) and j != i)
        for p, pid in [(-s, j) for s, j, same in scored if same][:5]:
            fits = [(-s, j) for s, j, same in scored if not same and 50 * p <= -100 * s <= 95 * p]
            out += [(i, pid, rank + 1, j, p, s) for rank, (s, j) in enumerate(fits[:3])]
    return sorted(out)


@pytest.mark.parametrize("cell,first,block", [(1024, 8, 4096), (8, 2, 4096), (64, 1, 16)])
def test_all_windows(spark, work, monkeypatch, cell, first, block):
    """Whatever the cells, rounds and blocks: the same rows."""
    monkeypatch.setattr(hard_negatives, "CELL", cell)
    monkeypatch.setattr(hard_negatives, "FIRST", first)
    rows = vectors()
    found = hard_negatives.mine(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), work, block=block)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_stops_early(spark, work, monkeypatch):
    """Certificates end the visits of an anchor: together they ask for fewer than all cells."""
    monkeypatch.setattr(hard_negatives, "CELL", 8)
    asked, cells, asks = [], [], hard_negatives._asks

    def counted(anchors, books, wide, start, stop):
        out = asks(anchors, books, wide, start, stop)
        asked.append(out.count())
        cells.append(anchors.count() * len(wide[6, 0]) * len(wide[6, 1]) if start == 0 else 0)
        return out

    monkeypatch.setattr(hard_negatives, "_asks", counted)
    hard_negatives.mine(spark.createDataFrame([(*r, 1, "x") for r in vectors()], SCHEMA), work).count()
    assert 0 < sum(asked) < 0.8 * sum(cells)


def test_odd_rows(spark, work):
    rows = vectors(120)
    odd = [
        (None, rows[0][1], 1), (500, None, 1), (550, [], 1), (600, rows[1][1], None), (650, [1.0, None] + [0.0] * 4, 1),
        (700, [float("nan")] * 6, 1), (750, [float("inf")] + [0.0] * 5, 2), (800, [0.0] * 6, 2), (850, [1.0, 2.0], 2), (851, [1.0, 1.0], 3),
        (852, [0.75, 0.5], 2), (900, [-x for x in rows[0][1]], 0),
    ]
    found = hard_negatives.mine(spark.createDataFrame([(*r, 1, "x") for r in rows + odd], SCHEMA), work)
    assert sorted(map(tuple, found.collect())) == plain(rows + odd)
    huge = [(i, [1e200, 1.0], 1) for i in (0, 50)]
    assert hard_negatives.mine(spark.createDataFrame([(*r, 1, "x") for r in huge], SCHEMA), work).count() == 0


def test_empty_and_repeated(spark, work):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA), work).count() == 0
    twice = [(50, [1.0, 0.5], 1, 0, "x")] * 2 + [(51, [1.0, 0.25], 1, 0, "x")] + [(52, [0.75, 0.25], 2, 0, "x")]
    found = hard_negatives.mine(spark.createDataFrame(twice, SCHEMA), work)
    assert sorted(map(tuple, found.collect())) == [(50, 51, 1, 52, 73728, 57344)] * 2


def test_large_numbers_are_exact():
    a = np.array([[2**27 + 1, 2**27 - 1]])
    assert hard_negatives.products(a, a).tolist() == [[(2**27 + 1) ** 2 + (2**27 - 1) ** 2]]


def test_windows(spark):
    scores = [-41, -40, -1, 0, 1, 2, 3, 19, 20, 21, 39, 40, 41, 2**55]
    lo, hi = hard_negatives.percent_window(F.col("score"))
    for r in spark.createDataFrame([(s,) for s in scores], "score long").select("score", lo.alias("lo"), hi.alias("hi")).collect():
        assert r.lo == -(-r.score // 2) and r.hi == 95 * r.score // 100
