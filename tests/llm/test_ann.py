"""Nearest neighbours against all cosines."""

import numpy as np
import pytest

from seriesmill.llm import ann

SCHEMA = "vec_id long, embedding array<float>, key string, rank int, query string"


def vectors(n=1200, dim=24):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[100:200] = x[:100] + rng.normal(size=(100, dim)).astype(np.float32) * 0.2
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return rows + [(5000 + i, rows[50][1]) for i in range(60)] + [(6000 + i, [2 * y for y in rows[50][1]]) for i in range(20)]


def plain(rows, every=50, want=5):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(y is not None and np.isfinite(y) for y in v) and any(v)]
    out = {}
    for i, v in good:
        if i % every == 0:
            near = [(-round(float(v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w))), 12), j) for j, w in good if len(w) == len(v) and j != i]
            out[i] = sorted(near)[:want]
    return out


def of(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-round(r.score, 12), r.vec_id))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 0, "q") for r in rows], SCHEMA)


def test_recall_and_scores(spark, work):
    rows = vectors()
    got, want = of(ann.neighbours(frame(spark, rows), work)), plain(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)
    true = {(i, j): s for i, near in plain(rows, want=10**9).items() for s, j in near}
    assert all(true[q, j] == s for q, near in got.items() for s, j in near)
    assert got[5000] == want[5000] and got[50] == want[50]  # copies, ties by id


@pytest.mark.parametrize("block", [4096, 32])
def test_every_bucket_gives_the_exact_result(spark, work, block):
    rows = vectors(600)
    found = ann.neighbours(frame(spark, rows), work, block=block, probing=(2, 10**6))
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert of(found) == plain(rows)


def test_too_few_found_are_searched_exactly(spark, work):
    rows = vectors(400)
    got, want = of(ann.neighbours(frame(spark, rows), work, probing=(1, 1))), plain(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())


def test_odd_rows(spark, work):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.125]), (2, [0.0, 1.0]), (50, [1.0, 0.0]), (100, None), (150, []), (200, [0.0, 0.0]), (250, [1.0, None]),
        (300, [float("nan"), 1.0]), (350, [float("inf"), 1.0]), (None, [1.0, 1.0]), (400, [1.0]), (450, [1.0, 2.0, 3.0]), (451, [3.0, 2.0, 1.0]),
        (500, [2.0**-100, 2.0**-100]), (550, [2.0**127, 2.0**127]),
    ]
    assert of(ann.neighbours(frame(spark, rows), work)) == {q: near for q, near in plain(rows).items() if near}


def test_empty_and_repeated(spark, work):
    assert ann.neighbours(frame(spark, []), work).count() == 0
    assert ann.neighbours(frame(spark, [(50, [1.0, 2.0])]), work).count() == 0
    found = ann.neighbours(frame(spark, [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (51, [1.0, 1.0])]), work).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == [(50, 1, 51)] * 2


def test_probes_go_by_falling_nearness():
    x = np.random.default_rng(1).normal(size=(40, 20))
    for rows in (1000, 30_000, 5_000_000, 10**9):
        hashes = ann.Hashes(rows, 20)
        probes = hashes.probes(x, 1, 30)
        assert (probes[:, 0] == hashes.own(x, 1)).all()
        assert all(len(set(p)) == min(30, hashes.buckets) for p in probes.tolist())
        rank = [hashes.rank(x[i], x, 1)[i] for i in range(len(x))]
        assert not any(rank)
        near = x + np.random.default_rng(2).normal(size=x.shape) * 0.3
        for i in range(len(x)):
            place = int(hashes.rank(x[i], near[i : i + 1], 1)[0])
            if place < probes.shape[1]:
                assert probes[i, place] == hashes.own(near[i : i + 1], 1)[0]


def test_hadamard_is_orthogonal():
    h = ann.hadamard(np.eye(16))
    assert np.array_equal(h @ h.T, 16 * np.eye(16)) and set(np.unique(h)) == {-1.0, 1.0}
