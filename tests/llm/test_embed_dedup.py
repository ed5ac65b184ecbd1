"""Embedding near-dedup against all cosines."""

import numpy as np

from seriesmill.llm import embed_dedup


def vectors():
    rng = np.random.default_rng(8)
    out = []
    for c in range(40):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 7))):
            out.append((base + rng.normal(size=16) * 0.12).astype(np.float32).tolist())
    out += [out[0], out[0], [2 * x for x in out[5]], [0.0] * 16, None, [], [1.0] * 15 + [float("nan")], [1.0] * 15 + [float("inf")], [1.0, None] + [0.5] * 14, [1.0, 2.0], [2.0, 4.0]]
    return list(enumerate(out)) + [(0, out[3]), (None, out[9])]


def plain(rows):
    units = []
    for _, v in rows:
        good = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) if good else None
        units.append(x / np.linalg.norm(x) if good else None)
    n = len(rows)
    link = [[i != j and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9 for j in range(n)] for i in range(n)]
    label = list(range(n))
    while True:
        new = [min([label[i]] + [label[j] for j in range(n) if link[i][j]]) for i in range(n)]
        if new == label:
            break
        label = new
    out = []
    for i, (vec_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((vec_id, sum(link[i]), component, vec_id == component))
    return sorted(out, key=str)


def test_links_and_components(spark, work):
    frame = spark.createDataFrame([(*r, 3, "x") for r in vectors()], "vec_id long, embedding array<float>, n int, cid string")
    for block in (1024, 4):
        found = embed_dedup.near_duplicates(frame, work, recall=0.9999, block=block)
        assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted(map(tuple, found.collect()), key=str) == plain(vectors())


def test_recall_at_the_threshold(spark, work):
    """Pairs exactly as far apart as allowed, hashed with the production bits and tables."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        c = 0.9005
        rows += [(2 * i, a.tolist()), (2 * i + 1, (c * a + (1 - c * c) ** 0.5 * b).tolist())]
    found = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), work)
    assert found.filter("n_links > 0").count() >= 2 * 0.98 * 400


def test_tables_grow_with_the_vectors():
    small, large = embed_dedup.tables_for(10_000), embed_dedup.tables_for(10_000_000)
    assert small[0] < large[0] and small[1] < large[1]


def test_empty_table(spark, work):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"), work).count() == 0
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in embed_dedup.near_duplicates(none, work).collect()] == [(1, 0, 1, True)]
