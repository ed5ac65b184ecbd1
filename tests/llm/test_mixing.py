"""Source mixing: targets against a plain water filling, words taken against targets."""

import re
from collections import defaultdict

import pytest

from conftest import odd_rows
from seriesmill.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while True:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]} if total else set()
        if not over:
            target |= {s: left * w[s] / total for s in open_}
            return target
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over


def test_mix(odd, work):
    rows = mixing.mix(odd, work).collect()
    sizes = defaultdict(int)
    for _, text, source in odd_rows():
        sizes[source] += size(text)
    want = plain_targets(dict(sizes))
    taken = defaultdict(int)
    assert sorted(str((r.doc_id, r["size"])) for r in rows) == sorted(str((i, size(t))) for i, t, _ in odd_rows())
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    for source in sizes:  # whole documents only: off by less than the smallest one that could still be moved
        assert abs(taken[source] - want[source]) <= max(size(t) for _, t, s in odd_rows() if s == source)


def test_words_come_near_targets_and_reruns_agree(spark, work):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "concat('s', id % 7) AS source", "repeat('w ', cast(1 + pmod(xxhash64(id), 300) AS int)) AS text"
    )
    first = mixing.mix(docs, work)
    by = first.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for r in by:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 3
    again = mixing.mix(docs.repartition(5), work)
    assert sorted(map(tuple, first.select("doc_id", "copies").collect())) == sorted(map(tuple, again.select("doc_id", "copies").collect()))


def test_rates_grow_or_fall_with_size(spark, work):
    """One source above and one below its size: the exponential tilt favours long or short documents."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "if(id < 1500, 'b', 'a') AS source", "repeat('w ', cast(1 + id % 50 AS int)) AS text")
    rows = mixing.mix(docs, work).collect()
    for source in ("a", "b"):
        mine = [r for r in rows if r.source == source]
        total, target = mine[0].source_size, mine[0].target
        long = [r.copies for r in mine if r["size"] > 40]
        short = [r.copies for r in mine if r["size"] <= 10]
        mean = lambda x: sum(x) / len(x)
        if target < 0.95 * total:
            assert mean(long) < mean(short)
        elif 1.05 * total < target < 1.95 * total:
            assert mean(long) > mean(short)


def test_repeat(odd, work):
    copies = {}
    for r in mixing.mix(odd, work).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    out = mixing.repeat(odd, work)
    assert out.columns == odd.columns
    seen = defaultdict(int)
    for r in out.select("doc_id").collect():
        seen[r.doc_id] += 1
    assert dict(seen) == {i: n for i, n in copies.items() if n}


def test_empty_and_wordless(spark, nothing, work):
    assert mixing.mix(nothing, work).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.taken, r.target) for r in mixing.mix(blank, work).collect()) == [(1, 0, 0.0), (2, 0, 0.0)]
