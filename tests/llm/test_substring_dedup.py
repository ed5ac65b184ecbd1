"""Substring dedup against all strings of the corpus."""

import hashlib

import numpy as np
import pytest

import brute
from conftest import odd_rows, prose
from seriesmill.llm import substring_dedup as sd


def check(frame, texts, work, width, **options):
    rows = sd.remove_repeats(frame, work, width, **options).collect()
    want = []
    for text, runs in zip(texts, brute.removed(texts, width)):
        raw = (text or "").encode()
        kept = b"".join(raw[a:z] for a, z in zip([0] + [e for _, e in runs], [s for s, _ in runs] + [len(raw)]))
        want.append((len(raw), sum(e - s for s, e in runs), len(runs), hashlib.sha256(kept).hexdigest(), kept))
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in rows) == sorted(want)


def shared_passages():
    passages = [prose(900 + k, 50) for k in range(4)]
    texts = []
    for i in range(60):
        parts = [prose(i, 30), passages[i % 4][: 120 + 5 * i], prose(i + 500, 25)]
        if i % 3 == 0:
            parts.insert(1, passages[(i + 1) % 4][i:])
        texts.append(" ".join(parts))
    texts += [texts[3]] * 4 + [texts[5][:-9] + "x", "ab" * 400, "ab" * 300 + "c", "é" * 150, "é" * 99, None, ""]
    return texts


@pytest.mark.parametrize("group_blocks", [sd.GROUP_BLOCKS, 1])
def test_shared_passages(spark, work, group_blocks):
    texts = shared_passages()
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, t int").repartition(4)
    check(frame, texts, work, 200, group_blocks=group_blocks)


@pytest.mark.parametrize("width,gram", [(12, 5), (30, 8)])
def test_few_letters(spark, work, width, gram):
    rng = np.random.default_rng(width)
    texts = ["".join(rng.choice(list("ab"), int(rng.integers(0, 90)))) for _ in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(frame, texts, work, width, gram=gram)


def test_odd_rows(odd, work):
    rows = {(r.doc_id, r.n_bytes): r for r in sd.remove_repeats(odd, work, with_bytes=False).collect()}
    for doc_id, text, _ in odd_rows():
        assert (doc_id, len((text or "").encode())) in rows
    assert rows[(15, 5000)].n_removed == rows[(18, 5000)].n_removed == 5000
    assert rows[(16, 150000)].n_removed == 150000 and rows[(1, 0)].n_spans == 0


def test_suffix_order_is_the_order_of_bytes():
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 99, 4000, dtype=np.uint8)
    suffixes = sd._Suffixes(raw, 50)
    at = rng.permutation(3900)[:700]
    first = np.repeat([0, 300, 301], [300, 1, 399])
    size = np.repeat([300, 1, 399], [300, 1, 399])
    got = suffixes.sort(at, first, size)
    for a, n in ((0, 300), (300, 1), (301, 399)):
        keys = [raw[p : p + 50].tobytes() for p in got[a : a + n]]
        assert keys == sorted(keys) and sorted(got[a : a + n]) == sorted(at[a : a + n])


def test_runs_are_maximal():
    assert sd.cut_out(b"abcdefghij", [(6, 8), (0, 2), (2, 4), (1, 3)]) == (6, 2, b"efij")
    assert sd.cut_out(b"abc", []) == (0, 0, b"abc")


def test_empty_table(nothing, work):
    assert sd.remove_repeats(nothing, work).count() == 0
