"""Collocations against plain counting."""

import re
from collections import Counter

import pytest
from conftest import odd_rows, prose, with_clashes

from seriesmill.llm import phrases

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, least, top=2000, share=80):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = {}
    known = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    outer = Counter()
    for (lang, w), a in known.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                outer[lang, w[i : i + k]] = max(outer[lang, w[i : i + k]], a)
    for (lang, w), a in known.items():
        if (lang, w) in outer and 100 * outer[lang, w] >= share * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, rank + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top])
    )


def corpus():
    rows = [(i, ". ".join(prose(i * 31 + j, 20 + j % 7) for j in range(6)) + f", new york city! New\tYork City of {i}\vnew york", ["en", "de", None, "und"][i % 4]) for i in range(160)]
    return rows + [(1000 + i, "a rose is a rose is a rose is a rose; ÄPFEL Äpfel ÄPFEL", "fr") for i in range(40)]


@pytest.mark.parametrize("shards,chunk,segment", [(1, 6 << 20, 4 << 20), (4, 6 << 20, 4 << 20), (40, 3000, 500), (4, 200, 40)])
def test_against_plain_counts(spark, work, monkeypatch, shards, chunk, segment):
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "SEGMENT", segment)
    monkeypatch.setattr(phrases.segments, "__defaults__", (segment,))
    rows = corpus()
    docs = with_clashes(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "tongue")).drop("lang").withColumnRenamed("tongue", "lang").repartition(3)
    found = phrases.collocations(docs, work, shards=shards)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain(rows, 30)


def test_few_ranges_and_top(spark, work, monkeypatch):
    monkeypatch.setattr(phrases, "RANGE", 256)
    rows = corpus()
    found = phrases.collocations(spark.createDataFrame(rows, SCHEMA), work, least=3, top=7)
    assert sorted(map(tuple, found.collect())) == plain(rows, 3, 7)


def test_full_bitmap_changes_nothing(spark, work, monkeypatch):
    """A bitmap of 256 bits, all set: every sequence is counted, the result stays."""
    monkeypatch.setattr(phrases, "MAP_BITS", 8)
    monkeypatch.setattr(phrases, "ROW_BITS", 5)
    monkeypatch.setattr(phrases, "frequent_bits", lambda counts, tasks: counts.sparkSession.createDataFrame([], "bit_row long, bits binary"))
    monkeypatch.setattr(phrases, "bitmap", lambda rows: phrases.np.full(32, 255, phrases.np.uint8))
    rows = corpus()
    assert sorted(map(tuple, phrases.collocations(spark.createDataFrame(rows, SCHEMA), work).collect())) == plain(rows, 30)


def test_odd_rows(spark, work):
    rows = [(i, t, lang) for i, t, lang in odd_rows()]
    found = phrases.collocations(spark.createDataFrame(rows, SCHEMA), work, least=5)
    assert sorted(map(tuple, found.collect())) == plain(rows, 5)
    for empty in ([], [(1, None, "en")], [(1, " .;", None), (2, "", "en")]):
        assert phrases.collocations(spark.createDataFrame(empty, SCHEMA), work).count() == 0


def test_segments_keep_all_sequences():
    text = (prose(5, 3000) + ". a, b c d e f " + "w" * 500 + " x y").encode()
    for size in (1, 17, 200, 10**6):
        parts = list(phrases.segments(text, size))
        assert b"".join(p[:own] for p, own in parts) == text
        whole, cut = phrases.Words([(text, len(text))]), phrases.Words(parts)
        assert [len(a) for a in whole.starts] == [len(a) for a in cut.starts]


def test_supports_never_lose_a_phrase(spark):
    """The supports less one add up to less than the least count, so one shard reaches its own."""
    docs = spark.createDataFrame([("en", i % 5, "x" * (1 + i * i)) for i in range(50)] + [("de", 2, "y")], "lang string, shard int, text string")
    found = {}
    for r in phrases.local_supports(docs).collect():
        found.setdefault(r.lang, []).append(r.support)
    assert found["de"] == [30] and sum(s - 1 for s in found["en"]) < 30 <= sum(found["en"])


def test_score_beyond_64_bits(spark, work, monkeypatch):
    big = 9 * 10**17
    counts = spark.createDataFrame([("en", 0, "", 4 * big), ("en", 1, "x", big + 1), ("en", 1, "y", big), ("en", 2, "x y", big)], "lang string, k int, phrase string, n long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a: counts)
    row = phrases.collocations(None, work).first()
    assert (row.score, row.l, row.r, row.n) == (2_000_000 * big // (2 * big + 1), big + 1, big, 4 * big)
