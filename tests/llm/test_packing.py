"""Packing: ids against the tokenizer itself, places without gaps, plans that use up every piece."""

import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import odd_rows
from seriesmill.llm import packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
WHOLE.encode_special_tokens = True


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "the", "The", "don't", "'ll", "x2", "½", "Ⅷ", "ü", "😀", "!!", "***", "<|endoftext|>", "​", " ", "_", "1234", "é"])).map("".join))
def test_ids_are_the_tokenizers(text):
    assert np.frombuffer(tokens.encode(text, PATH), "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_many_texts_and_long_ones_at_once(monkeypatch):
    """Texts in groups, texts cut into parts, and odd ones between them: each the ids of the tokenizer."""
    monkeypatch.setattr(tokens, "GROUP_CHARS", 50)
    texts = [r[1] or "" for r in odd_rows() if len(r[1] or "") < 20_000] + ["", " a", "a  b", "\0 x", " ".join(["long", "text,", "it's"] * 90), "x" * 300, " \1long", "\1", "y\nz " * 30 + "end"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in tokens.encode_all(texts, PATH)]
    assert got == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=200))
def test_plan_uses_every_piece_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=41)
    used = np.zeros(41, int)
    total = 0
    for n, inside in packing.plan(counts):
        assert n > 0 and sum(k * v for k, v in inside.items()) <= 40
        total += n
        for k, v in inside.items():
            used[k] += n * v
    assert (used == counts).all()
    assert total <= max(1, 2 * sum(lengths) // 40 + 1)


def test_exact_complements_are_found():
    counts = np.zeros(101, int)
    for a, b, c, d in ((50, 25, 20, 5), (60, 40, 0, 0), (70, 11, 19, 0)):
        for x in (a, b, c, d):
            counts[x] += x > 0
    counts[0] = 0
    assert sum(n for n, _ in packing.plan(counts)) == 3


@pytest.mark.parametrize("capacity", [packing.CAPACITY, 64])
def test_pack(odd, work, capacity):
    rows = packing.pack(odd, PATH, work, capacity).collect()
    want = []
    for doc_id, text, _ in odd_rows():
        ids = WHOLE.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        sizes = [len(ids)] if len(ids) <= capacity else [len(ids) % capacity or capacity] + [capacity] * (-(-len(ids) // capacity) - 1)
        for piece, n in enumerate(sizes):
            want.append((doc_id, piece, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
            at += n
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=str) == sorted(want, key=str)
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for parts in inside.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(inside) <= -(-sum(w[3] for w in want) // capacity) + 2


def test_whole_sequences(spark, work):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "x " * 70)], "doc_id long, text string")
    packed = work.settle(packing.pack(docs, PATH, work, 64, with_ids=True), "packed")
    ids = [r.ids for r in packing.sequences(packed).collect()]
    assert sum(map(len, ids)) == packed.agg({"length": "sum"}).first()[0] and max(map(len, ids)) <= 64


def test_empty_table(nothing, work):
    assert packing.pack(nothing, PATH, work).count() == 0


def test_plan_holds_no_table_of_all_pairs():
    # every length occurs: sums by brute force, and the driver's memory stays far below lengths x lengths numbers
    counts = np.full(2_049, 3, np.int64)
    counts[0] = 0
    tracemalloc.start()
    sums = packing._Sums(counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2_048 * 2_048 * 4
    some = np.zeros(60, np.int64)
    some[[1, 2, 3, 7, 20, 29, 30, 59]] = 1
    want = {}
    for a in np.flatnonzero(some)[::-1].tolist():
        for b in np.flatnonzero(some[: a + 1]).tolist():
            if a + b < 60:
                want.setdefault(a + b, []).append(a)
    assert {t: a.tolist() for t, a in packing._Sums(some).pairs.items()} == want
    assert len(sums.pairs) == 2_047


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.lists(st.sampled_from([" ", "  ", "\n", "\r\n", "\x1c", "\x85", "\xa0", "　", "a", "s", "'", "'s", "'re", "'LL", "1", "½", ",", "…", "’", "é", "日", "́", "word"])).map("".join),
        max_size=6,
    )
)
def test_cuts_between_classes_of_bytes_are_the_tokenizers(texts):
    got = [np.frombuffer(ids, "<u4").tolist() for ids in tokens.encode_all(texts, PATH)]
    assert got == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_are_few_whatever_marks_and_breaks_join_them(monkeypatch):
    """Words, marks and line breaks are looked up apart, and texts with several spaces in a row take no way of their own."""
    words = ["".join(chr(97 + (k // 26**d) % 26) for d in range(3)) for k in range(40)]
    texts = [f"{a}{mark}\n{b}{mark}  {a} {b}{mark} " for a in words for b in words for mark in (",", ".", "?!", "…")]
    learnt, whole, learn = [], [], tokens._learn
    monkeypatch.setattr(tokens, "_learn", lambda state, pieces: learnt.extend(pieces) or learn(state, pieces))
    state = tokens._load(PATH)
    monkeypatch.setattr(state, "young", {})
    monkeypatch.setattr(state, "old", {})
    monkeypatch.setattr(state, "tokenizer", type("Counted", (), {"encode": lambda self, text, **kw: whole.append(text) or WHOLE.encode(text, **kw)})())
    got = list(tokens.encode_all(texts, PATH))
    assert not whole and len(learnt) < 1_000
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got[::97]] == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts[::97]]
