"""Chat formatting: layouts by fingerprint, reversible escapes, digests read back."""

import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from seriesmill.llm import chat

PIECES = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "|im_end|>", "|im_start|>", "</s>", "[INST]", "\n", "a", "é", "😀", "<|im_end|>\n", ""]
SAID = "</s>[INST] ok [/INST]"


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=8).map("".join), min_size=300, max_size=400))
def test_escapes_are_reversible(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("text", chat.escaped("text").alias("safe")).collect()
    for r in rows:
        assert chat.unescape(r.safe) == r.text
        assert not any(c in r.safe for c in chat.CONTROLS)


def test_layouts(spark):
    u, a, s = "ask " + SAID, "tell", "be kind"
    records = [
        (1, {"prompt": u, "response": a}), (2, {"instruction": u, "output": a}), (3, {"system": s, "prompt": u, "response": a}),
        (4, {"messages": [{"role": "user", "content": u}, {"role": "assistant", "content": a}]}),
        (5, {"conversations": [{"from": "human", "value": u}, {"from": "gpt", "value": a}]}),
        (6, {"conv_id": 6, "turn": 1, "role": "assistant", "text": a}), (6, {"conv_id": 6, "turn": 0, "role": "user", "text": u}),
        (7, {"prompt": None, "response": a}), (8, {"question": u}), (9, {"prompt": u, "response": {"text": a}}), (10, {"messages": []}), (11, [1]),
    ]
    rows = [(i, json.dumps(r), "x") for i, r in records] + [(12, "no json", "x"), (13, None, "x")]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "record_id long, payload string, turn string"))
    got = {}
    for r in turns.orderBy("record_id", "turn").collect():
        got.setdefault(r.record_id, []).append((r.layout, r.role, r.text))
    two = [("user", u), ("assistant", a)]
    plain = {k: [x[1:] for x in v] for k, v in got.items()}
    assert plain[1] == plain[2] == plain[4] == plain[5] == plain[6] == two
    assert plain[3] == [("system", s), *two] and plain[7] == [("user", ""), ("assistant", a)]
    for unknown in (8, 9, 10, 11, 12, 13):
        assert plain[unknown] == [(None, None)], unknown
    assert [got[k][0][0] is None for k in (8, 9, 11, 12, 13)] == [True] * 5
    known = turns.filter("turn IS NOT NULL")
    back = {r.conv_id: r for r in chat.read_back(chat.format_turns(known)).collect()}
    assert back[4].turns_sha256 == digest(two) and back[4].n_turns == 2
    assert back[4].loss_chars == len(a) and back[4].loss_sha256 == hashlib.sha256(a.encode()).hexdigest()


def test_ties_nulls_and_controls(spark):
    rows = [
        (1, 0, "user", SAID, 1), (1, 1, "assistant", SAID, 1), (1, 1, "assistant", SAID, 1), (1, None, "assistant", "last", 1), (2, 0, None, None, 1),
        (3, 0, "odd\nrole\\n<|im_end|>", "x" * 200000, 1), (None, 0, "assistant", "", 1),
    ]
    segments = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int"))
    back = {r.conv_id: r for r in chat.read_back(segments).collect()}
    assert back[1].turns_sha256 == digest([("user", SAID), ("assistant", SAID), ("assistant", SAID), ("assistant", "last")])
    assert back[1].loss_sha256 == hashlib.sha256((SAID * 2 + "last").encode()).hexdigest() and back[1].loss_chars == 2 * len(SAID) + 4
    assert back[2].turns_sha256 == digest([("", "")]) and back[2].loss_chars == 0
    assert back[3].turns_sha256 == digest([("odd\nrole\\n<|im_end|>", "x" * 200000)])
    assert back[None].n_turns == 1
    whole = {}
    for r in segments.filter("conv_id = 1").orderBy("turn").collect():
        whole.setdefault(r.conv_id, []).append(r.segment)
    assert back[1].formatted_chars == len("".join(whole[1]))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "record_id long, payload string")
    assert chat.read_back(chat.format_turns(chat.canonical_turns(empty))).count() == 0


def test_long_texts_are_not_lost(spark):
    # longer than a variant, or a parser's usual limit, holds
    text = 'say "a\\b" : {x}, ' * 1_500_000
    payloads = [
        {"prompt": text, "response": "short"},
        {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": text}]},
        {"conv_id": 3, "role": "user", "text": text, "turn": 7},
        {"unknown": text},
    ]
    made = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(payloads)], "record_id long, payload string")
    rows = chat.canonical_turns(made).selectExpr("record_id", "layout", "conv_id", "turn", "role", "length(text) AS n", "md5(text) AS d").collect()
    digest = hashlib.md5(text.encode()).hexdigest()
    got = sorted((r.record_id, r.layout, r.conv_id, r.turn, r.role, r.n) for r in rows if r.record_id < 3)
    n = len(text)
    assert got == [
        (0, "prompt and response", 0, 0, "user", n), (0, "prompt and response", 0, 1, "assistant", 5),
        (1, "messages", 1, 0, "user", 2), (1, "messages", 1, 1, "assistant", n), (2, "turn rows", 3, 7, "user", n),
    ]
    assert {r.d for r in rows if r.n == n} == {digest}
    assert [(r.layout, r.turn) for r in rows if r.record_id == 3] == [(None, None)]


def test_columns_need_no_payload(spark):
    text = "a long one <s> " * 2_000_000
    rows = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, None, None), (None, 2, "assistant", text)], "conv_id long, turn long, role string, text string")
    turns = chat.canonical_rows(rows, "conv_id")
    known = chat.canonical_turns(spark.createDataFrame([(1, chat.LAYOUTS[0].example)], "record_id long, payload string")).first()
    got = turns.selectExpr("conv_id", "turn", "role", "length(text) AS n", "layout", "fingerprint").collect()
    assert {(r.conv_id, r.turn, r.role, r.n) for r in got} == {(1, 0, "user", 2), (1, 1, "", 0), (None, 2, "assistant", len(text))}
    assert {(r.layout, r.fingerprint) for r in got} == {(known.layout, known.fingerprint)}
    other = chat.canonical_rows(rows.withColumn("more", rows.turn), "conv_id")
    assert [(r.layout, r.turn) for r in other.collect()] == [(None, None)] * 3
