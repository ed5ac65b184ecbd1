"""Personal data: base spans against the plain forms, learnt spans from contexts."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import brute
from conftest import odd_rows
from seriesmill.llm import pii

PIECES = [
    "a@b.c", "x.y+z@host-1.example.com", "a@b.c_d@e.fg", "@", ".", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.0.0.255", "1.2.3", "99999999999.1.1.1",
    "4465758382889437", "4465 7583 8288 9437", "4465-7583-8288-9436", "12", " ", "  ", "+1 (743) 555-3824", "+49", "++1 2", "+1234567890123456", "()-", "x", "é", "\n", "😀", "-", "%",
]


def spans_of(df):
    return {r.doc_id: r for r in df.collect()}


def plain(text):
    return [(s, k, e) for s, k, e in brute.base_spans(text)]


def check(spark, work, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = spans_of(pii.personal_data(frame, work))
    for i, text in enumerate(texts):
        assert [(x.s, x.k, x.e) for x in found[i].base] == plain(text), text
        assert set(map(tuple, found[i].base)) <= set(map(tuple, found[i].spans))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=9).map("".join), min_size=80, max_size=120))
def test_base_spans(spark, work, texts):
    check(spark, work, texts)


def test_long_runs_neither_recurse_nor_take_long(spark, work):
    check(spark, work, ["1" * 60000, "a" * 60000 + " a@b.cd", "1 " * 30000, "a." * 20000 + "@x" + ".y" * 20000, "+" * 50000, "1." * 30000])


def test_odd_rows(odd, work):
    rows = pii.personal_data(odd, work).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _, _ in odd_rows())
    by = {str(i): plain(t) for i, t, _ in odd_rows()}
    assert all([tuple(x) for x in r.base] == by[str(r.doc_id)] for r in rows)


def test_contexts_discover_other_forms(spark, work):
    texts = [f"please write to reach me: +1 (555) 010-{1000 + i} ext later" for i in range(8)]
    texts += ["please write to reach me: (555)0109999 ext later"]  # no plus sign: no base form
    texts += ["the total was counted 5550108888 units long ago"]  # resembles one, in a context that no seed has
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = spans_of(pii.personal_data(frame, work))
    learnt = [(x.s, x.k, x.e) for x in rows[8].learnt]
    start = texts[8].index("(555)")
    assert learnt == [(start, 3, start + len("(555)0109999"))]
    assert not any(rows[i].learnt for i in range(10) if i != 8)
    assert [tuple(x) for x in rows[8].spans] == learnt


def test_a_context_of_mixed_use_discovers_nothing(spark, work):
    texts = [f"call now +1 (555) 010-{1000 + i} or so" for i in range(4)] + [f"call now 55501{i:05d} or so" for i in range(12)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert not any(r.learnt for r in pii.personal_data(frame, work).collect())


def test_empty_table(nothing, work):
    assert pii.personal_data(nothing, work).count() == 0
