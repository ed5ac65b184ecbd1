"""Personal data: identifiers by their form, and more of them by bootstrapped contexts.

Base spans are the matches of fixed forms. Bootstrapping takes them as seeds: the words around a seed are a
lexical pattern, patterns and the identifiers that they surround form a graph, and scores are passed back
and forth over it. A pattern is as good as the share of seeds (and of identifiers already believed)
among all that it surrounds; an identifier is as good as its best pattern. What a good pattern
surrounds and resembles a kind without having its exact form becomes a span of that kind.

Only column expressions and relational operations are used. Positions follow from the lengths of
matches and of the text between them: both come from the same expression and hence agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.work import Work

KINDS = ("email", "ip", "card", "phone")
# The forms, written so that the engine neither recurses on repetition nor starts again within a run:
# a run of characters that fails from its first character fails from every other one. ``\G`` lets a match
# start right behind the last one.
_LOCAL = "[A-Za-z0-9._%+-]"
FORMS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Cheap conditions without which a form cannot occur.
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Words that may be identifiers of no exact form, and what makes them resemble a kind.
WORD = r"(?<![^ \t-\r])[^ \t-\r]*[0-9@][^ \t-\r]*"
_RESEMBLES = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^[^0-9]?[0-9]+(?:[.:][0-9]+){3}[^0-9]?$",
    "card": r"^(?:[^0-9]*[0-9]){12,19}[^0-9]*$",
    "phone": r"^[+(]?[0-9](?:[().-]*[0-9]){6,14}[^0-9]?$",
}
#: Characters of context on each side, distinct identifiers that a pattern needs, rounds, and the score of a discovery.
CONTEXT, SUPPORT, ROUNDS, BELIEF = 40, 3, 3, 0.8
_SPANS = "array<struct<s: int, e: int, m: string, l: string, r: string>>"


def _found(text: Column, form: str, hint: str) -> Column:
    """Spans (s, e, m, l, r) of all matches: start, end, text, and the text around up to the next match, cut to ``CONTEXT``."""
    there = text.contains(hint) if hint == "@" else text.rlike(hint)
    none = F.array().cast("array<string>")
    matches = F.when(there, F.regexp_extract_all(text, F.lit(form), F.lit(0))).otherwise(none)
    between = F.when(there, F.split(text, form, -1)).otherwise(none)
    return F.struct(matches.alias("m"), between.alias("b"))


def _placed(found: Column) -> Column:
    n = F.size(found["m"])
    pairs = F.arrays_zip(found["m"].alias("m"), F.slice(found["b"], 1, n).alias("b"), F.slice(found["b"], 2, n).alias("a"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["b"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m"), F.right(x["b"], F.lit(CONTEXT)).alias("l"), F.left(x["a"], F.lit(CONTEXT)).alias("r"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).cast(_SPANS).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    return F.when(n > 0, F.aggregate(pairs, first, add, lambda acc: acc["out"])).otherwise(F.array().cast(_SPANS))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        x = F.ascii(F.substring(backwards, i, F.lit(1))) - 48
        double = x * 2
        return total + F.when(i % 2 == 1, x).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    match = span["m"]
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        d = _digits(match)
        return F.length(d).between(12, 19) & F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _of_kind(number: int, kind: str) -> Column:
    valid = F.filter(F.col(kind), lambda x: _valid(kind, x))
    return F.transform(valid, lambda x: F.struct(x["s"].alias("s"), F.lit(number).alias("k"), x["e"].alias("e"), x["m"].alias("m"), x["l"].alias("l"), x["r"].alias("r")))


def base_spans(docs: DataFrame, work: Work) -> DataFrame:
    """(doc_id, rid, base, words) per row: base spans (s, k, e, m, l, r) by start and kind, and other words with digits or an at sign."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), text.alias("_t"))
    rows = rows.select("doc_id", "rid", *[_found(F.col("_t"), FORMS[k], _HINTS[k]).alias(k) for k in KINDS], _found(F.col("_t"), WORD, "[0-9@]").alias("w"))
    rows = rows.select("doc_id", "rid", *[_placed(F.col(k)).alias(k) for k in (*KINDS, "w")])
    base = F.array_sort(F.concat(*[_of_kind(number, kind) for number, kind in enumerate(KINDS)]))
    rows = rows.select("doc_id", "rid", base.alias("base"), "w")
    alike = lambda x: F.length(x["m"]).between(5, 64) & _any_kind(x["m"])
    apart = lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"]))
    words = F.filter(F.filter("w", alike), apart)
    return work.settle(rows.select("doc_id", "rid", "base", words.alias("words")), "spans")


def _any_kind(match: Column) -> Column:
    some = F.lit(False)
    for pattern in _RESEMBLES.values():
        some = some | match.rlike(pattern)
    return some


def _patterns(span: Column) -> Column:
    """The lexical patterns of a span: the two words before it; the word before and the word after."""
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[0-9]+", "0"), r"[ \t-\r]+", " "))
    before = F.split(plain(span["l"]), " ")
    one, two = F.element_at(before, -1), F.array_join(F.slice(before, F.greatest(F.size(before) - 1, F.lit(1)), F.lit(2)), " ")
    after = F.element_at(F.split(plain(span["r"]), " "), 1)
    found = F.array(F.concat(F.lit("before: "), two), F.concat(F.lit("around: "), one, F.lit(" _ "), after))
    return F.filter(found, lambda p: ~p.isin("before: ", "around:  _ "))


def occurrences(spans: DataFrame, work: Work) -> DataFrame:
    """(rid, s, e, item, kind, seed, patterns): one row per seed, and per other word and kind that it resembles."""
    seeds = spans.select("rid", F.explode("base").alias("x")).select(
        "rid", "x.s", "x.e", F.lower("x.m").alias("item"), F.col("x.k").alias("kind"), F.lit(True).alias("seed"), _patterns(F.col("x")).alias("patterns")
    )
    kinds = [F.when(F.col("x.m").rlike(_RESEMBLES[k]), F.lit(n)) for n, k in enumerate(KINDS)]
    others = (
        spans.select("rid", F.explode("words").alias("x"))
        .select("rid", "x.s", "x.e", F.lower("x.m").alias("item"), F.explode(F.array_compact(F.array(*kinds))).alias("kind"), "x")
        .select("rid", "s", "e", "item", "kind", F.lit(False).alias("seed"), _patterns(F.col("x")).alias("patterns"))
    )
    return work.settle(seeds.unionByName(others), "occurrences")


def bootstrap(found: DataFrame, work: Work, rounds: int = ROUNDS, support: int = SUPPORT, belief: float = BELIEF) -> DataFrame:
    """(item, kind, score) of the identifiers that are not seeds, scored over the graph of patterns and items.

    Edges are distinct, so a pattern or an item that occurs very often weighs no more; sums combine
    before they shuffle, and each round's tables are written before they are joined.
    """
    edges = work.settle(
        found.select("item", "kind", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "item", "kind").agg(F.max("seed").alias("seed")),
        "edges",
    )
    wide = edges.select("pattern", "item").distinct().groupBy("pattern").agg(F.count("*").alias("items")).filter(F.col("items") >= support)
    wide = work.settle(wide, "patterns")
    edges = work.settle(edges.join(wide, "pattern"), "edges")
    scores = None
    for _ in range(rounds):
        e = edges.withColumn("score", F.when(F.col("seed"), 1.0))
        if scores is not None:
            e = edges.join(scores, ["item", "kind"], "left").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.col("score")))
        believed = F.coalesce(F.col("score"), F.lit(0.0))
        good = e.groupBy("pattern", "kind").agg(
            (F.sum(believed) / (F.max("items") + 1)).alias("worth"), F.sum((believed >= belief).cast("int")).alias("backed")
        )
        good = work.settle(good.filter((F.col("backed") >= support) & (F.col("worth") > 0)), "worth")
        scores = edges.filter("NOT seed").join(good, ["pattern", "kind"]).groupBy("item", "kind").agg(F.max("worth").alias("score"))
        scores = work.settle(scores, "scores")
    return scores


def personal_data(docs: DataFrame, work: Work, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, base and learnt spans (s, k, e), all of them as ``spans``.

    Positions are code points, ends exclusive. Base spans are the valid matches of each form, leftmost and without
    overlap within a kind; learnt ones are words that overlap no base span. A null text is empty, rows that repeat are searched
    each for itself, an empty table gives no rows.
    """
    spans = base_spans(docs, work)
    found = occurrences(spans, work)
    scores = bootstrap(found, work, rounds)
    taken = scores.filter(F.col("score") >= BELIEF).select("item", "kind")
    learnt = (
        found.filter("NOT seed").join(taken, ["item", "kind"])
        .groupBy("rid").agg(F.collect_set(F.struct("s", F.col("kind").alias("k"), "e")).alias("learnt"))
    )
    learnt = work.settle(learnt, "learnt")
    bare = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    rows = spans.select("doc_id", "rid", bare.alias("base")).join(learnt, "rid", "left")
    rows = rows.withColumn("learnt", F.coalesce("learnt", F.array().cast("array<struct<s: int, k: int, e: int>>")))
    return rows.select("doc_id", "base", F.array_sort("learnt").alias("learnt"), F.array_sort(F.concat("base", "learnt")).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == KINDS.index(kind))).cast("long")
