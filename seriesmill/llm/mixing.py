"""Mixing sources to target weights by entropy balancing.

Each source has a target of words. Document rates r in [0, 2] solve

    minimise  sum of r ln r - r + 1   subject to   sum over the source of r * size = target,

whose solution is r = min(2, exp(lambda * size)): rates are tilted exponentially in the size, with
one multiplier per source. The dual in lambda is convex; safeguarded Newton steps solve it for
all sources at once. Documents of one source and size share a rate, so the steps run over a
table of (source, size, documents), aggregated once. Rates become whole copies at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.work import Work, whole_row

#: Weights of the sources in code-point order, repeating; null comes last.
WEIGHTS = (5.0, 2.0, 1.0)
#: Words of the mix as a share of all words, and the most copies of a document.
SHARE, MOST = 1.5, 2
#: Newton stops when no source is off by more than this share of its target.
TOLERANCE, MAX_STEPS = 1e-7, 80
#: Documents of one source and size are ranked in so many parts.
RANK_PARTS = 256
#: Sizes are summed up in blocks of so many before the sums of a source are put in order.
SIZE_BLOCK = 1_024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target`` to one row per source (key, source, source_size).

    Weights go round in code-point order. A target stops at ``most`` times its source's size; what
    is over is shared out again by weight: in ascending order of cap / weight, a source is capped
    while its cap is below its share of what the earlier caps left. The windows see one row per source.
    """
    place = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(place) - 1) % len(weights) + 1)
    cap = (F.col("source_size") * most).cast("double")
    s = sources.withColumn("weight", w).withColumn("cap", cap)
    whole = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(whole) * F.lit(share)).withColumn("weights", F.sum("weight").over(whole))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("left", left).withColumn("open", open_weight)
    s = s.withColumn("capped", F.col("cap") <= F.col("weight") * F.col("left") / F.col("open"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("left") / F.col("open")))).over(whole)
    s = s.withColumn("level", level["col2"])
    return s.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * F.col("level"))).select(
        "key", "source", "source_size", "weight", "target", "capped"
    )


def solve(cells: DataFrame, sources: DataFrame, work: Work, most: int = MOST) -> DataFrame:
    """Multiplier ``lam`` per source, by Newton steps on all sources at once.

    Every step is one aggregate over ``cells`` (key, size, n) joined with the small table of
    multipliers. A step that leaves the bracket known to hold the root is replaced by its middle.
    Capped sources need no multiplier: all their rates are ``most``.
    """
    sized = cells.filter("size > 0")
    ends = sized.groupBy("key").agg(F.min("size").alias("small"), F.max("size").alias("large"), F.sum(F.col("size") * F.col("n")).alias("words"))
    open_sources = sources.filter("NOT capped").select("key", "target").join(ends, "key")
    ratio = F.log(F.col("target") / F.col("words"))
    # exp(lam * size) lies between its values at the smallest and the largest size
    bound = F.greatest(F.abs(ratio), F.log(F.lit(float(most)))) / F.col("small")
    state = open_sources.select(
        "key", "target", (-bound).alias("lo"), bound.alias("hi"),
        (ratio / F.col("large")).alias("lam"), F.lit(False).alias("done"),
    )
    state = work.settle(state, "multipliers")
    for _ in range(MAX_STEPS):
        raw = F.exp(F.least(F.col("lam") * F.col("size"), F.lit(50.0)))
        mass = F.col("size") * F.col("n")
        moments = (
            sized.join(state.filter("NOT done").select("key", "lam"), "key")
            .groupBy("key")
            .agg(
                F.sum(mass * F.least(raw, F.lit(float(most)))).alias("f"),
                F.sum(F.when(raw < most, mass * F.col("size") * raw).otherwise(0.0)).alias("slope"),
            )
        )
        s = state.join(moments, "key", "left")
        off = F.col("f") - F.col("target")
        done = F.col("done") | (F.abs(off) <= F.col("target") * TOLERANCE) | ((F.col("hi") - F.col("lo")) <= F.abs(F.col("lam")) * 1e-15)
        s = s.withColumn("now", done)
        s = s.withColumn("lo2", F.when(off < 0, F.col("lam")).otherwise(F.col("lo")))
        s = s.withColumn("hi2", F.when(off > 0, F.col("lam")).otherwise(F.col("hi")))
        newton = F.col("lam") - off / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("lo2")) & (newton < F.col("hi2"))
        step = F.when(inside, newton).otherwise((F.col("lo2") + F.col("hi2")) / 2)
        after = s.select(
            "key", "target",
            F.when(F.col("now"), F.col("lo")).otherwise(F.col("lo2")).alias("lo"),
            F.when(F.col("now"), F.col("hi")).otherwise(F.col("hi2")).alias("hi"),
            F.when(F.col("now"), F.col("lam")).otherwise(step).alias("lam"),
            F.col("now").alias("done"),
        )
        after = work.settle(after.coalesce(1), "multipliers")
        work.drop(state)
        state = after
        if state.filter("NOT done").isEmpty():
            break
    return state.select("key", "lam")


def _running(cells: DataFrame, value: str, out: str) -> DataFrame:
    """Running sum of ``value`` per source, sizes descending, in two levels: blocks of sizes, then within each."""
    c = cells.withColumn("block", F.floor(F.col("size") / SIZE_BLOCK))
    blocks = c.groupBy("key", "block").agg(F.sum(value).alias("in_block"))
    above = Window.partitionBy("key").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("key", "block", F.coalesce(F.sum("in_block").over(above), F.lit(0)).alias("above"))
    inside = Window.partitionBy("key", "block").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("within", F.sum(value).over(inside))
    return c.join(blocks, ["key", "block"]).withColumn(out, F.col("above") + F.col("within")).drop("block", "above", "within")


def whole_copies(cells: DataFrame, sources: DataFrame, work: Work, most: int = MOST, rounds: int = 6) -> DataFrame:
    """Copies per (source, size), a whole number in ``copies``, whose words come near the target.

    Running sums of the expected copies, sizes descending, are rounded and differenced: errors of
    neighbouring sizes cancel. What is left is then given to, or taken from, the largest size that
    fits into it, a few times over; the remainder shrinks below the smallest size still open.
    """
    run = _running(cells.withColumn("expected", F.col("n") * F.col("rate")), "expected", "run")
    low = F.floor(F.col("run") - F.col("expected") + 0.5)
    copies = F.floor(F.col("run") + 0.5) - low
    c = run.withColumn("copies", F.greatest(F.lit(0), F.least(copies, F.col("n") * most)).cast("long"))
    c = work.settle(c.select("key", "size", "n", "copies"), "copies")
    for _ in range(rounds):
        taken = c.groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        rest = sources.select("key", "target").join(taken, "key").select("key", F.round(F.col("target") - F.col("taken")).cast("long").alias("rest"))
        room = F.when(F.col("rest") > 0, F.col("n") * most - F.col("copies")).otherwise(F.col("copies"))
        fits = (
            c.join(rest, "key")
            .withColumn("room", room)
            .filter("size > 0 AND room > 0 AND size <= abs(rest)")
            .groupBy("key")
            .agg(F.max("size").alias("size"), F.max_by("room", "size").alias("room"), F.first("rest").alias("rest"))
            .select("key", "size", (F.signum("rest") * F.least("room", F.floor(F.abs("rest") / F.col("size")))).cast("long").alias("more"))
        )
        fits = work.settle(fits.coalesce(1), "change")
        if fits.isEmpty():
            break
        changed = c.join(fits, ["key", "size"], "left").select("key", "size", "n", (F.col("copies") + F.coalesce("more", F.lit(0))).alias("copies"))
        changed = work.settle(changed, "copies")
        work.drop(c)
        c = changed
    return c


def mix(
    docs: DataFrame, work: Work, weights=WEIGHTS, share: float = SHARE, most: int = MOST, extra: tuple[Column, ...] = ()
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): doc_id, source, size, source_size, target, copies, taken, and ``extra``.

    A null text has size 0, null is a source of its own and the last in order, texts without words
    are never taken, sources without words have target 0, rows that repeat are rows of their own.
    Which of several documents of one source and size get one copy more follows a hash of doc_id.
    An empty table gives no rows.
    """
    sized = work.settle(
        docs.select("doc_id", "source", _key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"), *extra), "sizes"
    )
    cells = work.settle(sized.groupBy("key", "size").agg(F.count("*").alias("n"), F.first("source").alias("source")), "cells")
    sources = cells.groupBy("key").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = work.settle(targets(sources, weights, share, most), "targets")
    lam = solve(cells, sources, work, most)
    work.release()  # the driver holds the plans and tasks of all steps until they are collected
    tilt = F.least(F.exp(F.least(F.col("lam") * F.col("size"), F.lit(50.0))), F.lit(float(most)))
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("capped"), float(most)).otherwise(tilt)
    rated = cells.select("key", "size", "n").join(sources.select("key", "capped"), "key").join(lam, "key", "left")
    copies = whole_copies(rated.withColumn("rate", F.coalesce(rate, F.lit(0.0))), sources, work, most)
    work.release()

    # documents of one cell: the first extra ones by hash get one copy more than the others
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(RANK_PARTS))
    parts = sized.groupBy("key", "size", part.alias("part")).agg(F.count("*").alias("in_part"))
    upto = Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("earlier", F.coalesce(F.sum("in_part").over(upto), F.lit(0)))
    parts = parts.join(copies, ["key", "size"]).select(
        "key", "size", "part", "earlier", F.floor(F.col("copies") / F.col("n")).alias("least"), (F.col("copies") % F.col("n")).alias("extra")
    )
    parts = parts.join(sources.select("key", "source_size", "target"), "key")
    parts = work.settle(parts, "parts")
    rank = Window.partitionBy("key", "size", "part").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id")
    rows = sized.withColumn("part", part).withColumn("rank", F.row_number().over(rank))
    got = F.col("least") + (F.col("earlier") + F.col("rank") <= F.col("extra")).cast("long")
    return rows.join(parts, ["key", "size", "part"]).withColumn("copies", got).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *(c for c in sized.columns if c not in ("doc_id", "source", "key", "size")),
    )


def repeat(docs: DataFrame, work: Work, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns kept.

    Copies are looked up by doc_id and text. Of rows that repeat both, each stands for the mean of their
    copies: the sum is dealt out by a number within the repeated rows, which alone are ranked.
    """
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.col("source")).alias("mark")
    mixed = mix(docs.select("doc_id", "source", "text"), work, weights, share, most, (mark,))
    plan = mixed.groupBy(F.col("doc_id").alias("of_id"), F.col("mark").alias("of_mark")).agg(
        F.count("*").alias("rows"), F.sum("copies").alias("copies")
    )
    plan = work.settle(plan, "plan")
    rows = docs.select(whole_row(docs), F.col("doc_id").alias("id"), mark)
    taken = rows.join(plan, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("mark") == F.col("of_mark")))
    times = F.col("copies")
    if not plan.filter("rows > 1").isEmpty():
        alone = F.when(F.col("rows") == 1, F.monotonically_increasing_id())
        taken = taken.withColumn("alone", alone)
        taken = taken.withColumn("nth", F.row_number().over(Window.partitionBy("id", "mark", "alone").orderBy(F.lit(1))))
        times = F.floor(F.col("copies") / F.col("rows")) + (F.col("nth") <= F.col("copies") % F.col("rows")).cast("long")
    taken = taken.withColumn("times", times.cast("int")).filter("times > 0")
    return taken.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
