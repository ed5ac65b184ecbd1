"""Exact duplicates through an extendible-hash index on shared files.

The index maps a 64-bit hash of the normalised text to an entry. A directory of 2^g slots, one
per value of the first g hash bits, names the bucket of each slot; a bucket with more entries
than fit is split by one more bit, and the directory doubles when a split needs more bits than
it has. Owner tasks hold ranges of the bucket order and chain the entries that share a hash.
Texts whose hash occurs more than once are compared byte by byte.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.sift import sift
from seriesmill.llm.work import Work, whole_row

#: Entries of a bucket before it is split.
BUCKET_ENTRIES = 16_384
MAX_DEPTH = 62


def normalised(text: Column) -> Column:
    """Each run of space, tab, line feed, vertical tab, form feed and return as one space; null is empty.

    A single space is its own replacement, so only other runs are matched.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\t-\r][ \t-\r]*| [ \t-\r]+", " ")


def address(text: Column) -> Column:
    """The hash whose leading bits address a bucket."""
    return F.xxhash64(text)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _prefix(depth: int) -> Column:
    return F.expr(f"shiftrightunsigned(h, {64 - depth})") if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, work: Work, capacity: int = BUCKET_ENTRIES) -> tuple[DataFrame, int]:
    """Slots (slot, bucket, local_depth) of the directory and its depth, for the hashes ``h`` of ``entries``.

    Starts at the depth at which evenly spread entries would fit, then splits whatever is
    overfull. Entries with one and the same hash cannot be split and stay chained. The table has
    about entries / capacity rows.
    """
    depth = max(0, math.ceil(math.log2(max(1, entries.count()) / capacity)) - 1) if capacity else 0
    closed, left = [], entries.select("h")
    while True:
        sizes = left.groupBy(_prefix(depth).alias("prefix")).agg(
            F.count("*").alias("n"), (F.min("h") == F.max("h")).alias("single")
        )
        sizes = work.settle(sizes, f"buckets-{depth}")
        full = sizes.filter((F.col("n") > capacity) & ~F.col("single") & F.lit(depth < MAX_DEPTH))
        closed.append((depth, sizes.join(full.select("prefix"), "prefix", "left_anti").select("prefix")))
        if full.isEmpty():
            break
        left = left.withColumn("prefix", _prefix(depth)).join(full.select("prefix"), "prefix", "left_semi").select("h")
        depth += 1
    slots = None
    for local, buckets in closed:
        spread = depth - local
        first = F.shiftleft("prefix", spread)
        part = buckets.select(
            F.explode(F.sequence(first, first + F.lit((1 << spread) - 1).cast("long"))).alias("slot"),
            first.alias("bucket"),
            F.lit(local).alias("local_depth"),
        )
        slots = part if slots is None else slots.unionByName(part)
    return work.settle(slots, "directory"), depth


def build_index(keys: DataFrame, work: Work, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """Index files: one row per entry (bucket, h, sha, chain, chain_size, keep_id, keep_rid, n), in bucket order.

    ``keys`` has doc_id, rid (unique), h and sha. Repeated keys are combined before any shuffle.
    """
    per_id = keys.groupBy("h", "sha", "doc_id").agg(F.count("*").alias("c"), F.min("rid").alias("rid"))
    entries = per_id.groupBy("h", "sha").agg(
        F.min("doc_id").alias("keep_id"),
        F.coalesce(F.min_by("rid", "doc_id"), F.min("rid")).alias("keep_rid"),
        F.sum("c").alias("n"),
    )
    entries = work.settle(entries, "entries")
    slots, depth = directory(entries, work, capacity)
    owned = (
        entries.withColumn("slot", _prefix(depth))
        .join(slots, "slot")
        .drop("slot")
        .repartitionByRange("bucket", "h")
    )
    chain = Window.partitionBy("bucket", "h")
    index = owned.withColumn("chain", F.row_number().over(chain.orderBy("sha"))).withColumn(
        "chain_size", F.count("*").over(chain)
    )
    index = work.settle(index, "index")
    work.drop(entries)
    return index


def duplicate_groups(
    docs: DataFrame,
    work: Work,
    capacity: int = BUCKET_ENTRIES,
    address: Callable[[Column], Column] = address,
    digest: Callable[[Column], Column] = digest,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, sha, bucket, chain, h.

    Texts are equal when their normalised bytes are. Of equal texts the row with the smallest
    doc_id stays, of rows that repeat doc_id and text one. A null text is empty, a null doc_id
    comes after all others, an empty table gives no rows, other columns are not read. Rows of one
    group never meet in one task: entries combine per task first, and the final lookup joins
    written tables, whose skew the engine splits.
    """
    text = normalised(F.col("text"))
    keys = docs.select("doc_id", text.alias("norm")).select(
        "doc_id", F.monotonically_increasing_id().alias("rid"), address(F.col("norm")).alias("h"), digest(F.col("norm")).alias("sha")
    )
    keys = work.settle(keys, "keys")
    index = build_index(keys, work, capacity)

    # byte comparison: as many different texts under a hash as it has chained entries, or a digest is shared
    repeated = work.settle(
        index.groupBy("h").agg(F.sum("n").alias("rows"), F.count("*").alias("entries")).filter("rows > 1"), "repeated"
    )
    texts = (
        docs.select(text.alias("norm"))
        .withColumn("h", address(F.col("norm")))
        .join(repeated.select("h"), "h", "left_semi")
        .groupBy("norm")
        .agg(F.first("h").alias("h"))
        .groupBy("h")
        .agg(F.count("*").alias("texts"))
    )
    shared = work.settle(
        repeated.join(work.settle(texts, "texts"), "h").filter("texts > entries").select("h"), "shared-digests"
    )
    found = keys.join(
        index.select("h", "sha", "keep_id", "keep_rid", F.col("n").alias("group_size"), "bucket", "chain"), ["h", "sha"]
    ).select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "sha", "bucket", "chain", "h"
    )
    if shared.isEmpty():
        return found
    return found.join(shared, "h", "left_anti").unionByName(_by_bytes(docs, shared, work, address, digest))


def _by_bytes(docs, shared, work, address, digest) -> DataFrame:
    """The rows whose digest different texts share, grouped by their bytes alone."""
    rows = (
        docs.select("doc_id", normalised(F.col("text")).alias("norm"))
        .withColumn("h", address(F.col("norm")))
        .join(shared, "h", "left_semi")
        .withColumn("rid", F.monotonically_increasing_id())
    )
    rows = work.settle(rows, "compared")
    groups = (
        rows.groupBy("norm", "doc_id")
        .agg(F.count("*").alias("c"), F.min("rid").alias("rid"))
        .groupBy("norm")
        .agg(
            F.min("doc_id").alias("keep_id"),
            F.coalesce(F.min_by("rid", "doc_id"), F.min("rid")).alias("keep_rid"),
            F.sum("c").alias("group_size"),
        )
    )
    groups = work.settle(groups, "compared-groups")
    return rows.join(groups, "norm").select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        digest(F.col("norm")).alias("sha"), F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("int").alias("chain"), "h",
    )


def keep_one(docs: DataFrame, work: Work) -> DataFrame:
    """``docs`` without its duplicates, all columns kept.

    Rows are looked up by doc_id and hash of the normalised text. Only rows that a bitmap of the dropped ones may
    name are joined with them, so texts that stay are hardly ever shuffled; rows that repeat doc_id and text are
    rare, and only these are grouped with their texts.
    """
    groups = work.settle(duplicate_groups(docs, work), "groups")
    per_row = groups.groupBy(F.col("doc_id").alias("of_id"), F.col("h").alias("of_h"), F.col("sha").alias("of_sha"))
    changes = per_row.agg(F.count("*").alias("n"), F.max("kept").alias("kept")).filter("NOT kept OR n > 1")
    changes = work.settle(changes, "changes")
    rows = docs.select(whole_row(docs), F.col("doc_id").alias("id"), normalised(F.col("text")).alias("norm"))
    rows = rows.withColumn("h", address(F.col("norm")))
    rest, maybe = sift(rows, F.col("h"), changes, "of_h")
    maybe = maybe.withColumn("sha", digest(F.col("norm")))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h")) & (F.col("sha") == F.col("of_sha"))
    kept = rest.select("row.*").unionByName(maybe.join(changes.drop("n", "kept"), same, "left_anti").select("row.*"))
    again = changes.filter("kept").drop("n", "kept")
    if again.isEmpty():
        return kept
    twice = maybe.join(again, same, "left_semi")
    return kept.unionByName(twice.dropDuplicates(["id", "sha"]).select("row.*"))
