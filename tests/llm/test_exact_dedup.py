"""Extendible-hash exact dedup against grouping in plain Python."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from conftest import odd_rows
from seriesmill.llm import exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[norm(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        kept = [i == keep for i in ids]
        if sum(kept) > 1:  # of repeated rows one stays
            kept = [k and kept[:n].count(True) == 0 for n, k in enumerate(kept)]
        out += [(i, keep, len(ids), k, hashlib.sha256(text.encode()).hexdigest()) for i, k in zip(ids, kept)]
    return sorted(out, key=str)


def got(df):
    rows = df.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("sha")).collect()
    return sorted(map(tuple, rows), key=str)


def test_groups(odd, work):
    assert got(exact_dedup.duplicate_groups(odd, work)) == expected(odd_rows())


def test_buckets_split_when_overfull(odd, work):
    found = exact_dedup.duplicate_groups(odd, work, capacity=1)
    assert got(found) == expected(odd_rows())
    assert found.select("bucket").distinct().count() > 8


def test_directory_covers_every_slot_once(spark, work):
    entries = work.settle(spark.range(500).select(F.xxhash64("id").alias("h")), "entries")
    slots, depth = exact_dedup.directory(entries, work, capacity=20)
    assert sorted(r.slot for r in slots.collect()) == list(range(1 << depth))
    sizes = entries.withColumn("slot", exact_dedup._prefix(depth)).join(slots, "slot").groupBy("bucket").count()
    assert sizes.agg(F.max("count")).first()[0] <= 20


def test_collisions_are_told_apart_by_bytes(odd, work):
    weak = exact_dedup.duplicate_groups(
        odd, work, address=lambda c: F.length(c).cast("long") % 3, digest=lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 5), 2, "0"))
    )
    want = sorted([(i, k, n, kept) for i, k, n, kept, _ in expected(odd_rows())], key=str)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in weak.collect()], key=str) == want


def test_keep_one_keeps_columns_and_one_row_of_each_text(odd, work):
    left = exact_dedup.keep_one(odd, work)
    assert left.columns == odd.columns
    want = sorted([i for i, _, _, kept, _ in expected(odd_rows()) if kept], key=str)
    assert sorted([r.doc_id for r in left.collect()], key=str) == want


def test_empty_table(nothing, work):
    assert exact_dedup.duplicate_groups(nothing, work).count() == 0
    assert exact_dedup.keep_one(nothing, work).columns == nothing.columns
