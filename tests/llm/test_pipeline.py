"""The pipeline's stages on the smallest tables and on odd rows, each against what it decides."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import odd_rows, with_clashes
from test_exact_dedup import norm
from test_simhash import plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_columns(spark, work):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = seen
        seen = work.settle(stage(spark, before, SF), f"stage-{number}")
        if number < 4:
            assert seen.columns == docs.columns, name
        if number == 0:
            kept = {r.doc_id for r in seen.collect()}
            assert sum(labels[i] == (i in kept) for i in labels) >= 0.97 * len(labels)
        elif number == 1:
            rows = before.collect()
            first = {}
            for r in rows:
                first[norm(r.text)] = min(first.get(norm(r.text), r.doc_id), r.doc_id)
            assert {r.doc_id for r in seen.collect()} == set(first.values())
        elif number == 2:
            rows = before.collect()
            prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
            left = {r.doc_id for r in seen.collect()}
            for i in prints:  # every dropped one has a link, kept ones have none among themselves
                near = [j for j in prints if j != i and (prints[i] ^ prints[j]).bit_count() <= 3]
                assert (i in left) or near
                assert not (i in left and any(j in left for j in near))
        elif number == 3:
            times = Counter(r.doc_id for r in seen.select("doc_id").collect())
            assert set(times.values()) <= {1, 2} and set(times) <= {r.doc_id for r in before.collect()}
        else:
            assert seen.select("doc_id").filter("piece = 0").count() == before.count()
            assert seen.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").isEmpty()


def test_odd_rows_pass_every_stage(spark, odd, work):
    docs = odd
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[1:4]):
        docs = work.settle(stage(spark, docs, SF), f"odd-{number}")
        assert docs.columns == odd.columns
    assert corpus_pipeline.STAGES[0][1](spark, odd, SF).columns == odd.columns
    assert {r.doc_id for r in docs.collect()} <= {i for i, _, _ in odd_rows()}


@pytest.mark.parametrize("number", range(5))
def test_empty_table(spark, nothing, number):
    assert corpus_pipeline.STAGES[number][1](spark, nothing, SF).count() == 0
