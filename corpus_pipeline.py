"""The corpus pipeline: stages over the documents, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. Labels for the quality stage come from ``labels`` of the same folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesmill.llm import exact_dedup, mixing, packing, quality, simhash
from seriesmill.llm.queries import vocabulary
from seriesmill.llm.work import Work, whole_row


def keep_good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.select("doc_id", "text", whole_row(docs))
    scored = quality.score_documents(rows, labels, Work(spark, "pipeline-quality"))
    return scored.filter("predicted = 1").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.keep_one(docs, Work(spark, "pipeline-exact"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return simhash.keep_one(docs, Work(spark, "pipeline-near"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.repeat(docs, Work(spark, "pipeline-mix"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their place in the packed sequences."""
    return packing.pack(docs, vocabulary(), Work(spark, "pipeline-pack"))


STAGES = [
    ("quality classifier", keep_good_texts),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]
#: A fitted network, an iterated mix and a tokenizer have no SQL form; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Work(spark, "pipeline")
    for name, stage in STAGES:
        docs = work.settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
