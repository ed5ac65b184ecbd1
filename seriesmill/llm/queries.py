"""The operators over the given tables, with the columns that are compared."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import ann, chat, embed_dedup, exact_dedup, hard_negatives, lm_trie, mixing, packing, phrases, pii, quality, simhash, substring_dedup
from seriesmill.llm.work import Work


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir), Work(spark, "op1"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def vocabulary() -> str:
    """Path of the byte-level BPE file, the same on every machine that has the tokenizers installed."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_documents(spark, sf_dir), vocabulary(), Work(spark, "op2"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return embed_dedup.near_duplicates(vectors, Work(spark, "op3"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_documents(spark, sf_dir), Work(spark, "op4"))
    return found.select(
        "doc_id",
        *[pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
        F.size("learnt").cast("long").alias("n_learnt"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(quality.fold(F.col("doc_id"), 4) == 2, F.lit(False))  # a row without an id is in no fold
    scored = quality.score_documents(_documents(spark, sf_dir), labels, Work(spark, "op5"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.duplicate_groups(_documents(spark, sf_dir), Work(spark, "op6"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


#: One conversation more, given as a list of messages: both turns say control strings.
CONTROL_ID, CONTROL_TEXT = -7, "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = json.dumps({"messages": [{"role": r, "content": CONTROL_TEXT} for r in ("user", "assistant")]})
    extra = spark.range(1).select(F.lit(CONTROL_ID).cast("long").alias("record_id"), F.lit(said).alias("payload"))
    turns = chat.canonical_rows(rows, "conv_id").unionByName(chat.canonical_turns(extra))
    return chat.read_back(chat.format_turns(turns))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(_documents(spark, sf_dir), Work(spark, "op8"), with_bytes=False)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(quality.fold(F.col("doc_id"), 7) == 2, F.lit(False))
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    scored = lm_trie.score_documents(docs, ~held_out, Work(spark, "op9"))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir), Work(spark, "op10"))
    return found.select("doc_id", "fingerprint", "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives.mine(vectors, Work(spark, "op11"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf_dir).select("doc_id", "lang", "text"), Work(spark, "op12"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.neighbours(vectors, Work(spark, "op13"))


QUERIES = [op1_mix_sources, op2_pack_sequences, op3_embedding_dedup, op4_personal_data, op5_quality, op6_exact_dedup, op7_chat_format, op8_substring_dedup, op9_lm_scores, op10_simhash, op11_hard_negatives, op12_phrases, op13_nearest]
