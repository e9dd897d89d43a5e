"""Registered queries of the package: thin digests of each operator's result.

Each callable takes (spark, sf_dir) and runs over whole tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.llm import best_fit_packing, bpe_codec, conversation_repair, decontamination, exact_topk, hard_negatives, minhash_dedup, quality_classifier, quality_rules, secret_scan, suffix_dedup, token_counts, token_output
from cityweave.llm.sql import ORACLE_SQL  # noqa: F401

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(F.col("id").alias("doc_id"), *counts, "base_failed", "kept")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = secret_scan.with_digest(_table(spark, sf_dir, "documents"))
    rows = secret_scan.findings(versions, secret_scan.scan(versions, secret_scan.ledger_path(spark)))

    def count(kind: str):
        return F.coalesce(F.size(F.filter("findings", lambda f: f["rule"] == kind)), F.lit(0)).cast("bigint").alias(f"n_{kind}")

    each = F.transform("findings", lambda f: F.concat_ws(":", f["rule"], f["start"].cast("string"), f["end"].cast("string")))
    spans = F.coalesce(F.array_join(each, ","), F.lit(""))
    return rows.select(
        F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"), F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans")
    )


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2)
    kept = F.col("did").eqNullSafe(F.col("component_id"))
    return rows.select(F.col("did").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return best_fit_packing.packed(docs, public_tokenizers.path(BYTE_BPE)).withColumnRenamed("id", "doc_id")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", exact_topk.scaled(F.col("embedding")).alias("v"))
    return exact_topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_output.token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return token_output.with_crc32(rows).withColumnRenamed("id", "doc_id")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return rows.select(F.col("did").alias("doc_id"), "n_bytes", "n_removed", "n_spans", digest)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), hard_negatives.floored(F.col("embedding")).alias("v"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired_conversations(_table(spark, sf_dir, "conversations"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", digest, (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_quality_rules": op3_quality_rules,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_secret_scan": op5_secret_scan,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_exact_topk": op8_exact_topk,
    "op9_token_files": op9_token_files,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_decontamination": op13_decontamination,
}
