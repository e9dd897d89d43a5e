"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before kept.  All but the last return the columns of ``documents``.

1. ``quality_classifier``: documents scored below the threshold go.
2. ``minhash_dedup``: of each group of near duplicates (five-word shingles,
   similarity 0.8) the one of least id (then text digest) stays; repeated rows become one.
3. ``suffix_dedup``: byte strings of 100 that start earlier too are cut out, in
   whole characters; documents that lose all their text go.
4. ``secret_scan``: findings are replaced by a mark.
5. ``best_fit_packing``: the remaining texts become sequences of 1024 tokens.

Defined results for nulls, empty and long texts, ties, repeated rows and extra
columns are those of the operators; empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.llm import best_fit_packing, minhash_dedup, quality_classifier, secret_scan, suffix_dedup
from cityweave.llm.shared import text_digest, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# SQL has no compressor, tokenizer or packing; tests compare with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_classifier.classify(docs, labels, keep=COLUMNS[1:])
    return scored.where("predicted = 1").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = minhash_dedup.near_duplicates(docs, shingle_words=5, percent=80).where("kept").select("did", "tag").distinct()
    docs = docs.select(*COLUMNS)
    same = docs["doc_id"].eqNullSafe(kept["did"]) & (text_digest("text") == kept["tag"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])


def repeated_text_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.suffix_dedup(docs, whole_chars=True, carry=COLUMNS[2:4])
    text = F.col("kept").cast("string")
    return rows.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes"))).select(
        F.col("did").alias("doc_id"), text.alias("text"), "carried.lang", "carried.source", F.length(text).cast("bigint").alias("n_chars")
    )


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    versions = secret_scan.with_digest(docs)
    ledger = secret_scan.scan(versions, secret_scan.ledger_path(spark))
    found = written(secret_scan.findings_by_blob(ledger), "findings")
    joined = docs.select(*COLUMNS, digest.alias("digest")).join(found, "digest", "left")
    text = secret_scan.redacted(F.col("text"), F.col("findings"))
    changed = F.when(F.col("findings").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("bigint"))
    return joined.select("doc_id", text.alias("text"), "lang", "source", changed.alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = best_fit_packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_dedup", near_duplicate_stage),
    ("suffix_dedup", repeated_text_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if at < len(STAGES) - 1:
            rows = written(rows, f"stage-{name}")
    return rows
