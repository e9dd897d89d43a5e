"""Token ids as Parquet list columns.

Texts are range-partitioned by id and text hash and sorted, encoded in place and written
with Spark's Parquet writer: one ``ids`` list column (dictionary or delta
encoding), row groups and pages of a chosen size, column and page indexes as
the writer makes them.  Reads of metadata touch no ids; reads of an id range
skip files, row groups and pages by their statistics.

Starts (ids of all documents before one) are a running sum within each sorted
partition, kept in the files, plus the totals of the partitions before: one
row a partition.

Defined results: null or empty text has the end id alone; a null id sorts
first; rows with equal ids are ordered by their text's hash, equal rows are
interchangeable; extra columns are not read.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityweave.llm.bpe_codec import id_lists
from cityweave.llm.shared import map_batches, new_table_path, small_batches, texts_of
from cityweave.llm.tokens import WordBpe, encoder, read_vocabulary

ROW_GROUP_BYTES = 32 * 1024 * 1024
PAGE_BYTES = 64 * 1024
# Write options by encoding name.
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.writer.version": "PARQUET_1_0"},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"},
}
SCHEMA = "id {kind}, part int, local_start bigint, n_tokens bigint, ids array<int>"


def encode_sorted(docs: DataFrame, vocabulary: str, end_id: int | None, id_col: str, text_col: str) -> DataFrame:
    """Rows of the token files, partitioned and sorted by id."""
    spark = docs.sparkSession
    raw = read_vocabulary(spark, vocabulary)
    small_batches(spark)
    tail = b"" if end_id is None else array("I", [end_id]).tobytes()
    ordered = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "id", F.xxhash64("text"))  # one id may hold many rows
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions("id", F.xxhash64("text"))
        .select("id", "part", "text")
    )

    def run(batches):
        enc, start = encoder(WordBpe, raw.value), 0
        for batch in batches:
            blobs = [enc.encode_text(t) + tail for t in texts_of(batch.column(2))]
            n = np.array([len(b) // 4 for b in blobs], np.int64)
            starts = start + np.cumsum(n) - n
            start += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(starts), pa.array(n), id_lists(blobs)],
                ["id", "part", "local_start", "n_tokens", "ids"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return ordered.mapInArrow(run, SCHEMA.format(kind=kind))


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int | None = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    encoding: str = "dictionary",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Write the token files of ``docs`` to ``path`` in ascending id order."""
    rows = encode_sorted(docs, vocabulary, end_id, id_col, text_col)
    writer = rows.write.option("parquet.block.size", row_group_bytes).option("parquet.page.size", page_bytes)
    for key, value in ENCODINGS[encoding].items():
        writer = writer.option(key, value)
    writer.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str, columns: tuple[str, ...] = ("id", "start", "n_tokens", "ids")) -> DataFrame:
    """Rows of token files with their global ``start``; reads only the columns asked for."""
    files = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("_total"))  # one row a partition
    offsets = totals.select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return (
        files.join(F.broadcast(offsets), "part")
        .withColumn("start", F.col("local_start") + F.col("_offset"))
        .select(*columns)
    )


def with_crc32(rows: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32`` (ids as little-endian unsigned 32-bit integers)."""
    kind = rows.schema["id"].dataType.simpleString()

    def make():
        def crc(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column(3)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            ends = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(sums, pa.int64())],
                ["id", "start", "n_tokens", "ids_crc32"],
            )

        return crc

    return map_batches(
        rows.select("id", "start", "n_tokens", "ids"), make, f"id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_files(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and read them back."""
    spark = docs.sparkSession
    path = new_table_path(spark, "token-files")
    write_token_files(docs, path, vocabulary, **options)
    return read_token_files(spark, path)
