"""Helpers shared by the operators: the cluster's shared folder and row maps.

The shared folder is the one named by ``spark.checkpoint.dir``.  Only a local
session that names none gets a scratch folder, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.session import delete_at_exit

# Rows per Arrow batch; texts of many kilobytes keep a batch at some megabytes.
BATCH_ROWS = 500


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="cityweave-llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh table path in the shared folder; its files go when the driver ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of the shared folder,
    not a new run of the stages above.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, so that long texts don't pile up in a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) != BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str
) -> DataFrame:
    """Apply ``make()(batch)`` to every Arrow batch; ``make`` runs once a task."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            if batch.num_rows and (out := f(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def text_digest(text: str) -> Column:
    """First 128 bits of a text's SHA-256; null counts as empty, so it is never null."""
    return F.coalesce(F.substring(F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)), 1, 16), F.lit(b""))
