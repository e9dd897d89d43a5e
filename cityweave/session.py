"""Session settings the marts rely on.

Only runtime SQL confs are touched; cluster sizing belongs to the caller.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Event times are stored as UTC wall-clock strings; month/week/local-time
# results are only well defined when the session reads them as UTC.
SESSION_TIME_ZONE = "UTC"

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": SESSION_TIME_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot (channel, cell) or user keys are split at runtime by AQE
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the time zone and make sure AQE (incl. skew-join splitting) is on."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or the context's current directory).  Only
    a session in one process, with neither, gets a scratch folder; elsewhere a
    machine-local folder would be wrong, so the setting is required there.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="cityweave-ckpt-")
        sc.setCheckpointDir(folder)
    return folder


class ScratchTables:
    """Stage tables of one run in the shared folder, deleted when the run ends.

    ``with ScratchTables(spark) as t: df = t.table("members", df)`` writes the
    rows once and reads them back: consumers share them, and a lost executor
    re-reads files instead of running the stages above again.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._root = f"{checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"

    def __enter__(self) -> ScratchTables:
        return self

    def table(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self._root}/{name}"
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *exc) -> None:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._root)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_table(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The files go when the driver ends; a job that ends earlier uses ``ScratchTables``.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


# Target bytes per shuffle partition after AQE coalescing, and per input split.
PARTITION_BYTES = 256 * 1024 * 1024


def cluster_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves about ``shuffle_bytes``.

    At least ~2 partitions per core, and enough that each holds about
    ``PARTITION_BYTES`` (so a task's share fits an executor without spilling
    much); AQE then coalesces small ones and splits skewed ones.  For the
    event log, the largest shuffle is roughly the projected message and
    subscription columns of the window: a few percent of the raw bytes.
    """
    partitions = max(2 * cores, -(-int(shuffle_bytes) // PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(PARTITION_BYTES),
    }


def apply_cluster_conf(spark: SparkSession, shuffle_bytes: int) -> dict[str, str]:
    """Apply ``cluster_conf`` for keys the launch configuration left unset."""
    launched = spark.sparkContext.getConf()
    applied = {}
    conf = cluster_conf(shuffle_bytes, spark.sparkContext.defaultParallelism)
    for key, value in conf.items():
        if not launched.contains(key):
            spark.conf.set(key, value)
            applied[key] = value
    return applied
