"""SparkSession defaults and the pipeline configuration object."""

from __future__ import annotations

import datetime as dt
import os
import tempfile
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Fixed evaluation date used instead of CURRENT_DATE()/CURRENT_TIMESTAMP() so
# that every run (and the SQL oracle) sees the same "today".
DEFAULT_AS_OF = dt.date(2001, 8, 2)


@dataclass(frozen=True)
class PipelineConfig:
    """Run-level parameters shared by every model.

    ``as_of``      the evaluation date ("today"); timestamp comparisons use
                   ``as_of`` at 00:00 UTC.
    ``broadcast_max_rows``  largest dimension that may be broadcast after a
                   row count proves its size; larger ones go through a shuffle
                   join (AQE may still convert at runtime).
    """

    as_of: dt.date = DEFAULT_AS_OF
    broadcast_max_rows: int = 2_000_000
    reuse: bool = True
    strict_casts: bool = True

    @property
    def as_of_ts(self) -> dt.datetime:
        return dt.datetime(self.as_of.year, self.as_of.month, self.as_of.day)


SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # surrogate keys are hexadecimal text, which only a codec with entropy coding makes smaller
    "spark.sql.parquet.compression.codec": "zstd",
    # listing thousands of daily partition folders: a bounded number of tasks
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to an existing session.

    Only SQL settings that may change at runtime are touched; the checkpoint
    folder is set only when the cluster has not named one.
    """
    for key, value in SESSION_DEFAULTS.items():
        if key == "spark.ui.enabled":
            continue
        if spark.conf.isModifiable(key):  # a static one: keep the cluster's
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is kept as
    is; a cluster without it is an error, as a machine-local folder would be
    a different one on each executor.  Local runs (tests) get a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="fareflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fareflow") -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # a running session and spark-submit bring their own sizes; only a plain local start gets defaults
    sized = SparkSession.getActiveSession() is not None or "PYSPARK_GATEWAY_PORT" in os.environ
    parts = shuffle_partitions or os.environ.get("FAREFLOW_SHUFFLE_PARTITIONS") or (None if sized else 8)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    if not sized:
        builder = builder.config("spark.driver.memory", os.environ.get("FAREFLOW_DRIVER_MEMORY", "16g"))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (one listing call per path)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def tune_for_input(spark: SparkSession, total_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> int:
    """Size shuffles and scan splits for ``total_bytes`` of input.

    The initial shuffle partition count gives ~``partition_bytes`` per
    partition for a shuffle as large as the input (AQE then coalesces the
    smaller shuffles to the same advisory size), so no reduce task has to hold
    more than a few hundred MB and spills stay rare.  Returns the count.
    """
    parts = max(200, -(-total_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(4 * partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(2 * partition_bytes))
    return parts
