"""Session settings and the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings for the session that runs the jobs: joins back to group totals and hop joins may meet a key that
# holds a large part of the rows, so skewed join partitions are split even where that costs a shuffle.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Most bytes of a coalesced partition, and bytes of input per partition before coalescing: a task gets no more of
#: a larger input, and shuffles of less become fewer tasks again.
PARTITION, INPUT_PER_PARTITION = 16 * 2**20, 4 * 2**20


def tune(spark: SparkSession, sf_dir: str | None = None) -> SparkSession:
    """Settings of a session; partitions before coalescing in proportion to the tables in ``sf_dir``."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if size(spark.conf.get(ADVISED)) > PARTITION:
        spark.conf.set(ADVISED, str(PARTITION))
    if sf_dir is not None:
        at, fs = hadoop_path(spark, sf_dir)
        wanted = fs.getContentSummary(at).getLength() // INPUT_PER_PARTITION
        spark.conf.set(INITIAL, str(max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/footfall/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    return f"{folder or run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(path, file system) of any location Spark can write to. The one place that needs the JVM
    gateway of a classic session; Spark Connect has none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def release(spark: SparkSession, folder: str | None = None) -> None:
    """Delete intermediate tables once the results are saved: a folder's, or all of this application."""
    at, fs = hadoop_path(spark, folder or run_dir(spark))
    fs.delete(at, True)
