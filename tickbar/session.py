"""Session construction and the shared scratch location.

Jobs that write (staging, upserts, file round trips) put their output under
the cluster's shared ``spark.checkpoint.dir``.  The setting is read from the
session; only when it is unset (local tests, the bench) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings that the operators assume.  Everything else (memory,
# executor count, shuffle partitions at scale) belongs to the submitter.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tickbar", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, creating one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tickbar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint location."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tickbar-{spark.sparkContext.applicationId}"


def file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    store, at = file_system(spark, path)
    return store.exists(at)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder if it exists."""
    store, at = file_system(spark, path)
    store.delete(at, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application (once no frame that reads them is needed)."""
    store, at = file_system(spark, _scratch_root(spark))
    store.delete(at, True)
