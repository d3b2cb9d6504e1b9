"""Spark session helpers.

The engine never hard-codes cluster settings: on a real cluster the session is
created by the platform and we only read from it.  ``get_session`` is for local
runs and tests; it configures only a session that it creates itself.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings applied to sessions we create ourselves (tests, bench, local runs).
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    # Pages are large rows: keep Arrow batches into the one Python stage small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "docweave") -> SparkSession:
    """The running session as it is, or a new local one with LOCAL_DEFAULTS."""
    builder = SparkSession.builder
    if SparkContext._active_spark_context is None:
        builder = builder.appName(app)
        if master:
            builder = builder.master(master)
        for k, v in LOCAL_DEFAULTS.items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to a shared file system.  Where it is
    unset and Spark runs on this machine alone, as in tests, we make a scratch
    folder and remove it when Python ends; on a cluster that is an error, since
    each executor would write to its own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="docweave-ckpt-", dir=os.environ.get("DOCWEAVE_SCRATCH", "/tmp"))
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet to the shared checkpoint folder
    and read it back (survives executor loss; never a machine-local cache; later
    reads prune columns, and partitions by ``partition_by``).  Used where a
    frame feeds a recursive CTE or several consumers."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that a run has written, through the cluster's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark, path: str) -> bool:
    """Existence test on the cluster's file system (HDFS, object store, …),
    not on the driver's local disk."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
