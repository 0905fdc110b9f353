"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings that every job here relies on.  Anything about sizes (shuffle
# partitions, memory) belongs to the cluster, so it is left alone: AQE starts from
# the cluster's shuffle.partitions and coalesces or splits from there.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Batches for Python by size as well as by rows: long texts would fill workers, and the
    # JVM's buffers beside its heap.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def local_session(cores: str | int = 8, app: str = "hemeroteca", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply(spark: SparkSession) -> SparkSession:
    """Give any session the run-time settings that results, and the memory of workers, depend on."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Cut a session's Arrow batches by size, unless it says itself how large they may be.

    By Spark's defaults a batch for Python holds up to 10,000 texts or 64 MB, once for each core of an executor.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, ENGINE_CONF[key])


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-path of the folder all executors share, as named by ``spark.checkpoint.dir``.

    A session that runs in a single JVM has one disk, so there a temp folder will do.
    Anywhere else a missing setting is an error, raised before any work.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="hemeroteca-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
