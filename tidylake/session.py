"""Session helpers: local sessions for tests/bench and shared scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the library relies on.  All are settable on an existing
# session, so a cluster-provided session keeps its own resources.
RUNTIME_CONF = {
    # timestamps are compared with an ANSI-SQL oracle and across machines
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows per Arrow batch handed to Python (HTML pages can be large)
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Broadcast only what was measured: the static planner would broadcast on
    # file-size *estimates* (compressed Parquet can expand many times), so it
    # is off; explicit broadcasts come from joins.checked_broadcast, and AQE may
    # still switch to a broadcast from the *measured* size of a shuffle output.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume; returns ``spark``.

    The settings stay on the caller's session: plans are lazy, so they must still
    hold when the returned DataFrames run.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "tidylake", driver_memory: str = "16g") -> SparkSession:
    """A ``local[cpus]`` session for tests and benchmarks (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions",
                str(shuffle_partitions or (os.cpu_count() if cpus == "*" else cpus)))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_NO_FOLDER = "set spark.checkpoint.dir to a folder that the driver and all executors share"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Every executor and the driver must reach it (HDFS/S3/...).  A session
    without the setting raises an error unless it runs in local mode, on one
    machine, where the session's checkpoint directory or a private temporary
    folder serves (tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        context = spark.sparkContext
    except Exception as exc:  # Spark Connect sessions have none
        raise ValueError(_NO_FOLDER) from exc
    root = context.getConf().get("spark.checkpoint.dir")
    if not root:
        if context.master.split("[")[0] != "local":
            raise ValueError(_NO_FOLDER)
        if not context.getCheckpointDir():
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tidylake-ckpt-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tidylake-scratch/{name}-{uuid.uuid4().hex}"
