"""Session helpers: local sessions for tests and the bench, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "capsight",
                  **conf: str) -> SparkSession:
    """A local session with the settings the jobs assume (AQE on, UI off, UTC); ``conf`` adds more."""
    builder = SparkSession.builder
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CAPSIGHT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="capsight-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster it must be set: a machine-local folder would be lost with its machine.
    Only a local master without one (runs on one machine, tests) gets a fresh scratch folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="capsight-ckpt-"))
    return named or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (for written tables and stream state)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def write_scratch(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
