"""Session helpers: the settings the library relies on, and the shared folder
used to cut lineage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings the library assumes; ``configure`` applies them to an existing session.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_SETTINGS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or unknown on this build
            pass
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tableload") -> SparkSession:
    """Session for tests and benchmarks (local mode, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for lineage cuts and scratch tables:
    ``spark.checkpoint.dir`` from the session.  A local master, whose executors are
    this machine, may leave it unset; then the context's checkpoint folder serves, or a
    folder under the system temp dir is made one.  Elsewhere an unset folder is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master {master})")
        path = spark.sparkContext.getCheckpointDir() or os.path.join(os.environ.get("TMPDIR", "/tmp"), "tableload-checkpoints")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex[:12]}"
