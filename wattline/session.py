"""Session settings and the shared folder for checkpoints and derived files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "wattline", cpus: int | None = None, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    master = f"local[{cpus}]" if cpus else "local[*]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Fix the session zone: raw times carry no zone and are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder under the checkpoint location that every executor can reach.

    The location comes from the session. Only a local session without one falls back to
    a temporary folder, because there driver and executors share one machine.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="wattline-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
