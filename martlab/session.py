"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# All of these may be changed on a running session.
RUNTIME_SETTINGS = {
    # Zoneless times are measured through the session zone, so it must be one without clock changes.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose partitioning is used again by a later aggregate is only split when this is on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
STARTUP_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    # Recording the Python call site of every column expression makes building a wide plan several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set UTC, adaptive execution and skew splitting on an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "martlab", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC with ANSI casts; `conf` adds to or overrides the settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**STARTUP_SETTINGS, **RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir` of the cluster.

    Only a local master, where driver and executors share one machine, falls back to a new temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return tempfile.mkdtemp(prefix="martlab-")
