"""Session settings and the shared folder that runs write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run wants. Sizes are left to the cluster's own configuration: adaptive
# execution merges small shuffle partitions and splits skewed ones at run time.
RUN_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Return a session with the run settings; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUN_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, name: str = "run") -> str:
    """Return a fresh folder for the tables and checkpoints of one run.

    The folder lies below ``spark.checkpoint.dir``, which all executors of a cluster share.
    A machine-local folder is used in local mode only, where that setting may be absent.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
