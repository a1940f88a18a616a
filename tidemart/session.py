"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on; a cluster sets its own shuffle and memory sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Scratch folders of sessions on this machine; they go with the process.
LOCAL: list[tempfile.TemporaryDirectory] = []


def local_session(name: str, cpus: int | str = 8, **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    local = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        # Without the place in the Python code that each column expression comes from, plans are built faster.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**SETTINGS, **local, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepared(spark: SparkSession) -> SparkSession:
    """A session that was made elsewhere, with the settings the jobs rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the checkpoint folder the cluster names (shared by all executors).

    Only where none is set, as on a single machine, a temporary folder is used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        LOCAL.append(tempfile.TemporaryDirectory(prefix="tidemart-", ignore_cleanup_errors=True))
        base = LOCAL[-1].name
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
