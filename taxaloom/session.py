"""Session settings the operators count on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# AQE re-plans joins by measured size, merges small shuffle partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benches on one machine; on a cluster the session comes from the submit command."""
    scratch = tempfile.mkdtemp(prefix="spark-")
    builder = SparkSession.builder.master(f"local[{cores}]").appName("taxaloom")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", memory))
        .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .config("spark.local.dir", scratch).config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse")).getOrCreate()
    )
