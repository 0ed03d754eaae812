"""Session settings the operators rely on.

On a cluster the settings come from the cluster; `build_session` is for tests,
the bench and notebooks. Nothing here names a folder: streaming checkpoints and
written stores take their location from the caller or `spark.checkpoint.dir`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution carries the scale story: it sizes shuffle partitions,
# splits skewed join partitions and turns a shuffle join into a broadcast join
# only when the measured side is under the threshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "gridclimate", master: str | None = None, **extra: str) -> SparkSession:
    """Create or fetch a session; `extra` holds more `spark.*` settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
