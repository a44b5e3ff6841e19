"""Session settings the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Overflowing casts raise, as the decimal columns of a database would.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits an oversized join partition, e.g. one email holding a third of the rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Recording the call site of every column expression makes queries slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "tallyroll", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with the settings above; ``settings`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
