"""Spark session with the settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does three jobs here: it merges small shuffle partitions, splits skewed
# ones (a key holding a third of the rows ends up in many tasks), and turns a
# join into a broadcast only after the real size of a side is known. Before that
# Spark only knows file sizes; the compression factor makes it take 10 MB of
# parquet for the 40 MB it is in memory, so that no large side is broadcast by
# an underestimate.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

TARGET_SHUFFLE_BYTES = 200 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Partitions that keep one shuffle task near 200 MB and every core busy."""
    by_size = -(-shuffle_bytes // TARGET_SHUFFLE_BYTES)
    return int(max(by_size, cores, 1))


def get_session(
    app: str = "smelter",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session; `conf` wins over the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
