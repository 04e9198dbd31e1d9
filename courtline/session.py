"""Session builder."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles: the starting number of partitions is only an upper bound
# that gets coalesced towards the advisory size, and skewed joins and rebalances are split.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def create_spark_session(app_name: str = "courtline", **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` overrides (underscores stand for dots)."""
    builder = SparkSession.builder.appName(app_name)
    overrides = {k.replace("_", "."): v for k, v in conf.items()}
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
