"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Skewed join partitions are split even where that costs one more shuffle:
# a person, site or area may hold a third of the rows.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Turn on adaptive execution with skew splitting; returns the session.

    `shuffle_partitions` should make a partition of the largest shuffle 100 to
    200 MB; adaptive execution merges what turns out smaller.
    """
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions)
    return spark
