"""Session settings the operators rely on.

Skewed joins are split by adaptive execution, so it has to be on, also where splitting costs
one more exchange. Broadcasts are left to Catalyst, which compares measured sizes with
``spark.sql.autoBroadcastJoinThreshold``; no operator forces one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings. The width of shuffles, ``spark.sql.shuffle.partitions``, is the job's to
    choose, at about 256 MB of input a partition: adaptive execution merges what turns out small,
    it never splits an aggregation's partitions."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
