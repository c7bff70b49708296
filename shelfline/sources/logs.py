"""The audit log of status computations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def transition_log(status: DataFrame, as_of: str) -> DataFrame:
    """One log row per computed item, also when nothing changed: ``num, operation, dt``. The text
    is NULL when the stored status is."""
    return status.select(
        F.col("ks").cast("string").alias("num"),
        F.concat(F.col("cur").cast("string"), F.lit("->"), F.col("clc").cast("string")).alias("operation"),
        F.lit(as_of).cast("timestamp_ntz").alias("dt"),
    )


def append_log(log: DataFrame, path: str) -> None:
    """Append to the log, one folder per day so that readers can skip days."""
    log.withColumn("day", F.to_date("dt")).write.mode("append").partitionBy("day").parquet(path)
