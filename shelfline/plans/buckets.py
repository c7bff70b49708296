"""Tables cut into buckets of a key, so that few keys are looked up in few files.

A bucket is a folder ``bucket=N``. What a batch of keys needs is known by their buckets, at most as
many numbers as there are buckets, and they are literals of the plan: other folders are not listed
among the files of a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.plans.lookup import lookup_join

BUCKET = "bucket"
#: Default; about as many as the table has files of a good size.
BUCKETS = 64


def bucket_of(key: str | Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a key. Keys of different whole-number types share one."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched(keys: DataFrame, key: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets of the keys: at most ``buckets`` numbers reach the driver."""
    return sorted(r[0] for r in keys.select(bucket_of(key, buckets)).distinct().collect())


def write_index(rows: DataFrame, folder: str, key: str, buckets: int = BUCKETS) -> None:
    """Write distinct ``rows`` below ``folder`` by the bucket of their (long) ``key``. Rows are gathered
    by a rebalancing shuffle: a bucket of a hot key becomes several files and no one task's work."""
    placed = rows.withColumn(key, F.col(key).cast("long")).distinct().withColumn(BUCKET, bucket_of(key, buckets))
    placed.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)


def look_up(spark: SparkSession, folder: str, schema: T.StructType, keys: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows of an index whose ``key`` is among ``keys``: only their buckets are read."""
    keys = keys.select(F.col(key).cast("long")).where(F.col(key).isNotNull()).distinct()
    whole = T.StructType([*[f if f.name != key else T.StructField(key, T.LongType()) for f in schema.fields], T.StructField(BUCKET, T.IntegerType())])
    found = spark.read.schema(whole).parquet(folder).where(F.col(BUCKET).isin(touched(keys, key, buckets)))
    return lookup_join(found, keys, key, "left_semi").select(*schema.names)
