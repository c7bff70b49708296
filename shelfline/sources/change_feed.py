"""Row changes as a stream: ``op`` (I, U, D), ``seq`` and the row ``before`` and ``after``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Admission control: about what one micro-batch takes in when the feed is behind, in bytes of files;
# a larger file is taken whole, so this is no bound on memory. Streams that read tables anew in every
# batch should take much more at a time.
MAX_BYTES_PER_TRIGGER = 512 << 20


def change_schema(row: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("seq", T.LongType()),
            T.StructField("before", row),
            T.StructField("after", row),
        ]
    )


def read_changes(
    spark: SparkSession, path: str, row: T.StructType, max_bytes: int = MAX_BYTES_PER_TRIGGER
) -> DataFrame:
    """Stream of the change files that arrive below ``path``."""
    return (
        spark.readStream.schema(change_schema(row))
        .option("maxBytesPerTrigger", max_bytes)
        .parquet(path)
    )
