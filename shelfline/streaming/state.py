"""State of a stream that is kept in files and stays as large as its keys.

Rows live in buckets of their key. A micro-batch reads the buckets its keys are in and rewrites those,
whole: what earlier batches knew is folded in, so a bucket never holds more than one row a key, and a
late batch reads no more files than an early one. Each bucket has two slots. A batch reads the slot
with the newest earlier batch and writes the other one, so a repeated batch finds what it found
before and replaces what it wrote; nothing is deleted and no batch sees its own result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.plans.buckets import BUCKET, BUCKETS, bucket_of, touched
from shelfline.plans.lookup import lookup_join

SLOT, BATCH = "slot", "batch"


class KeyedState:
    """Rows of ``schema`` below ``folder``, by the bucket of the column ``key``. ``unique`` are the columns
    that name a row (the key alone, if not given)."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, key: str, unique: Sequence[str] | None = None, buckets: int = BUCKETS):
        self._spark, self._folder, self._key, self._buckets = spark, folder, key, buckets
        self._schema = T.StructType.fromDDL(schema)
        self.unique = list(unique or [key])

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets of a batch's keys."""
        return touched(keys, self._key, self._buckets)

    def _stored(self, buckets: Sequence[int]) -> DataFrame:
        stored = T.StructType([*self._schema.fields]).add(BATCH, T.LongType()).add(BUCKET, T.IntegerType()).add(SLOT, T.IntegerType())
        try:
            found = self._spark.read.schema(stored).parquet(self._folder)
        except AnalysisException as missing:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self._spark.createDataFrame([], stored)
        return found.where(F.col(BUCKET).isin(list(buckets)))

    def _slots(self, batch_id: int, buckets: Sequence[int]) -> tuple[list[int], list[int]]:
        """The buckets whose newest batch before this one lies in slot 0, and in slot 1."""
        seen = self._stored(buckets).where(F.col(BATCH) < batch_id)
        newest = seen.groupBy(BUCKET).agg(F.max_by(SLOT, BATCH).alias(SLOT)).collect()  # a row a bucket
        return [r[BUCKET] for r in newest if r[SLOT] == 0], [r[BUCKET] for r in newest if r[SLOT] == 1]

    def before(self, batch_id: int, buckets: Sequence[int]) -> DataFrame:
        """All rows of the buckets as the batches before ``batch_id`` left them. Only the folders that
        hold them are read, and this batch does not write there."""
        first, second = self._slots(batch_id, buckets)
        held = (F.col(SLOT) == 0) & F.col(BUCKET).isin(first) | (F.col(SLOT) == 1) & F.col(BUCKET).isin(second)
        return self._stored(buckets).where(held).select(*self._schema.names)

    def write(self, batch_id: int, buckets: Sequence[int], rows: DataFrame) -> None:
        """Replace the buckets by ``rows``, all that they hold after this batch. A row that has to go
        from the state stays in it, marked by its values: a bucket must not become empty unseen."""
        first, _ = self._slots(batch_id, buckets)
        placed = rows.select(*[F.col(f.name).cast(f.dataType) for f in self._schema.fields]).withColumn(BUCKET, bucket_of(self._key, self._buckets))
        placed = placed.withColumn(SLOT, F.when(F.col(BUCKET).isin(first), 1).otherwise(0)).withColumn(BATCH, F.lit(batch_id).cast("long"))
        gathered = placed.hint("rebalance", F.col(BUCKET))
        gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, SLOT).parquet(self._folder)

    def fold(self, batch_id: int, known: DataFrame, buckets: Sequence[int], rows: DataFrame) -> None:
        """Write ``known``, the buckets as they were, with ``rows`` in the place of those of their names."""
        kept = lookup_join(known, rows.select(*self.unique), self.unique, "left_anti")
        self.write(batch_id, buckets, kept.unionByName(rows.select(*self._schema.names)))
