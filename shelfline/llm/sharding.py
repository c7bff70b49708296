"""Records dealt over weighted shards by rendezvous hashing.

Every shard draws a score for a record from a hash of the record's key and the shard's number; the
record goes to the shard with the best one. A shard's score does not depend on the other shards, so a
further shard takes records only into itself, one that goes gives up its own only, and a shard gets
records in proportion to its weight. Shards are written as folders ``shard=N``; nothing but the key,
the shards' numbers and their weights decides, so no table of places has to be kept.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.ordered import indexed

#: Hexadecimal digits of a hash that make a score: 52 bits, exact as a double.
_DIGITS = 13


def _scored(key: Column, shard: int, weight: float) -> Column:
    """A shard's score for a record, smallest wins: exponential with the weight as rate."""
    hashed = F.md5(F.concat(key, F.lit(f":{shard}")))
    draw = F.conv(F.substring(hashed, 1, _DIGITS), 16, 10).cast("double") + F.lit(0.5)
    return F.struct((-F.log(draw / F.lit(16.0**_DIGITS)) / F.lit(float(weight))).alias("score"), F.lit(shard).alias("shard"))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Struct ``score, shard``: the shard, by number from 0, that a record with this (string) key
    goes to. A shard of weight 0 takes nothing; equal scores go to the lower number."""
    if not weights or any(not math.isfinite(w) or w < 0 for w in weights) or not any(weights):
        raise ValueError("weights are finite, not negative and not all zero")
    scores = [_scored(key, i, w) for i, w in enumerate(weights) if w]
    return F.least(*scores) if len(scores) > 1 else scores[0]


def record_key(key: Column, content: Column) -> Column:
    """The key as text; where it is null, the content's digest stands in."""
    return F.coalesce(key.cast("string"), F.concat(F.lit("content:"), F.md5(F.coalesce(content.cast("string"), F.lit("")))))


def write_shards(docs: DataFrame, folder: str, weights: Sequence[float], key: str = "doc_id", text: str = "text", added: float | None = None) -> DataFrame:
    """Write the rows below ``folder`` as ``shard=N`` folders and read them back as ``shard, grown, seq,
    record``: the whole row is the struct ``record``, so its columns may have any name; ``seq`` orders a
    shard's files; ``grown`` is the shard with one more of weight ``added`` (null without one).

    Rows of a shard are gathered by a rebalancing shuffle, which splits what is more than a file's
    worth: neither a heavy shard nor one key with most rows becomes one task. Rows with one key share
    a shard, repeated rows too; rows without key are dealt by their text. An empty table makes empty
    folders.
    """
    spark = docs.sparkSession
    named = record_key(F.col(f"`{key}`"), F.col(f"`{text}`"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), rendezvous(named, weights).alias("best"), named.alias("named"))
    if added is None:
        grown = F.lit(None).cast("int")
    else:
        # The old best is the best of the old ones: only the new shard's score is drawn again.
        grown = F.least("best", _scored(F.col("named"), len(weights), added)).getField("shard")
    rows = rows.select(F.col("best.shard").alias("shard"), grown.alias("grown"), "record")
    gathered = rows.hint("rebalance", F.col("shard")).sortWithinPartitions("shard", F.col("record").getField(key))
    gathered = gathered.withColumn("seq", F.monotonically_increasing_id())
    gathered.write.partitionBy("shard").parquet(folder)
    return spark.read.schema(gathered.schema).parquet(folder).select("shard", "grown", "seq", "record")


def manifest(shards: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, shard, slot, grown`` of every record of written shards. ``size`` is its
    text's bytes in UTF-8 and 8 more (a null text has none), ``slot`` its place in its shard by key
    (null first), then size, checksum and file: small rows are ranged, a shard is no one task's work."""
    said = F.col("record").getField(text)
    rows = shards.select(
        "shard", F.col("record").getField(key).alias("key"), (F.coalesce(F.octet_length(said), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(said, F.lit(""))).alias("text_crc32"), "seq", "grown",
    )
    placed = indexed(rows, ["shard", "key", "size", "text_crc32", "seq"])
    counts = shards.groupBy("shard").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # a row a shard
    starts = counts.select("shard", F.coalesce(earlier, F.lit(0)).alias("_start"))
    slots = placed.join(starts, "shard").withColumn("slot", F.col("index") - F.col("_start"))
    return slots.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot", "grown")
