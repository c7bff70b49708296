"""Duplicate suppression over a stream of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfline.operators.changes import suppress_repeats
from shelfline.plans.lookup import lookup_join
from shelfline.plans.buckets import BUCKETS
from shelfline.streaming.sinks import start, write_batch
from shelfline.streaming.state import KeyedState

STATE = "mod_id STRING, id LONG, time_delivery STRING, qnt STRING, dbl_cnt LONG"


def stream_dedupe(changes: DataFrame, folder: str, checkpoint: str, catch_up: bool = False, buckets: int = BUCKETS) -> StreamingQuery:
    """Stream form of :func:`shelfline.operators.changes.suppress_repeats`.

    Every micro-batch runs the sliced batch form over its rows and the last row of each of its
    modifications, so no task holds all rows of one. Writes ``folder/out`` (the judged rows),
    ``folder/late`` (rows whose id is not above the last one seen for their modification: they come
    too late to be judged) and ``folder/state``, one row for each modification: a batch reads and
    rewrites the buckets its modifications are in. A repeated batch finds the state of those before it
    and replaces what it wrote.
    """
    quantity = changes.schema["qnt"].dataType
    rows = changes.select("id", "mod_id", "time_delivery", F.col("qnt").cast("string").alias("qnt"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        state = KeyedState(spark, f"{folder}/state", STATE, "mod_id", buckets=buckets)
        touched = state.buckets_of(batch)
        held = state.before(batch_id, touched)
        known = lookup_join(held, batch.select("mod_id").distinct(), "mod_id", "left_semi").persist()
        judged = lookup_join(batch, known.select("mod_id", F.col("id").alias("_last")), "mod_id")
        late = F.coalesce(F.col("id") <= F.col("_last"), F.lit(False))
        write_batch(judged.where(late).drop("_last"), f"{folder}/late", batch_id)
        fresh = judged.where(~late).drop("_last")
        # The last row seen leads; it starts a run, and what it had suppressed is added to that run.
        found = suppress_repeats(fresh.unionByName(known.drop("dbl_cnt")))
        own = lookup_join(found, known.select("mod_id", F.col("id").alias("_led"), "dbl_cnt").withColumnRenamed("dbl_cnt", "_held"), "mod_id")
        own = own.where(F.col("_led").isNull() | (F.col("id") > F.col("_led")))
        first_sent = own.where("sent").groupBy("mod_id").agg(F.min("id").alias("_first"))
        own = lookup_join(own, first_sent, "mod_id")
        goes_on = F.col("_held").isNotNull() & (F.col("_first").isNull() | (F.col("id") < F.col("_first")))
        counted = F.col("dbl_cnt") + F.when(goes_on, F.col("_held")).otherwise(0)
        out = own.select("id", "mod_id", "time_delivery", "qnt", "sent", counted.alias("dbl_cnt")).persist()
        write_batch(out.withColumn("qnt", F.col("qnt").cast(quantity)), f"{folder}/out", batch_id)
        last = out.groupBy("mod_id").agg(F.max_by(F.struct("id", "time_delivery", "qnt", "dbl_cnt"), "id").alias("_last"))
        state.fold(batch_id, held, touched, last.where("mod_id IS NOT NULL").select("mod_id", "_last.*"))
        for frame in (out, known, batch):
            frame.unpersist()

    return start(rows, checkpoint, handler=handle, catch_up=catch_up)
