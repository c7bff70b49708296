"""Change streams to recomputed statuses."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfline.functions import constants as C
from shelfline.operators import propagate
from shelfline.operators.delivery import stock_change_records
from shelfline.plans.lookup import lookup_join
from shelfline.plans.buckets import BUCKETS
from shelfline.streaming.sinks import start, write_batch
from shelfline.streaming.state import KeyedState

# The columns of any changed row that decide which items it affects.
ROW = (
    T.StructType()
    .add("ks", T.LongType())
    .add("invoice_no", T.LongType())
    .add("order_no", T.LongType())
    .add("released_at", T.TimestampNTZType())
)


def tagged(changes: DataFrame, kind: str) -> DataFrame:
    """Changes of one table in the common form: ``kind, op, before, after`` with :data:`ROW`."""

    def row(side: str):
        present = changes.schema[side].dataType.names
        fields = [
            (F.col(f"{side}.{f.name}") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in ROW
        ]
        return F.struct(*fields).alias(side)

    return changes.select(F.lit(kind).alias("kind"), "op", row("before"), row("after"))


def affected_items(
    changes: DataFrame, tables: dict[str, DataFrame], triggering_exclusions: Collection[int] = C.UNTRIGGERED_SUPPLIERS
) -> DataFrame:
    """Distinct items affected by tagged changes of payments, reserves and order lines."""

    def of(kind: str) -> DataFrame:
        return changes.where(F.col("kind") == kind)

    return (
        propagate.affected_by_payments(of("payment"), tables["invoice_line"])
        .unionByName(propagate.affected_by_reserves(of("reserve")))
        .unionByName(propagate.affected_by_orders(of("order_line"), tables["purchase_order"], triggering_exclusions))
        .distinct()
    )


def with_written_status(content: DataFrame, written: DataFrame) -> DataFrame:
    """``content`` with the status that the stream last wrote for an item, ``written(ks, clc)``."""
    newest = written.select("ks", F.col("clc").alias("_clc"))
    kept = [c if c != "stock_status" else F.coalesce(F.col("_clc").cast(content.schema[c].dataType), c).alias(c) for c in content.columns]
    return lookup_join(content, newest, "ks").select(*kept)


def stream_recompute(
    changes: DataFrame,
    tables: Callable[[], dict[str, DataFrame]],
    folder: str,
    checkpoint: str,
    catch_up: bool = False,
    triggering_exclusions: Collection[int] = C.UNTRIGGERED_SUPPLIERS,
    labels: C.Labels = C.Labels(),
    buckets: int = BUCKETS,
    **rules,
) -> StreamingQuery:
    """Recompute the affected items of every micro-batch of tagged ``changes``.

    ``tables`` is called by every batch, so that it reads the tables as they are by then: those of
    :func:`shelfline.operators.propagate.recompute_status`, ``invoice_line``, and, for change rows,
    ``modification``, ``device`` and ``availability``. Writes ``folder/status`` (``ks, cur, clc``;
    the stored status ``cur`` counts what earlier batches wrote), ``folder/changes`` (a change row for
    every item whose status moved) and ``folder/rejects``. What was last written for an item is state
    (``folder/state``): a batch reads and rewrites the buckets of its items, not the history. A
    repeated batch replaces its results. The affected keys go to one of two folders by turns.
    """
    spark = changes.sparkSession
    state = KeyedState(spark, f"{folder}/state", "ks LONG, clc INT", "ks", buckets=buckets)

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = dict(tables())
        affected = affected_items(batch, now, triggering_exclusions)
        place = f"{folder}/affected/{batch_id % 2}"
        affected.write.mode("overwrite").parquet(place)
        keys = spark.read.schema(affected.schema).parquet(place)
        keys = keys.select(F.col("ks").cast("long").alias("ks"))
        touched = state.buckets_of(keys)
        held = state.before(batch_id, touched)
        now["content"] = with_written_status(now["content"], held)
        dated = propagate.recompute_dated_status(keys, now, **rules).persist()
        if "modification" in now:
            moved = propagate.status_changes(dated)
            made = stock_change_records(moved, now["modification"], now["device"], None, now["availability"], labels)
            write_batch(made.records, f"{folder}/changes", batch_id)
            write_batch(made.rejected, f"{folder}/rejects", batch_id)
        write_batch(dated.select("ks", "cur", "clc"), f"{folder}/status", batch_id)
        state.fold(batch_id, held, touched, dated.select("ks", "clc"))
        dated.unpersist()

    return start(changes, checkpoint, handler=handle, catch_up=catch_up)
