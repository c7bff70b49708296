"""Notification stream to one folder per route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shelfline.sources.notifications import classify_notifications
from shelfline.streaming.sinks import start, write_batch


def stream_notifications(notes: DataFrame, path: str, checkpoint: str, catch_up: bool = False) -> StreamingQuery:
    """Classify in the stream; every micro-batch writes all its routes in one pass."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id, partition_by=("route",))

    return start(classify_notifications(notes), checkpoint, handler=handle, catch_up=catch_up)
