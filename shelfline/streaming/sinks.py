"""Running streams into folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: how often the production listeners look for work.
POLL = "5 seconds"


def start(
    stream: DataFrame,
    checkpoint: str,
    handler: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    catch_up: bool = False,
) -> StreamingQuery:
    """Start ``stream`` into a ``handler`` for micro-batches or a parquet ``path``. ``catch_up``
    works off what is there and stops."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if catch_up else writer.trigger(processingTime=POLL)
    if handler is not None:
        return writer.foreachBatch(handler).start()
    return writer.format("parquet").option("path", path).start()


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Write a micro-batch's result into its own folder: a repeated batch replaces itself."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/batch={batch_id}")
