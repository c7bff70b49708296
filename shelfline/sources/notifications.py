"""Notifications ``(channel, payload)`` split by what they ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import constants as C
from shelfline.functions.text import SEPARATOR

REJECTED = "rejected"
ROUTES = (C.CHANNEL_COMPUTE, C.CHANNEL_EXPECTED, C.CHANNEL_EXPORT)


def classify_notifications(notes: DataFrame) -> DataFrame:
    """``notes`` with ``route``, ``target_id``, ``mod_id`` and ``expected``.

    Compute and export messages carry an id, expected-shipment messages modification, text and
    id. Unknown channels and payloads that do not parse are routed to ``rejected``.
    """
    parts = F.split("payload", f"\\{SEPARATOR}", -1)
    three = (F.col("channel") == C.CHANNEL_EXPECTED) & (F.size(parts) == 3)
    single = F.col("channel").isin(C.CHANNEL_COMPUTE, C.CHANNEL_EXPORT)
    number = F.when(three, F.element_at(parts, 3)).when(single, F.col("payload")).try_cast("long")
    parsed = F.coalesce(F.col("channel").isin(*ROUTES), F.lit(False)) & number.isNotNull()
    return notes.withColumns(
        {
            "route": F.when(parsed, F.col("channel")).otherwise(REJECTED),
            "target_id": F.when(parsed, number),
            "mod_id": F.when(parsed & three, F.element_at(parts, 1)),
            "expected": F.when(parsed & three, F.element_at(parts, 2)),
        }
    )


def write_routes(notes: DataFrame, path: str) -> None:
    """One folder per channel, and ``rejected``, from one pass over the notifications."""
    classify_notifications(notes).write.mode("overwrite").partitionBy("route").parquet(path)


def route_notifications(notes: DataFrame) -> dict[str, DataFrame]:
    """One DataFrame per channel, and ``rejected``."""
    classified = classify_notifications(notes)
    columns = {
        C.CHANNEL_COMPUTE: ["target_id"],
        C.CHANNEL_EXPORT: ["target_id"],
        C.CHANNEL_EXPECTED: ["target_id", "mod_id", "expected"],
        REJECTED: [],
    }
    return {
        route: classified.where(F.col("route") == route).select(*notes.columns, *kept) for route, kept in columns.items()
    }
