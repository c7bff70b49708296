"""Exports whose stages answer over time.

An export is remembered from its start, or from an answer that comes before it, until every planned
stage has answered, one failed, or its patience ran out. The state of an export is three numbers, and
none is kept for longer than the patience, so the state holds what is under way and not what ever was.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# As in shelfline.streaming.stateful: the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EVENTS = "exp_id BIGINT, event STRING, answered INT, missing INT"
_NAMES = ["exp_id", "event", "answered", "missing"]


class Stages(StatefulProcessor):
    """One export: its planned stages (-1 before its start), those that answered, and when it expires."""

    def __init__(self, patience_ms: int):
        self._patience = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("stages", "planned INT, answered INT, due BIGINT")

    def _forget(self, due: int | None) -> None:
        if due is not None:
            self._handle.deleteTimer(due)
        self._state.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        planned, answered, due = self._state.get() if self._state.exists() else (-1, 0, None)
        failed, begun = False, None
        for frame in rows:
            starts = frame[frame["stage"] == 0]
            if len(starts):
                planned = int(starts["planned"].max())
            answers = frame[frame["stage"] != 0]
            failed = failed or bool(answers["failed"].any())
            for stage in answers["stage"].unique():
                answered |= int(stage)
            # The start decides when the wait ends; before it, the first answer does.
            first = int((starts if len(starts) else answers)["at_ms"].min())
            begun = first if len(starts) or begun is None else min(begun, first)
            if len(starts) and due is not None:
                self._handle.deleteTimer(due)
                due = None
        answered_of_plan = answered & planned if planned >= 0 else answered
        missing = planned & ~answered if planned >= 0 else 0
        if failed or (planned >= 0 and missing == 0):
            self._forget(due)
            event = "failed" if failed else "finished"
            yield pd.DataFrame([(int(key[0]), event, answered_of_plan, missing)], columns=_NAMES)
            return
        if due is None:
            due = begun + self._patience
            self._handle.registerTimer(due)
        self._state.update((planned, answered, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self._state.exists():
            return
        planned, answered, due = self._state.get()
        if expiredTimerInfo.getExpiryTimeInMs() < due:
            return
        self._state.clear()
        known = planned >= 0
        row = (int(key[0]), "expired" if known else "unplanned", answered & planned if known else answered, planned & ~answered if known else 0)
        yield pd.DataFrame([row], columns=_NAMES)

    def close(self) -> None:
        pass


def stream_stages(events: DataFrame, patience_ms: int, delay: str = "1 hour") -> DataFrame:
    """Follow exports by ``events(exp_id, at, stage, planned, failed)``: a start has stage 0 and the mask of
    planned stages, an answer has its stage and whether it failed.

    One row for each export that ends: ``exp_id, event, answered, missing`` with event ``finished``;
    ``failed`` at the first failed answer; ``expired`` when ``patience_ms`` after its start answers
    are still missing; ``unplanned`` when answers came and no start within that time. Answers of stages that are
    not planned do not count, repeated ones count once. Time is that of the events: exports expire
    when later events have come, and an event more than ``delay`` behind the newest one is too late and
    ignored. Events without an export or a time are left out. The session has to keep state in RocksDB, see
    :func:`shelfline.streaming.stateful.use_rocksdb`.
    """
    at = F.col("at").cast("timestamp")
    named = events.where("exp_id IS NOT NULL AND at IS NOT NULL").select(
        F.col("exp_id").cast("long").alias("exp_id"),
        at.alias("at"),
        F.unix_millis(at).alias("at_ms"),
        F.coalesce(F.col("stage").cast("int"), F.lit(0)).alias("stage"),
        F.coalesce(F.col("planned").cast("int"), F.lit(0)).alias("planned"),
        F.coalesce("failed", F.lit(False)).alias("failed"),
    )
    return named.withWatermark("at", delay).groupBy("exp_id").transformWithStateInPandas(
        statefulProcessor=Stages(patience_ms), outputStructType=EVENTS, outputMode="append", timeMode="eventTime"
    )
