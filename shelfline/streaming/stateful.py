"""Keyed state: delivery retries.

A change keeps its retry count and the resends it waits for in the state store, until its outcome is
final. Changes share buckets: a micro-batch's attempts of a bucket are one pandas frame, and their
state is read and written at once, so that a change costs neither a frame nor calls of its own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfline.functions.constants import BLOCKED, FAILED, RETRY_LIMIT, SENT
from shelfline.operators.delivery import is_transient
from shelfline.plans.buckets import bucket_of

# The processors travel to the executors whole: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Buckets of changes: a million open changes are some sixty a bucket.
RETRY_BUCKETS = 1 << 14

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Let the session's stateful streams keep their state in RocksDB, as :func:`stream_retry` needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class Retry(StatefulProcessor):
    """Count the transient failures of a bucket's changes and ask for resends until the limit."""

    def __init__(self, retry_limit: int, pause_ms: int):
        self._limit, self._pause = retry_limit, pause_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getListState("open", "id BIGINT, retry_cnt BIGINT")
        # The resends that the timer of a time stands for: timers of one time are one timer.
        self._due = handle.getListState("due", "id BIGINT, at BIGINT, resends BIGINT")

    @staticmethod
    def _keep(state, rows: list[tuple], held: bool) -> None:
        if rows:
            state.put(rows)
        elif held:
            state.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        attempts = pd.concat(list(rows), ignore_index=True).sort_values(["id", "seq"], kind="stable")
        counts = dict(self._open.get())
        known, changed = bool(counts), False
        out, waiting, settled = [], {}, set()
        told = attempts[["id", "ok", "transient", "retry_cnt"]].itertuples(index=False, name=None)
        for change_id, own in groupby(told, key=itemgetter(0)):
            count, waits, final = counts.get(change_id), 0, False
            for _, ok, transient, stored in own:
                count = int(stored) if count is None else count
                if ok:
                    status, again = SENT, False
                elif transient:
                    again = count <= self._limit
                    status = change_id if again else FAILED
                    count += 1
                else:
                    status, again, count = BLOCKED, False, 0
                out.append((change_id, "outcome", status, count, again))
                final = not again
                if final:
                    waits = 0
                elif self._pause:
                    waits += 1
                else:
                    out.append((change_id, "resend", status, count, again))
            if not final:
                counts[change_id], changed = count, True
            elif change_id in counts:
                # Nothing is due any more and nothing has to be remembered.
                del counts[change_id]
                settled.add(change_id)
                changed = True
            if waits:
                waiting[change_id] = waits
        if changed:
            self._keep(self._open, list(counts.items()), known)
        if self._pause and (waiting or settled):
            self._wait(waiting, settled, timerValues)
        yield pd.DataFrame(out, columns=["id", "event", "change_status", "retry_cnt", "resend"])

    def _wait(self, waiting: dict[int, int], settled: set[int], timerValues) -> None:
        """Have ``waiting`` resends due after the pause and none of ``settled`` changes."""
        held = {(change_id, at): resends for change_id, at, resends in self._due.get()}
        due = {k: resends for k, resends in held.items() if k[0] not in settled}
        before = {at for _, at in held}
        for at in before - {at for _, at in due}:
            self._handle.deleteTimer(at)
        if waiting:
            now = timerValues.getCurrentProcessingTimeInMs() + self._pause
            for change_id, resends in waiting.items():
                due[change_id, now] = due.get((change_id, now), 0) + resends
            self._handle.registerTimer(now)
        self._keep(self._due, [(*k, resends) for k, resends in due.items()], bool(held))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        held = list(self._due.get())
        now = [(change_id, resends) for change_id, due_at, resends in held if due_at == at]
        if now:
            self._keep(self._due, [row for row in held if row[1] != at], True)
        counts = dict(self._open.get()) if now else {}
        out = [(change_id, "resend", change_id, counts[change_id], True) for change_id, resends in now for _ in range(resends)]
        yield pd.DataFrame(out, columns=["id", "event", "change_status", "retry_cnt", "resend"])

    def close(self) -> None:
        pass


def unnamed_attempts(attempts: DataFrame) -> DataFrame:
    """The attempts that name no change, for a sink of their own."""
    return attempts.where("id IS NULL")


def stream_retry(attempts: DataFrame, retry_limit: int = RETRY_LIMIT, pause_ms: int = 0, buckets: int = RETRY_BUCKETS) -> DataFrame:
    """Stream form of :func:`shelfline.operators.delivery.delivery_outcome` that remembers counts.

    ``attempts(id, seq, retry_cnt, error)``; the stored ``retry_cnt`` matters for the first attempt
    and for the first one after a final outcome, which clears the state. Every attempt gives an
    ``outcome`` row, every resend a ``resend`` row, after ``pause_ms`` when that is set and no final
    outcome came first. The session has to keep state in RocksDB, see :func:`use_rocksdb`. Texts are
    judged before the state is touched. Attempts without id belong to no change: they are left out
    here and are what :func:`unnamed_attempts` returns. A checkpoint keeps its number of ``buckets``: as
    many as leave a bucket's open changes and the attempts of a micro-batch a small frame.
    """
    attempts = attempts.where("id IS NOT NULL")
    error = F.coalesce("error", F.lit(""))
    judged = attempts.select(
        F.col("id").cast("long").alias("id"),
        # A null comes last, and is no reason for a frame to hold the others as fractions.
        F.coalesce(F.col("seq").cast("long"), F.lit((1 << 63) - 1)).alias("seq"),
        F.col("retry_cnt").cast("long").alias("retry_cnt"),
        (error == "").alias("ok"),
        is_transient(error).alias("transient"),
    )
    return judged.withColumn("bucket", bucket_of("id", buckets)).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Retry(retry_limit, pause_ms),
        outputStructType="id BIGINT, event STRING, change_status BIGINT, retry_cnt BIGINT, resend BOOLEAN",
        outputMode="append",
        timeMode="processingTime" if pause_ms else "none",
    )
