"""Change log: which rows count as changes, what was sent last, what to send again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import constants as C
from shelfline.functions.text import format_payload
from shelfline.operators.lookups import attach_mod_id
from shelfline.plans.latest import newest, nulls_highest
from shelfline.plans.lookup import lookup_join
from shelfline.plans.ordinals import SLICE_BITS, with_ordinal, with_previous, with_running_total, with_slice


def changed_rows(changes: DataFrame, kind: str) -> DataFrame:
    """The rows of ``changes(before, after)`` that start something.

    ``stock_status``: the status differs or was unknown (a change *to* unknown does not count).
    ``computed``: a pending row with an item was just calculated.
    ``batch_start``: a batch reached its start status. ``export_start``: an export became ready.
    """
    before, after = (lambda c: F.col(f"before.{c}")), (lambda c: F.col(f"after.{c}"))
    conditions = {
        "stock_status": lambda: (after("stock_status") != before("stock_status")) | before("stock_status").isNull(),
        "computed": lambda: after("ks").isNotNull()
        & (after("change_status") == C.PENDING)
        & before("dt_trans").isNull()
        & after("dt_trans").isNotNull(),
        "batch_start": lambda: after("status") == C.BATCH_START,
        "export_start": lambda: (after("exp_status") != before("exp_status")) & (after("exp_status") == 1),
    }
    return changes.where(conditions[kind]())


def _sent_order() -> tuple[Column, ...]:
    return *nulls_highest("dt_sent"), F.col("id")


def last_sent(stock_change: DataFrame) -> DataFrame:
    """The newest sent row of every modification; a missing send time counts as newest."""
    values = [c for c in stock_change.columns if c != "mod_id"]
    return (
        stock_change.where(F.col("change_status") == C.SENT)
        .groupBy("mod_id")
        .agg(newest(values, _sent_order()).alias("_row"))
        .select("mod_id", "_row.*")
        .select(*stock_change.columns)
    )


def _compared(candidates: DataFrame, stock_change: DataFrame) -> DataFrame:
    """``candidates`` with ``equal`` and the id of the last sent row they were compared with."""
    history = stock_change.where(F.col("change_status").isin(C.PENDING, C.SENT)).groupBy("mod_id").agg(
        F.bool_or(F.col("change_status") == C.PENDING).alias("_pending"),
        newest(["id", "time_delivery", "qnt"], _sent_order(), F.col("change_status") == C.SENT).alias("_sent"),
    )
    sent = F.col("_sent")
    same = (F.col("qnt") == sent["qnt"]) & (F.col("time_delivery") == sent["time_delivery"])
    equal = F.when(F.coalesce("_pending", F.lit(False)) | sent.isNull(), F.lit(False)).otherwise(same)
    return (
        lookup_join(candidates, history, "mod_id")
        .withColumns({"equal": equal, "sent_id": sent["id"]})
        .drop("_pending", "_sent")
    )


def equals_last_sent(candidates: DataFrame, stock_change: DataFrame) -> DataFrame:
    """Add ``equal`` to ``candidates(mod_id, time_delivery, qnt)``: nothing is pending for the
    modification and quantity and term are those sent last. Unknown values give NULL."""
    return _compared(candidates, stock_change).drop("sent_id")


def count_duplicates(stock_change: DataFrame, candidates: DataFrame) -> DataFrame:
    """``stock_change`` with ``dbl_cnt`` of each last sent row raised by the candidates that
    equal it."""
    repeats = (
        _compared(candidates, stock_change)
        .where(F.col("equal"))
        .groupBy(F.col("sent_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("_repeats"))
    )
    return (
        stock_change.join(repeats, "id", "left")
        .withColumn("dbl_cnt", F.col("dbl_cnt") + F.coalesce("_repeats", F.lit(0)))
        .select(*stock_change.columns)
    )


def supersede_pending(stock_change: DataFrame) -> DataFrame:
    """``stock_change`` with pending rows that have a newer row for their modification marked
    as superseded."""
    newest_id = stock_change.groupBy("mod_id").agg(F.max("id").alias("_newest"))
    pending = F.coalesce(F.col("change_status") == C.PENDING, F.lit(False))
    status_type = stock_change.schema["change_status"].dataType
    marked = (
        lookup_join(stock_change.where(pending), newest_id, "mod_id")
        .withColumn(
            "change_status",
            F.when(F.col("id") < F.col("_newest"), F.lit(C.SUPERSEDED).cast(status_type)).otherwise(F.col("change_status")),
        )
        .select(*stock_change.columns)
    )
    return stock_change.where(~pending).unionByName(marked)


def suppress_repeats(stock_change: DataFrame, slice_bits: int = SLICE_BITS) -> DataFrame:
    """Fold every modification's changes in id order: a change equal to the one sent last is
    suppressed and counted. ``id, mod_id, time_delivery, qnt, sent, dbl_cnt`` where ``dbl_cnt``
    is how many have been suppressed since the last sent one.

    Suppressed changes equal the last sent one, so each is compared with its predecessor.
    """
    rows = with_slice(stock_change.select("id", "mod_id", "time_delivery", "qnt"), "id", slice_bits)
    previous = with_previous(rows, ["mod_id"], "id", ["time_delivery", "qnt"])
    same = (F.col("time_delivery") == F.col("previous.time_delivery")) & (F.col("qnt") == F.col("previous.qnt"))
    judged = previous.withColumn("sent", ~F.coalesce(same, F.lit(False))).drop("previous")
    runs = with_running_total(judged, ["mod_id"], "id", F.col("sent").cast("long"), "_run")
    # A run starts with its sent row; positions inside it count the suppressed ones.
    in_run = with_ordinal(runs, ["mod_id", "_run"], "id")
    return in_run.select("id", "mod_id", "time_delivery", "qnt", "sent", F.col("ordinal").alias("dbl_cnt"))


def _resendable(status: int) -> bool:
    return status not in (C.SENT, C.BLOCKED)


def resend_changes(stock_change: DataFrame, status: int, compute_mode: bool = True) -> DataFrame:
    """Messages for the changes with ``status``, by id; none for sent or blocked ones.

    With ``compute_mode`` the message carries the id and the rest is calculated on receipt;
    else it carries the modification, term, id and quantity.
    """
    chosen = stock_change.where((F.col("change_status") == status) & F.lit(_resendable(status)))
    if compute_mode:
        channel, payload = C.CHANNEL_COMPUTE, format_payload(["id"])
    else:
        channel = C.CHANNEL_SINGLE
        quantity = F.coalesce(F.col("qnt").cast("string"), F.lit(""))
        payload = format_payload(["mod_id", "time_delivery", "id", quantity])
    return chosen.select("id", F.lit(channel).alias("channel"), payload.alias("payload")).orderBy("id")


def resend_expected(expected_shipment: DataFrame, modification: DataFrame, status: int) -> DataFrame:
    """Messages for the expected shipments with ``status``, by id; without a modification none."""
    chosen = expected_shipment.where((F.col("status") == status) & F.lit(_resendable(status))).select("id", "ks", "expected")
    return (
        attach_mod_id(chosen, modification)
        .where(F.col("mod_id").isNotNull())
        .select(
            "id",
            F.lit(C.CHANNEL_EXPECTED).alias("channel"),
            format_payload(["mod_id", "expected", "id"]).alias("payload"),
        )
        .orderBy("id")
    )


def new_change_messages(stock_change: DataFrame) -> DataFrame:
    """Message for every new change: its id, the rest is calculated on receipt."""
    return stock_change.select(
        "id", F.lit(C.CHANNEL_COMPUTE).alias("channel"), format_payload(["id"], nulls="blank").alias("payload")
    )


def new_expected_messages(expected_shipment: DataFrame) -> DataFrame:
    """Message for every new expected shipment; any missing part leaves it without a payload."""
    return expected_shipment.select(
        "id",
        F.lit(C.CHANNEL_EXPECTED).alias("channel"),
        format_payload(["mod_id", "expected", "id"], nulls="propagate").alias("payload"),
    )


def pack_list_changes(changes: DataFrame, pack_list: DataFrame) -> DataFrame:
    """The changes whose item is on the marketplace list."""
    return changes.join(pack_list.select("ks"), "ks", "left_semi")


def _seconds(later: Column, earlier: Column) -> Column:
    """Whole seconds between two zone-less times, halves rounded up."""
    gap = later - earlier
    parts = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    total = sum((F.extract(F.lit(unit), gap) * size for unit, size in parts.items()), F.lit(0))
    return F.round(total).cast("long")


def pack_change_events(
    changes: DataFrame, pack_list: DataFrame, pack_change: DataFrame, availability: DataFrame, as_of: str
) -> DataFrame:
    """Pack-quantity rows for listed items and the message announcing each.

    ``changes(id, ks, qnt)`` are calculated pending rows. The message says how many seconds ago
    the item was last confirmed, blank if never. The event's own id names the new row.
    """
    confirmed = (
        pack_change.where(F.col("change_status") == C.PACK_CONFIRMED)
        .groupBy("ks")
        .agg(F.max_by("dt_sent", "id").alias("_sent_at"))
    )
    packs = availability.select("ks", F.col("pack_qty").alias("qnt_calc"))
    elapsed = _seconds(F.lit(as_of).cast("timestamp_ntz"), F.col("_sent_at"))
    listed = pack_list_changes(changes, pack_list).join(packs, "ks", "left")
    return (
        lookup_join(listed, confirmed, "ks")
        .select(
            "id", F.col("id").alias("ssc_id"), "ks", F.col("qnt").alias("qnt_ssc"), "qnt_calc", elapsed.alias("elapsed")
        )
        .withColumn("payload", format_payload(["ks", "qnt_calc", "id", "elapsed"], nulls="blank"))
    )
