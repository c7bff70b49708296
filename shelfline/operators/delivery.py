"""Delivery terms and the change records that carry them to the shop."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import constants as C
from shelfline.functions.text import full_mod_name
from shelfline.operators.lookups import current
from shelfline.operators.stock import expected_label
from shelfline.plans.latest import latest_per_key
from shelfline.plans.lookup import lookup_join


class Accepted(NamedTuple):
    """Rows that passed and rows that did not, the latter with a ``reason``."""

    records: DataFrame
    rejected: DataFrame


def _own_or_device_term(own: str, device: str) -> Column:
    """The modification's term; NULL or empty means the device's."""
    return F.coalesce(F.nullif(F.col(own), F.lit("")), F.col(device))


def default_delivery(mods: DataFrame, modification: DataFrame, device: DataFrame) -> DataFrame:
    """Term of each ``mod_id`` while nothing is in stock or on order: ``mod_id, time_delivery``."""
    terms = current(modification).select(
        "mod_id", "dev_id", F.col("mod_delivery_time").alias("_own"), F.lit(True).alias("_mod")
    )
    devices = current(device).select("dev_id", F.col("timedelivery").alias("_device"), F.lit(True).alias("_dev"))
    own = F.nullif(F.col("_own"), F.lit(""))
    term = (
        F.when(F.col("_mod").isNull(), C.MODIFICATION_NOT_FOUND)
        .when(own.isNotNull(), own)
        .when(F.col("_dev").isNull(), C.DEVICE_NOT_FOUND)
        .otherwise(F.col("_device"))
    )
    return (
        mods.select("mod_id")
        .join(terms, "mod_id", "left")
        .join(devices, "dev_id", "left")
        .select("mod_id", term.alias("time_delivery"))
    )


def stock_change_records(
    status_changes: DataFrame,
    modification: DataFrame,
    device: DataFrame,
    open_purchase: DataFrame | None,
    availability: DataFrame,
    labels: C.Labels = C.Labels(),
) -> Accepted:
    """Change rows for ``status_changes(ks, old_status, new_status)``.

    The earliest date of an item's open orders comes from ``open_purchase``, or, when that is
    None, from a column ``expected_date`` the changes already have.

    The item needs a current modification whose device has been exported. The term follows the
    new status; only items in stock carry a quantity. Items without a modification, without a
    term or without a quantity are rejected.
    """
    exported = current(device).where(F.col("ie_xml_id_dt").isNotNull()).select("dev_id", "dev_name", "timedelivery")
    mods = current(modification).where(F.col("ks").isNotNull()).select("ks", "dev_id", "mod_id", "mod_delivery_time")
    known = latest_per_key(
        mods.join(exported, "dev_id"), "ks", [F.col("mod_id")], ["mod_id", "dev_name", "mod_delivery_time", "timedelivery"]
    )
    status = F.col("new_status")
    term = (
        F.when(status == C.STATUS_NONE, _own_or_device_term("mod_delivery_time", "timedelivery"))
        .when(status == C.STATUS_ON_ORDER, expected_label("expected_date", labels))
        .when(status == C.STATUS_IN_STOCK, F.lit(labels.in_stock))
    )
    quantity = F.when(status == C.STATUS_IN_STOCK, F.col("available_qty")).otherwise(F.lit(0).cast("decimal(18,2)"))
    if open_purchase is not None:
        changes = status_changes.select("ks", "old_status", "new_status")
        status_changes = lookup_join(changes, open_purchase.select("ks", "expected_date"), "ks")
    filled = (
        lookup_join(status_changes, known, "ks")
        .join(availability.select("ks", F.col("available_qty").cast("decimal(18,2)")), "ks", "left")
        .select(
            "ks",
            F.col("old_status").alias("stock_status_old"),
            F.col("new_status").alias("stock_status_new"),
            "mod_id",
            full_mod_name().alias("mod_name"),
            term.alias("time_delivery"),
            quantity.alias("qnt"),
        )
    )
    reason = (
        F.when(F.col("mod_id").isNull(), "no exported modification")
        .when(F.col("time_delivery").isNull(), "no delivery term")
        .when(F.col("qnt").isNull(), "no quantity")
    )
    judged = filled.withColumn("reason", reason)
    records = (
        judged.where(F.col("reason").isNull())
        .drop("reason")
        .withColumns({"change_status": F.lit(C.PENDING), "dbl_cnt": F.lit(0), "retry_cnt": F.lit(0), "active": F.lit(True)})
    )
    rejected = judged.where(F.col("reason").isNotNull()).select("ks", "stock_status_new", "reason")
    return Accepted(records, rejected)


def is_transient(error: Column) -> Column:
    """A failure worth a resend: a known fragment anywhere but at the very start."""
    found = F.lit(False)
    for fragment in C.TRANSIENT_FRAGMENTS:
        found = found | (F.locate(fragment, error) > 1)
    return found


def delivery_outcome(attempts: DataFrame, site: str, as_of: str, retry_limit: int = C.RETRY_LIMIT) -> DataFrame:
    """What becomes of a change after a send attempt.

    ``attempts(id, retry_cnt, error)`` with NULL or empty ``error`` for success. A transient
    failure takes the change's own id as status and asks for a resend until the stored count is
    above the limit; any other failure blocks the change. Every outcome sets ``dt_sent``, the time
    of the attempt, by which the change sent last is found.
    """
    error, count = F.col("error"), F.col("retry_cnt").cast("long")
    ok = F.coalesce(error, F.lit("")) == ""
    transient = is_transient(error)
    given_up = count > retry_limit
    status = (
        F.when(ok, F.lit(C.SENT).cast("long"))
        .when(transient & given_up, F.lit(C.FAILED).cast("long"))
        .when(transient, F.col("id").cast("long"))
        .otherwise(F.lit(C.BLOCKED).cast("long"))
    )
    retries = F.when(ok, count).when(transient, count + 1).otherwise(F.lit(0).cast("long"))
    return attempts.select(
        "id",
        status.alias("change_status"),
        retries.alias("retry_cnt"),
        F.when(ok, F.lit(f"{site} updated")).otherwise(error).alias("sent_result"),
        F.lit(as_of).cast("timestamp_ntz").alias("dt_sent"),
        (~ok & transient & ~given_up).alias("resend"),
    )


def expected_outcome(attempts: DataFrame, site: str, as_of: str, retry_limit: int = C.RETRY_LIMIT) -> DataFrame:
    """:func:`delivery_outcome` for expected shipments, whose status column is ``status``."""
    return delivery_outcome(attempts, site, as_of, retry_limit).withColumnRenamed("change_status", "status")
