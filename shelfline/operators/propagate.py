"""From row changes to the items they affect, and the recompute of just those items.

Changes have ``op`` (``I``, ``U`` or ``D``) and the row ``before`` and ``after``. Every operator
returns distinct item codes ``ks``.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import constants as C
from shelfline.operators import stock
from shelfline.plans.buckets import BUCKETS, look_up
from shelfline.plans.lookup import lookup_join


def affected_by_payments(changes: DataFrame, invoice_line: DataFrame) -> DataFrame:
    """Items on the invoice a payment now has (or had, when deleted), and on the one it was
    moved away from."""
    return lookup_join(invoice_line, _payment_invoices(changes), "invoice_no", "left_semi").select("ks").distinct()


def affected_by_payments_indexed(changes: DataFrame, folder: str, buckets: int = BUCKETS) -> DataFrame:
    """:func:`affected_by_payments` from the invoice lines that :func:`shelfline.plans.buckets.write_index`
    wrote to ``folder`` by ``invoice_no``: only the buckets of the changes' invoices are read."""
    lines = T.StructType.fromDDL("invoice_no LONG, ks LONG")
    return look_up(changes.sparkSession, folder, lines, _payment_invoices(changes), "invoice_no", buckets).select("ks").distinct()


def _payment_invoices(changes: DataFrame) -> DataFrame:
    now = F.when(F.col("op") == "D", F.col("before.invoice_no")).otherwise(F.col("after.invoice_no"))
    moved = (F.col("op") == "U") & (F.col("after.invoice_no") != F.col("before.invoice_no"))
    left_behind = F.when(moved, F.col("before.invoice_no"))
    invoices = changes.select(F.explode(F.array(now, left_behind)).alias("invoice_no")).where("invoice_no IS NOT NULL")
    return invoices.distinct()


def affected_by_reserves(changes: DataFrame, touched: Column | None = None) -> DataFrame:
    """Items of changed reserves, of either kind. Updates count when the invoice or the release
    time is touched; by default that means it differs."""
    if touched is None:
        touched = ~(
            F.col("before.invoice_no").eqNullSafe(F.col("after.invoice_no"))
            & F.col("before.released_at").eqNullSafe(F.col("after.released_at"))
        )
    ks = F.when(F.col("op") == "D", F.col("before.ks")).otherwise(F.col("after.ks"))
    return changes.where((F.col("op") != "U") | touched).select(ks.alias("ks")).where("ks IS NOT NULL").distinct()


def affected_by_orders(
    changes: DataFrame, po: DataFrame, excluded: Collection[int] = C.UNTRIGGERED_SUPPLIERS
) -> DataFrame:
    """Items of new order lines whose order's supplier is not excluded."""
    orders = po.where(~F.col("supplier_code").isin(*excluded)).select("order_no")
    lines = changes.select(F.col("after.order_no").alias("order_no"), F.col("after.ks").alias("ks"))
    return lines.join(orders, "order_no", "left_semi").where("ks IS NOT NULL").select("ks").distinct()


def affected_by_stock(changes: DataFrame) -> DataFrame:
    """Items of changed warehouse rows. Production has no trigger for these; an extra for callers
    who want one."""
    both = F.explode(F.array("before.ks", "after.ks")).alias("ks")
    return changes.select(both).where("ks IS NOT NULL").distinct()


MOVEMENTS = ("stock_qty", "reserve", "incoming_reserve", "payment", "purchase_order", "purchase_order_line")


def recompute_dated_status(keys: DataFrame, tables: dict[str, DataFrame], **rules) -> DataFrame:
    """:func:`recompute_status` with the earliest date of the open orders, ``expected_date``."""
    keys = keys.select("ks").distinct()
    totals = stock.stock_totals(*[tables[t] for t in MOVEMENTS], items=keys, **rules)
    items = keys.join(stock.current_status(tables["content"]), "ks", "left")
    return stock.status_from_totals(items, totals)


def recompute_status(keys: DataFrame, tables: dict[str, DataFrame], **rules) -> DataFrame:
    """``ks, cur, clc`` for the given items; ``cur`` is NULL for an item that does not exist.

    Every large input is reduced to the items before it is summed. ``tables`` holds ``content``
    and :data:`MOVEMENTS`.
    """
    return recompute_dated_status(keys, tables, **rules).select("ks", "cur", "clc")


def status_changes(status: DataFrame) -> DataFrame:
    """The items whose status differs from the stored one: ``ks, old_status, new_status``, an
    unknown old status as NULL. Further columns of ``status`` come along."""
    more = [c for c in status.columns if c not in ("ks", "cur", "clc")]
    return status.where(F.col("cur") != F.col("clc")).select(
        "ks", F.nullif(F.col("cur"), F.lit(-1)).alias("old_status"), F.col("clc").alias("new_status"), *more
    )
