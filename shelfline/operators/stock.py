"""Stock position: what is free, reserved, on order, and the status that follows."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import constants as C
from shelfline.plans.lookup import lookup_join

# Quantities and money are added as decimals: a sum of doubles depends on the row order. Ten
# decimals are more than either has, so that no small amount counts as nothing.
QUANTITY = T.DecimalType(28, 10)
MONEY = T.DecimalType(28, 10)


def _quantity(column: str) -> Column:
    return F.col(column).cast(QUANTITY)


def _only(df: DataFrame, items: DataFrame | None) -> DataFrame:
    return df if items is None else lookup_join(df, items, "ks", "left_semi")


def _counted_stock(stock_qty: DataFrame, excluded: Collection[int]) -> DataFrame:
    return stock_qty.where((F.col("free_qty") != 0) & ~F.col("warehouse_id").isin(*excluded))


def free_stock(stock_qty: DataFrame, excluded: Collection[int] = C.UNCOUNTED_WAREHOUSES) -> DataFrame:
    """Free quantity per item over the counted warehouses: ``ks, free_qty``."""
    return _counted_stock(stock_qty, excluded).groupBy("ks").agg(F.sum(_quantity("free_qty")).alias("free_qty"))


def paid_invoices(payment: DataFrame, money: T.DecimalType = MONEY) -> DataFrame:
    """Invoices whose payments add up to more than zero: ``invoice_no``."""
    return (
        payment.groupBy("invoice_no")
        .agg(F.sum(F.col("amount").cast(money)).alias("paid"))
        .where(F.col("paid") > 0)
        .select("invoice_no")
    )


def paid_reserves(
    reserve: DataFrame, payment: DataFrame, exclude_status: int | None = C.CLOSED_RESERVE_STATUS
) -> DataFrame:
    """Unreleased reserves on paid invoices. With ``exclude_status=None`` the status is not
    looked at, as for incoming reserves."""
    held = reserve.where(F.col("released_at").isNull())
    if exclude_status is not None:
        held = held.where(F.col("reserve_status") != exclude_status)
    return lookup_join(held, paid_invoices(payment), "invoice_no", "left_semi")


def _open_lines(
    po: DataFrame, po_line: DataFrame, excluded_suppliers: Collection[int], items: DataFrame | None = None
) -> DataFrame:
    def live(df: DataFrame) -> DataFrame:
        return df.where(~F.coalesce("cancelled", F.lit(False)) & ~F.coalesce("done", F.lit(False)))

    orders = live(po).where(~F.col("supplier_code").isin(*excluded_suppliers)).select("order_no")
    lines = live(po_line).where(F.col("invoice_no").isNull() & F.col("received_at").isNull())
    lines = _only(lines, items)
    return lines.join(orders, "order_no").select("ks", "qty", "expected_date")


def open_purchase(
    po: DataFrame, po_line: DataFrame, excluded_suppliers: Collection[int] = C.UNCOUNTED_SUPPLIERS
) -> DataFrame:
    """Open order lines per item: ``ks, open_qty, expected_date`` (the earliest)."""
    return (
        _open_lines(po, po_line, excluded_suppliers)
        .groupBy("ks")
        .agg(F.sum(_quantity("qty")).alias("open_qty"), F.min("expected_date").alias("expected_date"))
    )


def expected_label(expected_date: str, labels: C.Labels = C.Labels()) -> Column:
    """``expected <date>``, or ``expected <undated>`` when there is no date."""
    return F.concat(
        F.lit(labels.expected), F.coalesce(F.date_format(expected_date, "yyyy.MM.dd"), F.lit(labels.undated))
    )


def expected_date_label(items: DataFrame, open_purchase: DataFrame, labels: C.Labels = C.Labels()) -> DataFrame:
    """One row per item: ``ks, expected_label``."""
    return (
        items.select("ks")
        .join(open_purchase.select("ks", "expected_date"), "ks", "left")
        .select("ks", expected_label("expected_date", labels).alias("expected_label"))
    )


def stock_totals(
    stock_qty: DataFrame,
    reserve: DataFrame,
    incoming_reserve: DataFrame,
    payment: DataFrame,
    po: DataFrame,
    po_line: DataFrame,
    excluded_warehouses: Collection[int] = C.UNCOUNTED_WAREHOUSES,
    excluded_suppliers: Collection[int] = C.UNCOUNTED_SUPPLIERS,
    closed_status: int = C.CLOSED_RESERVE_STATUS,
    items: DataFrame | None = None,
) -> DataFrame:
    """Everything the status needs, per item: ``ks, on_hand, on_order, expected_date``.

    The four movements are stacked and summed once, so items cross the network in one shuffle;
    both kinds of reserve are tested against the paid invoices in one join. With ``items``
    (distinct ``ks``) every input is reduced to those before anything else happens to it.
    """
    nothing = F.lit(0).cast(QUANTITY)
    no_date = F.lit(None).cast("timestamp_ntz")

    def movement(df: DataFrame, on_hand: Column, on_order: Column, date: Column = no_date) -> DataFrame:
        return df.select("ks", on_hand.alias("on_hand"), on_order.alias("on_order"), date.alias("expected_date"))

    held = (
        reserve.where(F.col("released_at").isNull() & (F.col("reserve_status") != closed_status))
        .select("invoice_no", "ks", (-_quantity("reserved_qty")).alias("on_hand"), nothing.alias("on_order"))
        .unionByName(
            incoming_reserve.where(F.col("released_at").isNull()).select(
                "invoice_no", "ks", nothing.alias("on_hand"), (-_quantity("reserved_qty")).alias("on_order")
            )
        )
    )
    held = _only(held, items)
    if items is not None:
        # Payments are reduced to the invoices of the items' reserves before they are summed.
        payment = lookup_join(payment, held.select("invoice_no").distinct(), "invoice_no", "left_semi")
    reserves = lookup_join(held, paid_invoices(payment), "invoice_no", "left_semi")
    lines = _open_lines(po, po_line, excluded_suppliers, items)
    counted = _only(_counted_stock(stock_qty, excluded_warehouses), items)
    movements = (
        movement(counted, _quantity("free_qty"), nothing)
        .unionByName(movement(reserves, F.col("on_hand"), F.col("on_order")))
        .unionByName(movement(lines, nothing, _quantity("qty"), F.col("expected_date").cast("timestamp_ntz")))
    )
    return movements.groupBy("ks").agg(
        F.sum("on_hand").alias("on_hand"),
        F.sum("on_order").alias("on_order"),
        F.min("expected_date").alias("expected_date"),
    )


def computed_status() -> Column:
    """Status that follows from an item's totals; items without any movement have none."""
    return (
        F.when(F.coalesce("on_hand", F.lit(0)) > 0, C.STATUS_IN_STOCK)
        .when(F.coalesce("on_order", F.lit(0)) > 0, C.STATUS_ON_ORDER)
        .otherwise(C.STATUS_NONE)
    )


def status_from_totals(items: DataFrame, totals: DataFrame) -> DataFrame:
    """``ks, cur, clc, expected_date`` for every row of ``items(ks, cur)``."""
    return items.join(totals, "ks", "left").select("ks", "cur", computed_status().alias("clc"), "expected_date")


def current_status(content: DataFrame) -> DataFrame:
    return content.select("ks", F.coalesce(F.col("stock_status").cast("int"), F.lit(-1)).alias("cur"))


def dated_status(
    content: DataFrame,
    stock_qty: DataFrame,
    reserve: DataFrame,
    incoming_reserve: DataFrame,
    payment: DataFrame,
    po: DataFrame,
    po_line: DataFrame,
    **rules,
) -> DataFrame:
    """:func:`stock_status` with the earliest date of the open orders, ``expected_date``."""
    totals = stock_totals(stock_qty, reserve, incoming_reserve, payment, po, po_line, **rules)
    return status_from_totals(current_status(content), totals)


def stock_status(content: DataFrame, *movements: DataFrame, **rules) -> DataFrame:
    """Stored and computed status of every item: ``ks, cur, clc``.

    In stock when free stock exceeds the paid reserves; else on order when open orders exceed
    the paid incoming reserves; else none. ``movements`` are ``stock_qty, reserve,
    incoming_reserve, payment, po, po_line``; ``rules`` are those of :func:`stock_totals`.
    """
    return dated_status(content, *movements, **rules).select("ks", "cur", "clc")


def apply_status(content: DataFrame, status: DataFrame, mode: bool = True) -> DataFrame:
    """``content`` with the computed status where it differs; unchanged when ``mode`` is off."""
    if not mode:
        return content
    stored = content.schema["stock_status"].dataType
    changed = F.when(F.col("_cur") != F.col("_clc"), F.col("_clc").cast(stored)).otherwise(F.col("stock_status"))
    computed = status.select("ks", F.col("cur").alias("_cur"), F.col("clc").alias("_clc"))
    return content.join(computed, "ks", "left").withColumn("stock_status", changed).select(*content.columns)
