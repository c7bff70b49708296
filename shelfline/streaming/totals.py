"""Stock totals kept up by row changes.

The status of an item follows from sums over five tables. Here the sums are kept as state and every
change is taken back and put in again: a row's ``before`` is subtracted, its ``after`` added. Two parts of
the rule do not invert by themselves:

* Whether a row counts depends on another one: reserves on their invoice's payments, order lines on
  their order. Both are *gates*: for the invoices and orders that a batch touches, what they held open
  before is subtracted and what they hold open now is added, from state kept by gate.
* The earliest expected date is no sum. State counts open lines by item and date, and the earliest
  date that still has some is the answer.

No movement table is read after the first fill; a batch reads and writes the buckets it touches.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions import constants as C
from shelfline.operators.stock import QUANTITY
from shelfline.plans.buckets import BUCKETS
from shelfline.plans.lookup import lookup_join
from shelfline.streaming.state import KeyedState

_NUMBER = "decimal(38,10)"
#: The columns of a movement that the totals look at, by table.
COLUMNS = {
    "stock_qty": "ks LONG, warehouse_id LONG, free_qty DOUBLE",
    "reserve": "ks LONG, invoice_no LONG, reserved_qty DOUBLE, reserve_status LONG, released_at TIMESTAMP_NTZ",
    "incoming_reserve": "ks LONG, invoice_no LONG, reserved_qty DOUBLE, released_at TIMESTAMP_NTZ",
    "payment": "invoice_no LONG, amount DECIMAL(28,10)",
    "purchase_order": "order_no LONG, supplier_code LONG, cancelled BOOLEAN, done BOOLEAN",
    "purchase_order_line": "order_no LONG, ks LONG, qty DOUBLE, cancelled BOOLEAN, done BOOLEAN, invoice_no LONG, received_at TIMESTAMP_NTZ, expected_date TIMESTAMP_NTZ",
}


def signed(changes: DataFrame) -> DataFrame:
    """Rows ``_sign, row``: what a change takes back (-1) and what it puts in (1)."""
    taken = F.when((F.col("op") != "I") & F.col("before").isNotNull(), F.struct(F.lit(-1).alias("_sign"), F.col("before").alias("row")))
    put = F.when((F.col("op") != "D") & F.col("after").isNotNull(), F.struct(F.lit(1).alias("_sign"), F.col("after").alias("row")))
    return changes.select(F.explode(F.array_compact(F.array(taken, put))).alias("_c")).select("_c._sign", "_c.row.*")


def _open(flag: str) -> Column:
    return ~F.coalesce(flag, F.lit(False))


class StockTotals:
    """State below ``folder``: totals and open dates by item, payments and held reserves by invoice,
    orders and open lines by order."""

    def __init__(
        self, spark: SparkSession, folder: str, buckets: int = BUCKETS, excluded_warehouses: Collection[int] = C.UNCOUNTED_WAREHOUSES,
        excluded_suppliers: Collection[int] = C.UNCOUNTED_SUPPLIERS, closed_status: int = C.CLOSED_RESERVE_STATUS,
    ):
        self._folder, self._buckets = folder, buckets
        self.spark, self._warehouses, self._suppliers, self._closed = spark, list(excluded_warehouses), list(excluded_suppliers), closed_status
        state = lambda name, ddl, key, *unique: KeyedState(spark, f"{folder}/{name}", ddl, key, unique or None, buckets)
        self.totals = state("totals", f"ks LONG, on_hand {_NUMBER}, on_order {_NUMBER}", "ks")
        self.dates = state("dates", "ks LONG, expected_date TIMESTAMP_NTZ, lines LONG", "ks", "ks", "expected_date")
        self.paid = state("paid", f"gate LONG, amount {_NUMBER}", "gate")
        self.held = state("held", f"gate LONG, ks LONG, on_hand {_NUMBER}, on_order {_NUMBER}", "gate", "gate", "ks")
        self.orders = state("orders", "gate LONG, rows LONG", "gate")
        self.lines = state("lines", f"gate LONG, ks LONG, expected_date TIMESTAMP_NTZ, qty {_NUMBER}, lines LONG", "gate", "gate", "ks", "expected_date")

    def _delta(self, state: KeyedState, rows: DataFrame) -> DataFrame:
        """Signed rows summed by the names of a state."""
        sums = [c for c in rows.columns if c not in (*state.unique, "_sign")]
        return rows.groupBy(*state.unique).agg(*[F.sum(F.col(c) * F.col("_sign")).cast(dict(rows.dtypes)[c]).alias(c) for c in sums])

    def _apply(self, batch_id: int, state: KeyedState, delta: DataFrame) -> DataFrame:
        """Add ``delta`` to a state: the touched buckets afterwards."""
        buckets = state.buckets_of(delta)
        self._add(batch_id, state, buckets, delta)
        return state.before(batch_id + 1, buckets)

    def _add(self, batch_id: int, state: KeyedState, buckets: list[int], delta: DataFrame) -> DataFrame:
        """Add ``delta`` to buckets of a state; the buckets as they were before."""
        before = state.before(batch_id, buckets)
        sums = [c for c in delta.columns if c not in state.unique]
        after = before.unionByName(delta).groupBy(*state.unique).agg(*[F.sum(c).cast(dict(before.dtypes)[c]).alias(c) for c in sums])
        state.write(batch_id, buckets, after)
        return before

    def _kept(self, name: str, batch_id: int, rows: DataFrame) -> DataFrame:
        """``rows`` written for the batch, into one of two folders by turns. Not cached: a cached frame
        that reads state would be read again when the state is written."""
        place = f"{self._folder}/work/{name}/{batch_id % 2}"
        rows.write.mode("overwrite").parquet(place)
        return self.spark.read.schema(rows.schema).parquet(place)

    def _gated(self, name: str, batch_id: int, gates: KeyedState, is_open: Column, gate_delta: DataFrame, members: KeyedState, member_delta: DataFrame) -> DataFrame:
        """What the members of the touched gates count for now and did not before, with ``_sign``."""
        touched = self._kept(f"gates-{name}", batch_id, gate_delta.select("gate").unionByName(member_delta.select("gate")).where("gate IS NOT NULL").distinct())
        sides = []
        for state, delta in ((gates, gate_delta), (members, member_delta)):
            # A bucket without a change of its own is read all the same: the other part of its gates moved.
            # Rows without a gate never count.
            buckets = state.buckets_of(touched)
            before = self._add(batch_id, state, buckets, delta.where("gate IS NOT NULL"))
            sides.append([lookup_join(side, touched, "gate", "left_semi") for side in (before, state.before(batch_id + 1, buckets))])
        (gates_before, gates_after), (members_before, members_after) = sides
        parts = []  # by now all state is written
        for sign, gate, member in ((-1, gates_before, members_before), (1, gates_after, members_after)):
            parts.append(lookup_join(member, gate.where(is_open).select("gate"), "gate", "left_semi").withColumn("_sign", F.lit(sign)))
        return parts[0].unionByName(parts[1]).drop("gate")

    def apply(self, batch_id: int, changes: dict[str, DataFrame]) -> DataFrame:
        """Take in a batch of changes (``op, before, after`` by table) and return the items whose totals
        or dates it touched, with them: ``ks, on_hand, on_order, expected_date``. The same batch again
        gives the same."""
        row = {name: self._rows(name, changes.get(name)) for name in COLUMNS}
        nothing = F.lit(0).cast(_NUMBER)
        amount = lambda c: F.col(c).cast(QUANTITY).cast(_NUMBER)

        paid = self._delta(self.paid, row["payment"].select("_sign", F.col("invoice_no").alias("gate"), F.col("amount").cast(_NUMBER).alias("amount")))
        own = row["reserve"].where(F.col("released_at").isNull() & (F.col("reserve_status") != self._closed))
        later = row["incoming_reserve"].where(F.col("released_at").isNull())
        held = own.select("_sign", F.col("invoice_no").alias("gate"), "ks", (-amount("reserved_qty")).alias("on_hand"), nothing.alias("on_order"))
        held = held.unionByName(later.select("_sign", F.col("invoice_no").alias("gate"), "ks", nothing.alias("on_hand"), (-amount("reserved_qty")).alias("on_order")))
        live = row["purchase_order"].where(_open("cancelled") & _open("done") & ~F.col("supplier_code").isin(self._suppliers))
        orders = self._delta(self.orders, live.select("_sign", F.col("order_no").alias("gate"), F.lit(1).cast("long").alias("rows")))
        waiting = row["purchase_order_line"].where(_open("cancelled") & _open("done") & F.col("invoice_no").isNull() & F.col("received_at").isNull())
        lines = waiting.select("_sign", F.col("order_no").alias("gate"), "ks", "expected_date", amount("qty").alias("qty"), F.lit(1).cast("long").alias("lines"))

        reserves = self._gated("invoices", batch_id, self.paid, F.col("amount") > 0, paid, self.held, self._delta(self.held, held))
        ordered = self._gated("orders", batch_id, self.orders, F.col("rows") > 0, orders, self.lines, self._delta(self.lines, lines))
        ordered = self._kept("ordered", batch_id, ordered)
        counted = row["stock_qty"].where((F.col("free_qty") != 0) & ~F.col("warehouse_id").isin(self._warehouses))
        moves = reduce(DataFrame.unionByName, [
            counted.select("_sign", "ks", amount("free_qty").alias("on_hand"), nothing.alias("on_order")), reserves.select("_sign", "ks", "on_hand", "on_order"),
            ordered.select("_sign", "ks", nothing.alias("on_hand"), F.col("qty").alias("on_order")),
        ])
        delta = self._kept("delta", batch_id, self._delta(self.totals, moves.where("ks IS NOT NULL")))
        totals = self._apply(batch_id, self.totals, delta)
        dated = ordered.where("ks IS NOT NULL").select("_sign", "ks", "expected_date", "lines")
        self._apply(batch_id, self.dates, self._kept("dated", batch_id, self._delta(self.dates, dated)))
        # Also of items whose dates did not move.
        dates = self.dates.before(batch_id + 1, self.dates.buckets_of(delta))
        return self._dated(lookup_join(totals, delta.select("ks"), "ks", "left_semi"), dates)

    def current(self, batch_id: int) -> DataFrame:
        """The totals of all items as the batches before ``batch_id`` left them."""
        every = range(self._buckets)
        return self._dated(self.totals.before(batch_id, every), self.dates.before(batch_id, every))

    def _dated(self, totals: DataFrame, dates: DataFrame) -> DataFrame:
        first = dates.where("lines > 0").groupBy("ks").agg(F.min("expected_date").alias("expected_date"))
        return lookup_join(totals, first, "ks").select("ks", "on_hand", "on_order", "expected_date")

    def _rows(self, table: str, changes: DataFrame | None) -> DataFrame:
        ddl = COLUMNS[table]
        if changes is None:
            return self.spark.createDataFrame([], f"_sign INT, {ddl}")
        rows = signed(changes)
        kinds = dict(c.split(" ", 1) for c in ddl.split(", "))
        return rows.select("_sign", *[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()])

    def fill(self, tables: dict[str, DataFrame]) -> None:
        """Take in whole tables, as batch -1, before the first changes."""
        rows = {t: tables[t].select(F.lit("I").alias("op"), F.struct(F.lit(None).cast("long").alias("_")).alias("before"), F.struct("*").alias("after")) for t in COLUMNS if t in tables}
        self.apply(-1, {t: df.withColumn("before", F.lit(None).cast(df.schema["after"].dataType)) for t, df in rows.items()})
