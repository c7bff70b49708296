"""Every operator over the domain views: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import configure
from shelfline.functions import constants as C
from shelfline.functions.text import format_payload
from shelfline.operators import changes, delivery, export, lookups, migrate, outcomes, propagate, quality, reports, stock
from shelfline.sources import caret_csv, change_feed, folders, logs, notifications, snapshots
from shelfline.sources.tables import SOURCE_NAMES, from_source, load_domain
from shelfline.plans import buckets
from shelfline.streaming import dedupe, notify, recompute, sinks, stateful
from shelfline.streaming.totals import COLUMNS, StockTotals
from workloads.views import Domain, domain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters used with the views in place of the production defaults.
SUPPLIERS = (3, 7)
AS_OF = "2024-02-01 00:00:00"
UNFINISHED_AS_OF = "1998-01-01 00:00:00"
ORDERS_AS_OF = "2001-07-02 00:00:00"
LABELS = C.Labels(in_stock="In stock", in_stock_report="In stock", expected="Expected ", undated="to stock")
FIRMS = C.FirmRules(special="FIRM_S", dealer="FIRM_D", flagged="FIRM_V", default="FIRM_E", renamed="FIRM_OLD", special_customer=5)
PROD_SITE, DEV_SITE = "prod.example", "dev.example"
LOG_PATTERN = "%TX-40%"
STOCK_TABLES = ("content", "stock_qty", "reserve", "incoming_reserve", "payment", "purchase_order", "purchase_order_line")


def query(fn: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    """Register a function of the domain under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(domain(configure(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def _tables(d: Domain, *more: str) -> dict[str, DataFrame]:
    return {name: getattr(d, name) for name in (*STOCK_TABLES, *more)}


def _totals(d: Domain) -> DataFrame:
    return stock.stock_totals(*[getattr(d, t) for t in STOCK_TABLES[1:]], excluded_suppliers=SUPPLIERS)


def _open(d: Domain) -> DataFrame:
    return stock.open_purchase(d.purchase_order, d.purchase_order_line, SUPPLIERS)


def _row(**columns: str) -> Column:
    """A row image from differently named columns."""
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


# --- stock position -------------------------------------------------------------------


@query
def stock_status(d):
    return stock.stock_status(*[getattr(d, t) for t in STOCK_TABLES], excluded_suppliers=SUPPLIERS)


@query
def apply_status(d):
    return stock.apply_status(d.content, stock_status(d))


@query
def transition_log(d):
    return logs.transition_log(stock_status(d), AS_OF)


@query
def free_stock(d):
    return stock.free_stock(d.stock_qty).withColumn("free_qty", F.col("free_qty").cast("decimal(18,4)"))


@query
def paid_reserves(d):
    return stock.paid_reserves(d.reserve, d.payment).select("ks", "invoice_no", "reserved_qty", "reserve_status")


@query
def paid_incoming_reserves(d):
    return stock.paid_reserves(d.incoming_reserve, d.payment, exclude_status=None).select("ks", "invoice_no", "reserved_qty")


@query
def open_purchase(d):
    return _open(d).withColumn("open_qty", F.col("open_qty").cast("decimal(18,4)"))


@query
def stock_totals(d):
    return _totals(d).select(
        "ks", F.col("on_hand").cast("decimal(18,4)").alias("on_hand"), F.col("on_order").cast("decimal(18,4)").alias("on_order"), "expected_date"
    )


@query
def expected_date_label(d):
    return stock.expected_date_label(d.content, _open(d), LABELS)


# --- lookups and delivery terms ---------------------------------------------------------


@query
def synced_modifications(d):
    return lookups.synced_modifications(d.modification, d.device)


@query
def attach_item_code(d):
    return lookups.attach_item_code(d.stock_change.select("id", "mod_id"), d.modification)


@query
def attach_mod_id(d):
    return lookups.attach_mod_id(d.stock_change.select("id", "ks"), d.modification)


@query
def default_delivery(d):
    return delivery.default_delivery(lookups.current(d.modification), d.modification, d.device)


def _change_records(d):
    """A record for every item, changed or not."""
    status = stock.dated_status(*[getattr(d, t) for t in STOCK_TABLES], excluded_suppliers=SUPPLIERS)
    all_items = status.select("ks", F.nullif("cur", F.lit(-1)).alias("old_status"), F.col("clc").alias("new_status"), "expected_date")
    return delivery.stock_change_records(all_items, d.modification, d.device, None, d.availability, LABELS)


@query
def stock_change_records(d):
    return _change_records(d).records


@query
def stock_change_rejects(d):
    return _change_records(d).rejected


@query
def site_update_messages(d):
    return lookups.site_update_messages(d.stock_change)


def _attempts(change: DataFrame) -> DataFrame:
    pending = change.where(F.col("change_status") == C.PENDING)
    return pending.select("id", F.col("id").alias("seq"), "retry_cnt", F.nullif("sent_result", F.lit("ok updated")).alias("error"))


@query
def delivery_outcome(d):
    return delivery.delivery_outcome(_attempts(d.stock_change), PROD_SITE, AS_OF)


@query
def expected_outcome(d):
    pending = d.expected_shipment.where(F.col("status") == C.PENDING)
    attempts = pending.select("id", "retry_cnt", F.nullif("sent_result", F.lit("ok updated")).alias("error"))
    return delivery.expected_outcome(attempts, PROD_SITE, AS_OF)


# --- change log -------------------------------------------------------------------------


@query
def changed_rows(d):
    """All four kinds, each with the key of the changed row."""
    content = d.content_change.select("ks", _row(stock_status="old_status").alias("before"), _row(stock_status="new_status").alias("after"))
    computed = d.stock_change_update.select(
        "id", _row(dt_trans="old_dt_trans").alias("before"), _row(ks="ks", change_status="new_change_status", dt_trans="new_dt_trans").alias("after")
    )
    batch = d.export_batch.select("id", _row(status=F.lit(0)).alias("before"), _row(status="status").alias("after"))
    exports = d.export_log_change.select(
        "exp_id", _row(exp_status="old_exp_status").alias("before"), _row(exp_status="new_exp_status").alias("after")
    )
    parts = [("stock_status", content, "ks"), ("computed", computed, "id"), ("batch_start", batch, "id"), ("export_start", exports, "exp_id")]
    found = [changes.changed_rows(df, kind).select(F.lit(kind).alias("kind"), F.col(key).alias("key")) for kind, df, key in parts]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query
def last_sent(d):
    return changes.last_sent(d.stock_change)


def _candidates(d):
    return d.stock_change.select("mod_id", "time_delivery", "qnt").distinct()


@query
def equals_last_sent(d):
    return changes.equals_last_sent(_candidates(d), d.stock_change)


@query
def count_duplicates(d):
    return changes.count_duplicates(d.stock_change, _candidates(d)).select("id", "mod_id", "dbl_cnt")


@query
def supersede_pending(d):
    return changes.supersede_pending(d.stock_change).select("id", "mod_id", "change_status")


@query
def suppress_repeats(d):
    return changes.suppress_repeats(d.stock_change)


@query
def resend_changes(d):
    return changes.resend_changes(d.stock_change, 5)


@query
def resend_changes_in_full(d):
    return changes.resend_changes(d.stock_change, 5, compute_mode=False)


@query
def resend_expected(d):
    return changes.resend_expected(d.expected_shipment, d.modification, 2)


@query
def new_change_messages(d):
    return changes.new_change_messages(d.stock_change)


@query
def new_expected_messages(d):
    return changes.new_expected_messages(lookups.attach_mod_id(d.expected_shipment, d.modification))


@query
def format_payloads(d):
    parts = ["mod_id", "expected", "id"]
    rows = lookups.attach_mod_id(d.expected_shipment, d.modification)
    return rows.select("id", *[format_payload(parts, nulls=rule).alias(rule) for rule in ("propagate", "skip", "blank")])


def _computed_changes(d):
    updates = d.stock_change_update.select(
        "id",
        "ks",
        "qnt",
        _row(dt_trans="old_dt_trans").alias("before"),
        _row(ks="ks", change_status="new_change_status", dt_trans="new_dt_trans").alias("after"),
    )
    return changes.changed_rows(updates, "computed").select("id", "ks", "qnt")


@query
def pack_list_changes(d):
    return changes.pack_list_changes(_computed_changes(d), d.pack_list)


@query
def pack_change_events(d):
    return changes.pack_change_events(_computed_changes(d), d.pack_list, d.pack_change, d.availability, AS_OF)


@query
def route_notifications(d):
    """Classified once, written by route and read again."""
    folder = folders.shared_folder(d.spark, "routes")
    notifications.write_routes(d.notification, folder)
    return d.spark.read.parquet(folder).select("seq", "route", "target_id", "mod_id", "expected")


# --- affected items -----------------------------------------------------------------------


def _payment_changes(view: DataFrame) -> DataFrame:
    return view.select("op", _row(invoice_no="old_invoice_no").alias("before"), _row(invoice_no="new_invoice_no").alias("after"))


def _reserve_changes(view: DataFrame) -> DataFrame:
    """The view only says whether an update touched the row: show that as a changed invoice."""
    invoice = F.when(F.col("touched"), 1).otherwise(0).cast("long")
    released = F.lit(None).cast("timestamp_ntz")
    return view.select(
        "op",
        _row(ks="old_ks", invoice_no=F.lit(0).cast("long"), released_at=released).alias("before"),
        _row(ks="new_ks", invoice_no=invoice, released_at=released).alias("after"),
    )


def _order_line_changes(view: DataFrame) -> DataFrame:
    row = _row(order_no="order_no", ks="ks")
    return view.select(F.lit("I").alias("op"), F.when(F.lit(False), row).alias("before"), row.alias("after"))


@query
def affected_by_payments(d):
    return propagate.affected_by_payments(_payment_changes(d.payment_change), d.invoice_line)


def _snapshot_changes(d):
    return snapshots.row_changes(d.payment_before, d.payment_after, "payment_id", seq=1)


@query
def snapshot_changes(d):
    """Changes of payments between two snapshots."""
    return _snapshot_changes(d).select(
        "op", "seq", F.coalesce("after.payment_id", "before.payment_id").alias("payment_id"),
        F.col("before.invoice_no").alias("old_invoice_no"), F.col("after.invoice_no").alias("new_invoice_no"),
        F.col("before.amount").alias("old_amount"), F.col("after.amount").alias("new_amount"),
    )


@query
def snapshot_rejects(d):
    """Invoices do not name a payment: after some moved, one invoice has two."""
    return snapshots.snapshot_rejects(d.payment_before, d.payment_after, "invoice_no")


@query
def affected_by_snapshots(d):
    """Items of the payments that differ between two snapshots."""
    return propagate.affected_by_payments(_snapshot_changes(d), d.invoice_line)


@query
def affected_by_reserves(d):
    return propagate.affected_by_reserves(_reserve_changes(d.reserve_change))


@query
def affected_by_orders(d):
    return propagate.affected_by_orders(_order_line_changes(d.order_line_change), d.purchase_order, SUPPLIERS)


def _affected(d):
    keys = affected_by_payments(d).unionByName(affected_by_reserves(d)).unionByName(affected_by_orders(d)).distinct()
    return folders.materialized(keys, "affected")


@query
def recompute_status(d):
    return propagate.recompute_status(_affected(d), _tables(d), excluded_suppliers=SUPPLIERS)


@query
def recompute_changes(d):
    """Change records that follow from a recompute."""
    changed = propagate.status_changes(propagate.recompute_dated_status(_affected(d), _tables(d), excluded_suppliers=SUPPLIERS))
    return delivery.stock_change_records(changed, d.modification, d.device, None, d.availability, LABELS).records.select(
        "ks", "stock_status_old", "stock_status_new", "mod_id", "time_delivery", "qnt"
    )


# --- exports ------------------------------------------------------------------------------


@query
def field_counts(d):
    return export.field_counts(d.export_field)


@query
def chunk_records(d):
    return export.chunk_records(d.export_field)


@query
def to_wide(d):
    return export.to_wide(export.chunk_records(d.export_field), export.read_dictionary(d.export_dict))


@query
def to_wide_rejects(d):
    return export.to_wide_rejects(export.judged_wide(export.chunk_records(d.export_field), export.read_dictionary(d.export_dict)))


def _export_wide(d, preset):
    """Every kind of export has a dictionary of its own."""
    dictionary = {"device": d.export_dict_device, "modificators": d.export_dict_modificators, "prices": d.export_dict}[preset]
    return export.export_wide(d.export_field, export.read_dictionary(dictionary), d.device, d.export_log, preset)


@query
def export_wide_device(d):
    return _export_wide(d, "device")


@query
def export_wide_modificators(d):
    return _export_wide(d, "modificators")


@query
def export_wide_prices(d):
    return _export_wide(d, "prices")


@query
def batch_prices(d):
    return export.batch_prices(d.export_batch, d.export_log, d.export_field, export.read_dictionary(d.export_dict))


@query
def caret_csv_roundtrip(d):
    """Written as the shop reads it, then read back."""
    wide = export_wide_prices(d)
    folder = folders.shared_folder(d.spark, "caret-csv")
    caret_csv.write_caret_csv(wide, folder)
    return caret_csv.read_caret_csv(d.spark, folder, wide.schema)


@query
def export_plan(d):
    return export.export_plan(d.export_log, d.device, d.import_param)


@query
def validate_exports(d):
    return export.validate_exports(d.export_log, d.device, PROD_SITE, DEV_SITE)


@query
def guard_export_changes(d):
    updates = d.export_log_change.select(
        "exp_id",
        _row(exp_mod="old_exp_mod", exp_csv_status="old_csv_status", exp_site="old_site", exp_status="old_exp_status").alias("before"),
        _row(exp_mod="new_exp_mod", exp_status="new_exp_status", exp_version_num="new_version_num", dev_id="dev_id").alias("after"),
    )
    return export.guard_export_changes(updates, d.device, PROD_SITE)


@query
def guard_synced_fields(d):
    ids = ("ie_xml_id", "ie_xml_id_dt", "ip_prop674", "ip_prop675")
    updates = d.device_change.select(
        "dev_id",
        _row(version_num="old_version_num", **{c: f"old_{c}" for c in ids}).alias("before"),
        _row(**{c: f"new_{c}" for c in ids}).alias("after"),
    )
    return export.guard_synced_fields(updates)


def _export_outcome(d):
    return outcomes.apply_export_outcome(d.stage_result, d.export_log, d.device, AS_OF)


@query
def unfinished_exports(d):
    return outcomes.unfinished_exports(d.stage_result, d.export_log, d.device, UNFINISHED_AS_OF)


@query
def apply_export_outcome(d):
    return _export_outcome(d).exports


@query
def apply_export_outcome_devices(d):
    return _export_outcome(d).devices


def _batch_outcome(d):
    return outcomes.apply_batch_outcome(d.batch_result, d.export_batch, d.export_log, d.device, AS_OF)


@query
def apply_batch_outcome(d):
    return _batch_outcome(d).batches


@query
def apply_batch_outcome_exports(d):
    return _batch_outcome(d).exports


@query
def apply_batch_outcome_devices(d):
    return _batch_outcome(d).devices


@query
def outcome_notices(d):
    return outcomes.outcome_notices(apply_export_outcome(d), apply_batch_outcome(d))


# --- version migration -----------------------------------------------------------------


@query
def shared_parameters(d):
    shown = migrate.shared_parameters(d.mod_param, 1, 2)
    lists = {c: F.array_join(F.transform(c, lambda p: p.cast("string")), ",") for c in ("params_from", "params_to", "shared")}
    return shown.withColumns(lists)


@query
def match_versions(d):
    return migrate.match_versions(d.mod_param, 1, 2)


@query
def match_groups(d):
    return migrate.match_groups(d.mod_param, 1, 2)


@query
def winning_matches(d):
    return migrate.winning_matches(d.mod_param, 1, 2)


@query
def carry_prices(d):
    return migrate.carry_prices(d.modification, winning_matches(d), 1, 2)


# --- reports -----------------------------------------------------------------------------


@query
def exclude_inactive(d):
    return reports.exclude_inactive(lookups.current(d.modification).select("mod_id", "dev_id"), d.site_device, d.device)


@query
def inactive_synced(d):
    return reports.inactive_synced(d.site_device, d.device)


@query
def compare_delivery_by_name(d):
    return reports.compare_delivery(d.modification, d.device, d.site_price, d.site_device, _totals(d), by="name", labels=LABELS)


@query
def compare_delivery_by_key(d):
    return reports.compare_delivery(
        d.modification, d.device, d.site_price, d.site_device, _open(d), content=d.content, by="key", labels=LABELS
    )


@query
def compare_price(d):
    return reports.compare_price(d.content, d.price_view, d.modification, d.device, d.site_price, d.site_device)


@query
def distinct_site_devices(d):
    return reports.distinct_site_devices(d.site_device)


@query
def unsynced_devices(d):
    return reports.unsynced_devices(d.device, d.site_vendor, d.company, d.site_device, extra=reports.DEVICE_PRICES)


@query
def unsynced_devices_loaded(d):
    """The same report over tables as an operational system names them, written and loaded."""
    folder = folders.shared_folder(d.spark, "domain")
    for name in ("device", "site_vendor", "company", "site_device"):
        scan = getattr(d, name)
        scan = scan.withColumnsRenamed({ours: theirs for ours, theirs in SOURCE_NAMES.get(name, {}).items() if ours in scan.columns})
        from_source(scan, name).write.parquet(f"{folder}/{name}")
    t = load_domain(d.spark, folder)
    return reports.unsynced_devices(t["device"], t["site_vendor"], t["company"], t["site_device"], extra=reports.DEVICE_PRICES)


@query
def latest_invoice_firm(d):
    return reports.latest_invoice_firm(d.invoice)


@query
def issuing_firm(d):
    return reports.issuing_firm(d.customer_flag, d.dealer, d.invoice, "vendor_flag", FIRMS)


@query
def unbilled_order_items(d):
    return reports.unbilled_order_items(d.site_order, d.site_order_item, synced_modifications(d), ORDERS_AS_OF)


@query
def log_with_changes(d):
    shown = d.stock_change.select("id", "ks", "dt_change", "change_status", "time_delivery", "qnt")
    return reports.log_with_changes(d.log_entry, shown, LOG_PATTERN)


@query
def log_groups(d):
    return reports.log_groups(d.log_entry, d.stock_change, LOG_PATTERN, slice_bits=6)


@query
def log_with_newest_changes(d):
    shown = d.stock_change.select("id", "ks", "dt_change", "change_status", "time_delivery", "qnt")
    return reports.log_with_newest_changes(d.log_entry, shown, LOG_PATTERN, newest=3)


@query
def sync_report(d):
    """The catalogue is made once and feeds both comparisons."""
    listed = folders.materialized(reports.catalogue(d.modification, d.device, d.site_device), "catalogue")
    prices = folders.materialized(d.site_price, "site-price")
    delivery_part = reports.compare_delivery(d.modification, d.device, prices, d.site_device, _totals(d), by="name", labels=LABELS, listed=listed)
    price_part = reports.compare_price(d.content, d.price_view, d.modification, d.device, prices, d.site_device, listed=listed)
    return reports.sync_report(inactive_synced(d), delivery_part, price_part, d.stock_change)


# --- constraints ---------------------------------------------------------------------------


@query
def check_constraints(d):
    names = tuple(f.name for f in export.read_dictionary(d.export_dict))
    fields = quality.check_constraints(
        d.export_field,
        [
            quality.Unique("export_field.pk", ("csv_id",)),
            quality.Unique("export_field.name", ("exp_id", "mod_csv", "bx_fld_name"), where="mod_csv IN (1, 2)"),
            quality.ForeignKey("export_field.exp_id", "exp_id", d.export_log, "exp_id"),
            quality.MaxLength("export_field.bx_fld_name", "bx_fld_name", 15, ("csv_id",)),
            quality.MaxLength("export_field.bx_fld_value", "bx_fld_value", 4096, ("csv_id",)),
            quality.KnownValue("export_field.dictionary", "bx_fld_name", names, ("csv_id",)),
        ],
    )
    prices = quality.check_constraints(
        d.site_price, [quality.ForeignKey("site_price.section", "ic_xml_id0", d.site_device, "ip_prop674")]
    )
    log = quality.check_constraints(
        d.stock_change,
        [quality.Unique("stock_change.pk", ("id",))]
        + [quality.NotNull(f"stock_change.{c}", c, ("id",)) for c in ("time_delivery", "qnt", "dbl_cnt", "retry_cnt", "active")],
    )
    return fields.unionByName(prices).unionByName(log)


@query
def cascade_delete(d):
    deleted = d.export_log.where(F.col("exp_status") == 2)
    return quality.cascade_delete(d.export_field, deleted)


def _moved(d: Domain) -> dict[str, DataFrame]:
    """Changes of the movements: each table's rows with an odd number move or go, others stay."""
    row = lambda ddl, **new: F.struct(*[new.get(c.split(" ")[0], F.col(c.split(" ")[0])).alias(c.split(" ")[0]) for c in ddl.split(", ")])

    def changed(table: str, op: Column, **new: Column) -> DataFrame:
        before = row(COLUMNS[table])
        return getattr(d, table).select(op.alias("op"), before.alias("before"), F.when(op != "D", row(COLUMNS[table], **new)).alias("after")).where("op IS NOT NULL")

    every = lambda key, n, r, op: F.when(F.col(key) % n == r, F.lit(op))
    return {
        "stock_qty": changed("stock_qty", every("ks", 5, 1, "D")),
        "reserve": changed("reserve", every("invoice_no", 7, 2, "U"), invoice_no=F.col("invoice_no") + 1),
        "incoming_reserve": changed("incoming_reserve", every("invoice_no", 7, 3, "D")),
        "payment": changed("payment", every("invoice_no", 6, 4, "D")),
        "purchase_order": changed("purchase_order", every("order_no", 6, 5, "U"), done=~F.coalesce("done", F.lit(False))),
        "purchase_order_line": changed("purchase_order_line", every("ks", 9, 4, "U"), expected_date=F.col("expected_date") + F.expr("INTERVAL 30 DAYS")),
    }


@query
def maintained_totals(d):
    """Totals filled from the tables and kept up by changes of all of them."""
    totals = StockTotals(d.spark, folders.shared_folder(d.spark, "totals"), buckets=16, excluded_suppliers=SUPPLIERS)
    totals.fill({t: getattr(d, t) for t in COLUMNS})
    totals.apply(0, _moved(d))
    return stock.status_from_totals(stock.current_status(d.content), totals.current(1))


@query
def affected_by_payments_indexed(d):
    """Invoice lines by bucket; the batch's invoices read theirs."""
    folder = folders.shared_folder(d.spark, "invoice-items")
    buckets.write_index(d.invoice_line, folder, "invoice_no", 64)
    return propagate.affected_by_payments_indexed(_payment_changes(d.payment_change), folder, 64)


# --- streams ---------------------------------------------------------------------------------


def _caught_up(stream_query) -> None:
    stream_query.awaitTermination()
    if stream_query.exception() is not None:
        raise stream_query.exception()


def _recompute_stream(d: Domain) -> str:
    """Run the recompute stream over all changes; the folder it wrote."""
    feed = (
        recompute.tagged(_payment_changes(d.view("payment_change", orders=d.stream("orders"))), "payment")
        .unionByName(recompute.tagged(_reserve_changes(d.view("reserve_change", lineitem=d.stream("lineitem"))), "reserve"))
        .unionByName(recompute.tagged(_order_line_changes(d.view("order_line_change", lineitem=d.stream("lineitem"))), "order_line"))
    )
    folder = folders.shared_folder(d.spark, "stream-recompute")

    def tables():
        # A new domain: its tables are listed anew.
        return _tables(Domain(d.spark, d.sf_dir), "invoice_line", "modification", "device", "availability")

    _caught_up(
        recompute.stream_recompute(
            feed, tables, f"{folder}/out", f"{folder}/checkpoint", catch_up=True, buckets=8, excluded_suppliers=SUPPLIERS,
            triggering_exclusions=SUPPLIERS, labels=LABELS,
        )
    )
    return f"{folder}/out"


@query
def stream_recompute(d):
    """What the newest batch of every item says."""
    found = d.spark.read.parquet(f"{_recompute_stream(d)}/status")
    newest = found.groupBy("ks").agg(F.max_by(F.struct("cur", "clc"), "batch").alias("_last"))
    return newest.select("ks", "_last.cur", "_last.clc")


@query
def stream_recompute_changes(d):
    found = d.spark.read.parquet(f"{_recompute_stream(d)}/changes")
    return found.select("ks", "stock_status_old", "stock_status_new", "mod_id", "time_delivery", "qnt")


@query
def stream_route_notifications(d):
    folder = folders.shared_folder(d.spark, "stream-notify")
    notes = d.view("notification", events=d.stream("events"))
    _caught_up(notify.stream_notifications(notes, f"{folder}/out", f"{folder}/checkpoint", catch_up=True))
    return d.spark.read.parquet(f"{folder}/out").select("seq", "route", "target_id", "mod_id", "expected")


def _stream_to_folder(d: Domain, result: DataFrame, purpose: str) -> DataFrame:
    folder = folders.shared_folder(d.spark, purpose)
    _caught_up(sinks.start(result, f"{folder}/checkpoint", path=f"{folder}/out", catch_up=True))
    return d.spark.read.schema(result.schema).parquet(f"{folder}/out")


@query
def stream_change_feed(d):
    """Row changes written as a feed and read as a stream."""
    changes = _payment_changes(d.payment_change)
    folder = folders.shared_folder(d.spark, "feed")
    row = changes.schema["before"].dataType
    changes.withColumn("seq", F.coalesce("after.invoice_no", "before.invoice_no")).select("op", "seq", "before", "after").write.parquet(folder)
    feed = change_feed.read_changes(d.spark, folder, row, max_bytes=1 << 30)
    shown = feed.select("op", "seq", F.col("before.invoice_no").alias("old_invoice_no"), F.col("after.invoice_no").alias("new_invoice_no"))
    return _stream_to_folder(d, shown, "change-feed")


@query
def stream_dedupe(d):
    feed = d.view("stock_change", events=d.stream("events"))
    folder = folders.shared_folder(d.spark, "stream-dedupe")
    _caught_up(dedupe.stream_dedupe(feed, folder, f"{folder}/checkpoint", catch_up=True, buckets=8))
    return d.spark.read.parquet(f"{folder}/out").select("id", "mod_id", "time_delivery", "qnt", "sent", "dbl_cnt")


@query
def stream_retry(d):
    stateful.use_rocksdb(d.spark)
    feed = _attempts(d.view("stock_change", events=d.stream("events")))
    return _stream_to_folder(d, stateful.stream_retry(feed), "stream-retry")
