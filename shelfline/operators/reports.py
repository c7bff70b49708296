"""Reconciliation: where items, catalogue and shop disagree.

Conditions keep SQL's three-valued logic: a comparison with an unknown value is unknown, and an
unknown row is not reported unless another comparison already differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import constants as C
from shelfline.functions.text import full_mod_name, mod_number, trailing_number
from shelfline.operators.lookups import current
from shelfline.operators.stock import computed_status, expected_label
from shelfline.plans.latest import latest_per_key
from shelfline.plans.lookup import fresh_name, lookup_join
from shelfline.plans.ordinals import SLICE, SLICE_BITS, with_slice


def switched_off(site_device: DataFrame, device: DataFrame) -> DataFrame:
    """Current devices that are switched off on the shop, with the shop's row."""
    return site_device.where(~F.col("ie_active")).join(current(device).select("dev_id", "ie_xml_id"), "ie_xml_id")


def exclude_inactive(df: DataFrame, site_device: DataFrame, device: DataFrame) -> DataFrame:
    """Drop the rows of switched-off devices (``dev_id`` is a key, never NULL)."""
    return df.join(switched_off(site_device, device).select("dev_id"), "dev_id", "left_anti")


def inactive_synced(site_device: DataFrame, device: DataFrame) -> DataFrame:
    """Devices in sync but switched off on the shop."""
    return switched_off(site_device, device).select(
        F.col("ie_xml_id").alias("id"),
        F.col("ip_prop474").alias("title"),
        F.col("ie_name").alias("model"),
        F.col("ip_prop657").alias("changed"),
    )


def catalogue(modification: DataFrame, device: DataFrame, site_device: DataFrame) -> DataFrame:
    """Current modifications linked to an item, on devices with a shop id that are not switched off:
    what :func:`compare_delivery` and :func:`compare_price` compare. A job that needs several reports
    makes it once and passes it to them."""
    on_shop = current(device).where(F.col("ie_xml_id").isNotNull()).select("dev_id", "dev_name", "timedelivery", "ie_xml_id")
    listed = current(modification).where(F.col("ks").isNotNull()).join(on_shop, "dev_id")
    return exclude_inactive(listed, site_device, device).withColumn("mod_name", full_mod_name())


def _term(undated: bool, labels: C.Labels) -> Column:
    date = F.lit(labels.expected + labels.undated) if undated else expected_label("expected_date", labels)
    return (
        F.when(F.col("wh") == C.STATUS_IN_STOCK, F.lit(labels.in_stock_report))
        .when(F.col("wh") == C.STATUS_ON_ORDER, date)
        .otherwise(F.coalesce("mod_delivery_time", "timedelivery"))
    )


def compare_delivery(
    modification: DataFrame,
    device: DataFrame,
    site_price: DataFrame,
    site_device: DataFrame,
    totals: DataFrame,
    content: DataFrame | None = None,
    by: str = "name",
    labels: C.Labels = C.Labels(),
    listed: DataFrame | None = None,
) -> DataFrame:
    """Items whose term on the shop is neither the dated nor the undated one expected.

    ``by='name'`` takes the status computed from ``totals`` and finds the shop row by the
    modification's full name. ``by='key'`` takes the status stored in ``content`` and finds it by
    modification number, section and shop id. ``listed`` is the :func:`catalogue` where it is there
    already.
    """
    listed = catalogue(modification, device, site_device) if listed is None else listed
    mods = listed.select(
        "ks", "mod_id", "dev_id", "mod_name", "mod_delivery_time", "timedelivery", "ie_xml_id"
    )
    if by == "name":
        site = site_price.select(F.col("ie_name").alias("mod_name"), "ip_prop110")
        rows = lookup_join(mods.join(site, "mod_name"), totals, "ks").withColumn("wh", computed_status())
        shown = ["ks", "mod_name"]
    elif by == "key":
        prices = site_price.select(
            F.col("ip_prop109").alias("_number"), mod_number(F.col("ic_xml_id0").cast("string")).alias("_section"),
            "ie_name", "ip_prop110",
        )
        sections = site_device.select("ie_xml_id", mod_number(F.col("ip_prop674").cast("string")).alias("_section"))
        found = (
            mods.withColumn("_number", mod_number("mod_id"))
            .join(content.select("ks", F.col("stock_status").alias("wh")), "ks")
            .join(prices, "_number")
            .join(sections, ["ie_xml_id", "_section"])
        )
        rows = lookup_join(found, totals.select("ks", "expected_date"), "ks")
        shown = ["ks", "mod_name", "ie_name"]
    else:
        raise ValueError(f"unknown way to compare {by!r}")
    site_term = F.col("ip_prop110")
    dated, undated = _term(False, labels), _term(True, labels)
    differing = rows.where(~((site_term == dated) | (site_term == undated)))
    return differing.select(*shown, dated.alias("in_base"), site_term.alias("on_site"))


def compare_price(
    content: DataFrame,
    price_view: DataFrame,
    modification: DataFrame,
    device: DataFrame,
    site_price: DataFrame,
    site_device: DataFrame,
    listed: DataFrame | None = None,
) -> DataFrame:
    """Items whose prices in the item list, price list, catalogue and shop are not all equal.
    ``listed`` is the :func:`catalogue` where it is there already."""
    listed = catalogue(modification, device, site_device) if listed is None else listed
    rows = (
        listed.select("ks", "dev_id", "mod_name", F.col("mod_price").alias("price_catalogue"))
        .join(content.select("ks", F.col("price").alias("price_item")), "ks")
        .join(price_view.select("ks", F.col("sell_price").alias("price_list")), "ks")
        .join(site_price.select(F.col("ie_name").alias("mod_name"), F.col("cv_price").alias("price_site")), "mod_name", "left")
    )
    item = F.col("price_item")
    equal = (item == F.col("price_list")) & (item == F.col("price_catalogue")) & (item == F.col("price_site"))
    return rows.where(~equal).select(
        "ks", "mod_name", "price_item", "price_list", "price_catalogue", "price_site"
    )


def distinct_site_devices(site_device: DataFrame) -> DataFrame:
    return site_device.select("ie_name", "ie_active").distinct()


# Price columns of a device that the report of unsynced devices shows last.
DEVICE_PRICES = ("dm_discount_vendor", "dm_discount_diler", "basic_price_rur", "dm_valuta")


def unsynced_devices(
    device: DataFrame,
    site_vendor: DataFrame,
    company: DataFrame,
    site_device: DataFrame,
    texts: C.ReportTexts = C.ReportTexts(),
    extra: Sequence[str] = (),
) -> DataFrame:
    """Current devices without a shop id or sync time that are active on, or absent from, the
    shop. ``extra`` names more device columns to show, such as :data:`DEVICE_PRICES`."""
    missing = current(device).where(F.col("ie_xml_id").isNull() | F.col("ie_xml_id_dt").isNull())
    rows = (
        missing.join(site_vendor, "vendor_id")
        .join(company.withColumnRenamed("company_code", "supplier_code"), "supplier_code", "left")
        .join(distinct_site_devices(site_device).withColumnRenamed("ie_name", "dev_name"), "dev_name", "left")
        .where(F.coalesce("ie_active", F.lit(True)))
    )
    state = (
        F.when(F.col("ie_active").isNull(), texts.absent)
        .when(F.col("ie_xml_id").isNull(), texts.not_exported)
        .otherwise(texts.changed)
    )
    return rows.select(
        state.alias("export_state"),
        "dev_name_long",
        "dev_name",
        "arc_name",
        F.col("vendor_name").alias("site_vendor"),
        F.col("company_name").alias("base_vendor"),
        F.when(F.col("mod_single"), texts.yes).otherwise(texts.no).alias("single_mod"),
        "timedelivery",
        *extra,
    )


def latest_invoice_firm(invoice: DataFrame) -> DataFrame:
    """Firm on the newest dated invoice of every customer; the highest number breaks ties."""
    dated = invoice.where(F.col("invoice_date").isNotNull())
    return latest_per_key(dated, "customer_code", [F.col("invoice_date"), F.col("invoice_no")], ["firm"])


def issuing_firm(
    customers: DataFrame, dealer: DataFrame, invoice: DataFrame, flag: str, rules: C.FirmRules
) -> DataFrame:
    """Firm that bills each row of ``customers(customer_code, <flag>)``: the special customer's
    own, the dealers', the flagged ones', the one that billed last, or the default. A renamed
    firm becomes the default."""
    dealers = dealer.select("customer_code").distinct().withColumn("_dealer", F.lit(True))
    last = latest_invoice_firm(invoice).select("customer_code", F.col("firm").alias("_last"), F.lit(True).alias("_billed"))
    firm = (
        F.when(F.col("customer_code") == rules.special_customer, rules.special)
        .when(F.col("_dealer"), rules.dealer)
        .when(F.col(flag), rules.flagged)
        .when(F.col("_billed"), F.col("_last"))
        .otherwise(rules.default)
    )
    return (
        customers.join(dealers, "customer_code", "left")
        .join(last, "customer_code", "left")
        .withColumn("firm", firm)
        .select("customer_code", F.when(F.col("firm") == rules.renamed, rules.default).otherwise(F.col("firm")).alias("firm"))
    )


def unbilled_order_items(
    site_order: DataFrame,
    site_order_item: DataFrame,
    synced: DataFrame,
    as_of: str,
    bill_state: int = 2,
    period: str = "INTERVAL 1 DAY",
) -> DataFrame:
    """Items of recent orders that got no bill automatically, by order, with the synced
    modification their name ends in."""
    since = F.lit(as_of).cast("timestamp_ntz") - F.expr(period)
    orders = site_order.where((F.col("billcreated") == bill_state) & (F.col("dt_insert") > since)).select("order_no")
    items = site_order_item.join(orders, "order_no", "left_semi").select(
        "order_no",
        "dt_insert",
        F.split_part("item_name", F.lit(":"), F.lit(1)).alias("model"),
        trailing_number("item_name").alias("site_mod_id"),
    )
    mods = synced.select("mod_id").withColumn("site_mod_id", F.col("mod_id"))
    return (
        items.join(mods, "site_mod_id", "left")
        .select("order_no", "dt_insert", "model", "site_mod_id", "mod_id")
        .orderBy("order_no")
    )


def _matching_log(audit_log: DataFrame, pattern: str) -> DataFrame:
    """Log rows whose description matches, by the item they name."""
    return audit_log.where(F.col("descript").like(pattern)).select(
        F.col("id").alias("log_id"), "descript", "operation", F.col("dt").alias("log_dt"), F.col("num").try_cast("long").alias("ks")
    )


def log_with_changes(audit_log: DataFrame, stock_change: DataFrame, pattern: str) -> DataFrame:
    """Log rows whose description matches, each with the changes of its item, in no set order: the
    pairs are the report, and whoever shows a part of it sorts that part. :func:`log_groups` says the
    same without pairs, :func:`log_with_newest_changes` shows the newest of them in order.

    The log is filtered before it is joined; rows whose number is not a number match nothing.
    """
    log = _matching_log(audit_log, pattern)
    return stock_change.join(log, "ks").select("log_id", "descript", "operation", "log_dt", *stock_change.columns)


def log_groups(audit_log: DataFrame, stock_change: DataFrame, pattern: str, slice_bits: int = SLICE_BITS) -> DataFrame:
    """The groups of :func:`log_with_changes`: ``ks, kind, id, slice, n_log, n_changes``, a row for
    each ``log`` row and each ``change`` that has a counterpart.

    Every log row of an item goes with every change of it: ``n_log * n_changes`` pairs, which the
    members say without being multiplied. ``slice`` cuts long groups by id, so that a reader
    who wants the pairs of an item can take them slice by slice. A member without item is in no group.
    """
    log = _matching_log(audit_log, pattern).select("ks", F.lit("log").alias("kind"), F.col("log_id").cast("long").alias("id"))
    changes = stock_change.select(F.col("ks").cast("long").alias("ks"), F.lit("change").alias("kind"), F.col("id").cast("long").alias("id"))
    members = log.unionByName(changes).where("ks IS NOT NULL")
    sizes = members.groupBy("ks").agg(
        F.count_if(F.col("kind") == "log").alias("n_log"), F.count_if(F.col("kind") == "change").alias("n_changes")
    )
    sliced = with_slice(members, "id", slice_bits).withColumnRenamed(SLICE, "slice")
    found = lookup_join(sliced, sizes.where("n_log > 0 AND n_changes > 0"), "ks", "inner")
    return found.select("ks", "kind", "id", "slice", "n_log", "n_changes")


def log_with_newest_changes(audit_log: DataFrame, stock_change: DataFrame, pattern: str, newest: int = 10) -> DataFrame:
    """Matching log rows, each with the ``newest`` changes of its item: ``log_id, descript, operation,
    log_dt, position`` and the columns of ``stock_change``. ``position`` 1 is the newest; a change
    without time is older than all others, the higher id wins a tie.

    Every task keeps the first ``newest`` of an item before rows are shuffled, so an item with
    very many changes sends few; what its log rows meet is one small array.
    """
    log = _matching_log(audit_log, pattern)
    by_age = Window.partitionBy("ks").orderBy(F.desc_nulls_last("dt_change"), F.desc("id"))
    place = fresh_name("_place", stock_change)
    ranked = stock_change.where("ks IS NOT NULL").withColumn(place, F.row_number().over(by_age)).where(F.col(place) <= newest)
    rows = F.array_sort(F.collect_list(F.struct(F.col(place).alias("position"), F.struct(*stock_change.columns).alias("change"))))
    shown = ranked.groupBy(F.col("ks").cast("long").alias("ks")).agg(rows.alias("_rows"))
    listed = lookup_join(log, shown, "ks", "inner").select("log_id", "descript", "operation", "log_dt", F.inline("_rows"))
    return listed.select("log_id", "descript", "operation", "log_dt", "position", "change.*")


def sync_report(
    inactive: DataFrame, delivery: DataFrame, price: DataFrame, stock_change: DataFrame
) -> DataFrame:
    """The daily report as one long table: ``kind, key, expected, actual``. Built from the
    results of :func:`inactive_synced`, :func:`compare_delivery` and :func:`compare_price`, and
    the changes whose sending failed."""

    def part(df: DataFrame, kind: str, key: Column, expected: Column, actual: Column) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"),
            key.cast("string").alias("key"),
            expected.cast("string").alias("expected"),
            actual.cast("string").alias("actual"),
        )

    failed = stock_change.where(F.col("change_status") == C.FAILED)
    return (
        part(inactive, "inactive", F.col("id"), F.lit("active"), F.lit("switched off"))
        .unionByName(part(delivery, "delivery", F.col("ks"), F.col("in_base"), F.col("on_site")))
        .unionByName(part(price, "price", F.col("ks"), F.col("price_item"), F.col("price_site")))
        .unionByName(part(failed, "send", F.col("id"), F.col("time_delivery"), F.col("sent_result")))
    )
