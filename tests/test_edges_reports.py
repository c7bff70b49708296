"""Hand-made inputs for version migration and reports."""

from datetime import datetime
from decimal import Decimal

from shelfline.functions import constants as C
from shelfline.operators import migrate, reports
from shelfline.sources.tables import from_source, load_domain, schema
from tests.helpers import by_key, rows

PARAM = "dev_id INT, version_num INT, mod_id STRING, dev_param_id INT, param_value STRING"


def parameters(frame):
    def mod(dev, version, mod_id, **values):
        return [(dev, version, mod_id, int(p[1:]), v) for p, v in values.items()]

    return frame(
        PARAM,
        # 1: one shared attribute; two old ones meet one new one, one old one meets two new ones.
        *mod(1, 1, "a", p1="x", p2="q"), *mod(1, 1, "b", p1="x", p2="r"), *mod(1, 1, "c", p1="y", p2="r"), *mod(1, 1, "d", p1=None, p2="r"),
        *mod(1, 2, "k", p1="x", p3="1"), *mod(1, 2, "l", p1="y", p3="1"), *mod(1, 2, "m", p1="y", p3="2"), *mod(1, 2, "n", p1=None, p3="2"),
        # 2: nothing shared.
        *mod(2, 1, "e", p1="x"), *mod(2, 1, "f", p1="y"), *mod(2, 2, "o", p2="x"), *mod(2, 2, "p", p2="x"),
        # 3: all shared, in another order; 4: the new version has more; 5: no new version.
        *mod(3, 1, "g", p2="2", p1="1"), *mod(3, 2, "q", p1="1", p2="2"), *mod(4, 1, "h", p1="1"), *mod(4, 2, "r", p1="1", p2="2"), *mod(5, 1, "i", p1="1"),
        # 6: an old one lacks a shared attribute; another version does not matter.
        *mod(6, 1, "j", p1="1"), *mod(6, 1, "s", p1="1", p2="2"), *mod(6, 2, "t", p1="1", p2="2"), *mod(6, 3, "u", p1="1", p2="2"),
    )


def test_shared_parameters(frame):
    found = by_key(migrate.shared_parameters(parameters(frame), 1, 2), "dev_id", "shared", "relation")
    assert found == {1: ([1], 2), 2: ([], 2), 3: ([1, 2], 1), 4: ([1], 3), 5: ([], 3), 6: ([1, 2], 1)}


def test_match_versions(frame):
    found = rows(migrate.match_versions(parameters(frame), 1, 2))
    assert found == sorted([
        (1, "a", "k"), (1, "b", "k"), (1, "c", "l"), (1, "c", "m"), (1, "d", None),
        (2, "e", "o"), (2, "e", "p"), (2, "f", "o"), (2, "f", "p"),
        (3, "g", "q"), (4, "h", "r"), (5, "i", None), (6, "j", None), (6, "s", "t"),
    ], key=repr)


def test_carry_prices(frame):
    winners = migrate.winning_matches(parameters(frame), 1, 2)
    expected = {"k": "b", "l": "c", "m": "c", "o": "f", "p": "f", "q": "g", "r": "h", "t": "s"}
    assert by_key(winners, "mod_id_to", "mod_id_from") == expected
    ddl = ("mod_id STRING, dev_id INT, version_num INT, ks INT, mod_price DECIMAL(18,2), mod_delivery_time STRING, dm_valuta INT, "
           "dm_kurs DECIMAL(18,4), dm_koef DECIMAL(18,4), price_base DECIMAL(18,2), vendor_art_id STRING, mod_id_prev STRING")
    old = [(m, 1, 1, 1, Decimal(n), None if m == "b" else "t", n, None, None, Decimal(n), m, None) for n, m in enumerate("abcdefghijs", 1)]
    new = [(m, 1, 2, 2, Decimal(99), "own", 99, None, None, Decimal(99), "own", None) for m in "klmnopqrtb"]
    catalogue = frame(ddl, *old, *new)
    for matches in (winners, migrate.match_versions(parameters(frame), 1, 2)):
        carried = by_key(migrate.carry_prices(catalogue, matches, 1, 2), "mod_id", "mod_id_prev", "vendor_art_id", "mod_delivery_time", "ks")
        # NULLs are carried too; what is not carried stays.
        assert carried == {to: (f, f, None if f == "b" else "t", 2) for to, f in expected.items()}


def shop(frame):
    device = frame(
        "dev_id INT, version_num INT, dev_name STRING, timedelivery STRING, ie_xml_id INT, ie_xml_id_dt TIMESTAMP_NTZ, vendor_id INT, supplier_code INT, "
        "dev_name_long STRING, arc_name STRING, mod_single BOOLEAN",
        (1, 1, "One", "9 days", 100, datetime(2024, 1, 1), 1, 1, "L", "A", True), (2, 1, "Two", "8 days", 200, None, 1, None, "L", "A", False),
        (3, 1, "Three", None, None, None, 1, 1, "L", "A", None), (4, 1, "Four", None, None, None, 7, 1, "L", "A", True),
        (5, 1, "Five", None, None, None, 1, 1, "L", "A", True), (1, 2, "One", "old", 100, None, 1, 1, "L", "A", True),
    )
    site = frame(
        "ie_xml_id INT, ie_name STRING, ie_active BOOLEAN, ip_prop474 STRING, ip_prop657 STRING, ip_prop674 STRING",
        (100, "One", True, "t", "u", "674"), (200, "Two", True, "t", "u", "675"), (200, "Two", False, "t", "u", "676"), (0, "Five", False, "t", "u", "677"),
    )
    mods = frame(
        "mod_id STRING, dev_id INT, version_num INT, ks INT, mod_delivery_time STRING, mod_price DECIMAL(18,2)",
        ("001", 1, 1, 11, None, Decimal(5)), ("002", 1, 1, 12, "", Decimal(5)), ("003", 1, 1, 13, "2 weeks", Decimal(5)), ("004", 2, 1, 14, "x", Decimal(5)),
        ("005", 3, 1, 15, "x", Decimal(5)), ("006", 1, 1, 16, "x", Decimal(5)),
    )
    prices = frame(
        "ie_name STRING, ip_prop109 DECIMAL(12,0), ic_xml_id0 INT, ip_prop110 STRING, cv_price DECIMAL(18,2)",
        ("One: 001", Decimal(1), 674, "9 days", None), ("One: 002", Decimal(2), 674, "9 days", Decimal(5)), ("One: 003", Decimal(3), 674, "Ожидается на склад", Decimal(6)),
        ("Two: 004", Decimal(4), 675, "y", Decimal(6)), ("One: 006", Decimal(6), 674, None, Decimal(5)),
    )
    return device, site, mods, prices


def test_compare_delivery(frame):
    device, site, mods, prices = shop(frame)
    totals = frame("ks INT, on_hand DECIMAL(18,4), on_order DECIMAL(18,4), expected_date TIMESTAMP_NTZ",
                   (13, Decimal(0), Decimal(1), datetime(2024, 5, 6)))
    found = rows(reports.compare_delivery(mods, device, prices, site, totals))
    # An empty own term is a term here; the undated label is accepted; an unknown term on the shop
    # is not reported; the second device is switched off.
    assert found == [(12, "One: 002", "", "9 days")]
    content = frame("ks INT, stock_status INT", (11, 2), (12, 0), (13, 1), (14, 2), (16, 2))
    by_number = rows(reports.compare_delivery(mods, device, prices, site, totals, content=content, by="key"))
    assert by_number == [(11, "One: 001", "One: 001", "Со Склада", "9 days"), (12, "One: 002", "One: 002", "", "9 days")]


def test_compare_price(frame):
    device, site, mods, prices = shop(frame)
    content = frame("ks INT, price DECIMAL(18,2)", (11, Decimal(5)), (12, Decimal(5)), (13, Decimal(5)), (14, Decimal(5)), (16, Decimal(5)))
    lists = frame("ks INT, sell_price DECIMAL(18,2)", (11, Decimal(5)), (12, Decimal(5)), (13, Decimal(5)), (14, Decimal(5)), (16, Decimal(4)))
    # 11: unknown shop price and equal others is unknown, so not reported; a difference is.
    assert rows(reports.compare_price(content, lists, mods, device, prices, site), "ks") == [(13,), (16,)]
    differing = frame("ks INT, sell_price DECIMAL(18,2)", (11, Decimal(4)))
    assert rows(reports.compare_price(content, differing, mods, device, prices, site), "ks", "price_site") == [(11, None)]


def test_unsynced_and_inactive_devices(frame):
    device, site, _, _ = shop(frame)
    vendors = frame("vendor_id INT, vendor_name STRING", (1, "V"))
    companies = frame("company_code INT, company_name STRING", (1, "Co"))
    found = reports.unsynced_devices(device, vendors, companies, site, extra=("ie_xml_id",))
    assert rows(found, "dev_name", "export_state", "base_vendor", "single_mod", "ie_xml_id") == [
        ("Three", "Нет на сайте", "Co", "Нет", None), ("Two", "Изменен, не выгружен", None, "Нет", 200),
    ]
    assert rows(reports.inactive_synced(site, device), "id", "model") == [(200, "Two")]


def test_issuing_firm(frame):
    rules = C.FirmRules(special="S", dealer="D", flagged="F", default="E", renamed="OLD", special_customer=5)
    customers = frame("customer_code INT, flag BOOLEAN", *[(i, i == 7) for i in (1, 2, 3, 4, 5, 6, 7)], (8, None))
    day = datetime(2024, 1, 1)
    invoices = frame(
        "invoice_no INT, customer_code INT, firm STRING, invoice_date TIMESTAMP_NTZ",
        (1, 1, "A", day), (2, 1, "B", day), (3, 1, "C", None), (4, 2, "OLD", day), (5, 3, None, day), (6, 7, "A", day), (7, 5, "A", day), (8, 4, "Z", None), (9, 8, "A", day),
    )
    firms = by_key(reports.issuing_firm(customers, frame("customer_code INT", (6,), (6,), (5,)), invoices, "flag", rules), "customer_code", "firm")
    assert firms == {1: "B", 2: "E", 3: None, 4: "E", 5: "S", 6: "D", 7: "F", 8: "A"}


def test_unbilled_order_items(frame):
    orders = frame("order_no INT, billcreated INT, dt_insert TIMESTAMP_NTZ", (1, 2, datetime(2024, 1, 31, 12)), (2, 1, datetime(2024, 1, 31, 12)), (3, 2, datetime(2024, 1, 31)))
    items = frame(
        "order_no INT, item_name STRING, dt_insert TIMESTAMP_NTZ",
        *[(1, n, None) for n in ("a: 001", "b: c: 002", "no digits", "d: 003\n", "e:001 ")], (2, "a: 001", None), (3, "a: 001", None),
    )
    found = reports.unbilled_order_items(orders, items, frame("mod_id STRING", ("001",)), "2024-02-01 00:00:00")
    assert rows(found, "order_no", "model", "site_mod_id", "mod_id") == sorted(
        [(1, "a", "001", "001"), (1, "b", "002", None), (1, "no digits", None, None), (1, "d", None, None), (1, "e", None, None)], key=repr
    )


def test_log_with_changes(frame):
    log = frame("id INT, num STRING, descript STRING, operation STRING, dt TIMESTAMP_NTZ", (1, "11", "x TX y", "o", None), (2, "n/a", "x TX y", "o", None), (3, "11", "other", "o", None), (4, "11", "TX", "o", None))
    change = frame("id INT, ks LONG, dt_change TIMESTAMP_NTZ", (7, 11, datetime(2024, 1, 1)), (8, 11, None), (9, 12, None))
    found = sorted((r.log_id, r.id) for r in reports.log_with_changes(log, change, "%TX%").collect())
    assert found == [(1, 7), (1, 8), (4, 7), (4, 8)]


def test_tables_round_trip(spark, frame, tmp_path):
    raw = frame("`КодСодержания` LONG, `Цена` DOUBLE, stock_status LONG, extra STRING", (1, 2.5, 0, "x"))
    content = from_source(raw, "content")
    assert content.schema == schema("content") and rows(content) == [(1, 0, Decimal("2.50"))]
    content.write.parquet(str(tmp_path / "content"))
    tables = load_domain(spark, str(tmp_path))
    assert rows(tables["content"]) == rows(content)
    assert "stock_change" in tables and len(tables) == len(list(tables))
