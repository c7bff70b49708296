"""Hand-made inputs for stock, delivery terms and propagation."""

from datetime import datetime
from decimal import Decimal

import pytest

from shelfline.functions import constants as C
from shelfline.operators import delivery, lookups, propagate, stock
from shelfline.sources import logs
from tests.helpers import by_key, rows

NOW = "2024-02-01 00:00:00"


@pytest.fixture
def tables(frame):
    """Item 1: in stock; 2: reserved away but on order; 3: nothing; 4: paid +5 and -5."""
    day = datetime(2024, 3, 1)
    return {
        "content": frame("ks INT, stock_status INT", (1, 0), (2, None), (3, 0), (4, 2)),
        "stock_qty": frame(
            "ks INT, warehouse_id INT, free_qty DOUBLE",
            (1, 2, 5.0), (1, None, 50.0), (1, 3, 50.0), (2, 2, 3.0), (4, 2, 1.0), (9, 2, 7.0),
        ),
        "reserve": frame(
            "ks INT, invoice_no INT, reserved_qty DOUBLE, reserve_status INT, released_at TIMESTAMP_NTZ",
            (1, 10, 4.0, 1, None), (1, 10, 4.0, 3, None), (1, 10, 4.0, None, None), (1, 10, 4.0, 1, day),
            (2, 10, 3.0, 0, None), (4, 11, 1.0, 0, None), (4, 12, 1.0, 0, None), (4, 13, 1.0, 0, None),
        ),
        "incoming_reserve": frame(
            "ks INT, invoice_no INT, reserved_qty DOUBLE, released_at TIMESTAMP_NTZ", (2, 10, 1.0, None), (3, 10, 9.0, None)
        ),
        "payment": frame("invoice_no INT, amount DOUBLE", (10, 0.5), (11, 5.0), (11, -5.0), (12, -1.0)),
        "purchase_order": frame(
            "order_no INT, supplier_code INT, cancelled BOOLEAN, done BOOLEAN",
            (1, 5, None, None), (2, 210463, False, False), (3, None, False, False), (4, 5, True, False),
        ),
        "purchase_order_line": frame(
            "order_no INT, ks INT, qty DOUBLE, cancelled BOOLEAN, done BOOLEAN, invoice_no INT, received_at TIMESTAMP_NTZ, expected_date TIMESTAMP_NTZ",
            (1, 2, 2.0, None, False, None, None, day), (1, 2, 2.0, True, False, None, None, None), (2, 3, 50.0, False, False, None, None, None),
            (3, 3, 50.0, False, False, None, None, None), (4, 3, 50.0, False, False, None, None, None), (1, 3, 50.0, False, False, 7, None, None),
            (1, 3, 50.0, False, False, None, day, None),
        ),
    }


def status(tables):
    return stock.stock_status(*[tables[t] for t in (
        "content", "stock_qty", "reserve", "incoming_reserve", "payment", "purchase_order", "purchase_order_line")])


def test_status(tables):
    # 1: 5 - 4 (an unknown or closed reserve status and a release do not count, nor an unknown
    # warehouse); 2: 3 - 3 and 2 - 1 on order; 3: excluded, unknown or cancelled orders only;
    # 4: none of the three invoices is paid.
    assert by_key(status(tables), "ks", "cur", "clc") == {1: (0, 2), 2: (-1, 1), 3: (0, 0), 4: (2, 2)}


def test_apply_status_and_log(tables):
    computed = status(tables)
    content = tables["content"]
    assert by_key(stock.apply_status(content, computed), "ks", "stock_status") == {1: 2, 2: 1, 3: 0, 4: 2}
    assert by_key(stock.apply_status(content, computed, mode=False), "ks", "stock_status") == {1: 0, 2: None, 3: 0, 4: 2}
    log = logs.transition_log(computed, NOW)
    assert by_key(log, "num", "operation") == {"1": "0->2", "2": "-1->1", "3": "0->0", "4": "2->2"}


def test_log_is_appended_by_day(spark, tables, tmp_path):
    for day in ("2024-02-01 10:00:00", "2024-02-02 10:00:00"):
        logs.append_log(logs.transition_log(status(tables), day), str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    assert {str(r.day): r["count"] for r in stored.groupBy("day").count().collect()} == {"2024-02-01": 4, "2024-02-02": 4}


def test_recompute_only_what_is_asked(tables, frame):
    keys = frame("ks INT", (2,), (2,), (9,))
    assert by_key(propagate.recompute_status(keys, tables), "ks", "cur", "clc") == {2: (-1, 1), 9: (None, 2)}
    assert rows(logs.transition_log(propagate.recompute_status(frame("ks INT", (9,)), tables), NOW), "num", "operation") == [("9", None)]


def test_recompute_of_everything_is_the_status(tables):
    assert rows(propagate.recompute_status(tables["content"], tables)) == rows(status(tables))


def test_status_changes_skip_unknown_items(frame):
    found = propagate.status_changes(frame("ks INT, cur INT, clc INT", (1, 0, 2), (2, -1, 0), (3, 1, 1), (4, None, 2)))
    assert rows(found) == [(1, 0, 2), (2, None, 0)]


def test_expected_label(frame, tables):
    orders = stock.open_purchase(tables["purchase_order"], tables["purchase_order_line"])
    assert rows(orders) == [(2, Decimal("2.0000"), datetime(2024, 3, 1))]
    labels = by_key(stock.expected_date_label(frame("ks INT", (2,), (3,)), orders), "ks", "expected_label")
    assert labels == {2: "Ожидается 2024.03.01", 3: "Ожидается на склад"}


@pytest.fixture
def catalogue(frame):
    mods = frame(
        "mod_id STRING, dev_id INT, version_num INT, ks INT, mod_delivery_time STRING",
        ("m1", 1, 1, 11, "2 weeks"), ("m2", 1, 1, 12, ""), ("m3", 1, 1, 13, None), ("m4", 2, 1, 14, None),
        ("m5", 3, 1, 15, None), ("m6", 1, 2, 16, "old"), ("m7", 1, 1, None, None), ("m8", 1, 1, 11, "5 weeks"),
    )
    devices = frame(
        "dev_id INT, version_num INT, dev_name STRING, timedelivery STRING, ie_xml_id INT, ie_xml_id_dt TIMESTAMP_NTZ, supplier_code INT",
        (1, 1, "One", "9 days", 100, datetime(2024, 1, 1), 7), (1, 2, "One, old", "x", 100, datetime(2024, 1, 1), 7),
        (2, 1, "Two", None, 200, datetime(2024, 1, 1), None), (3, 0, "Three", "3 days", None, None, None),
    )
    return mods, devices


def test_default_delivery(frame, catalogue):
    asked = frame("mod_id STRING", ("m1",), ("m2",), ("m3",), ("m4",), ("m5",), ("m6",), ("nope",))
    assert by_key(delivery.default_delivery(asked, *catalogue), "mod_id", "time_delivery") == {
        "m1": "2 weeks", "m2": "9 days", "m3": "9 days", "m4": None, "m5": "device not found",
        "m6": "modification not found", "nope": "modification not found",
    }


def test_change_records(frame, catalogue):
    changes = frame("ks INT, old_status INT, new_status INT", (11, 0, 2), (12, 2, 1), (13, None, 0), (14, 2, 0), (15, 0, 1), (99, 0, 1), (12, 1, 7))
    orders = frame("ks INT, expected_date TIMESTAMP_NTZ", (12, datetime(2024, 5, 6)))
    available = frame("ks INT, available_qty DECIMAL(18,2)", (11, Decimal("3")))
    accepted = delivery.stock_change_records(changes, *catalogue, orders, available)
    # Of two modifications of an item the highest counts.
    assert rows(accepted.records, "ks", "stock_status_old", "mod_id", "mod_name", "time_delivery", "qnt") == [
        (11, 0, "m8", "One: m8", "Со склада", Decimal("3.00")),
        (12, 2, "m2", "One: m2", "Ожидается 2024.05.06", Decimal("0.00")),
        (13, None, "m3", "One: m3", "9 days", Decimal("0.00")),
    ]
    assert rows(accepted.rejected) == [
        (12, 7, "no delivery term"), (14, 0, "no delivery term"), (15, 1, "no exported modification"), (99, 1, "no exported modification"),
    ]


def test_change_without_quantity_is_rejected(frame, catalogue):
    accepted = delivery.stock_change_records(
        frame("ks INT, old_status INT, new_status INT", (11, 0, 2)), *catalogue,
        frame("ks INT, expected_date TIMESTAMP_NTZ"), frame("ks INT, available_qty DECIMAL(18,2)"),
    )
    assert accepted.records.count() == 0
    assert rows(accepted.rejected) == [(11, 2, "no quantity")]


def test_lookups(frame, catalogue):
    mods, devices = catalogue
    assert rows(lookups.synced_modifications(mods, devices)) == [
        (11, "One", 7, "m1"), (11, "One", 7, "m8"), (12, "One", 7, "m2"), (13, "One", 7, "m3"), (14, "Two", None, "m4"),
    ]
    assert by_key(lookups.attach_mod_id(frame("ks INT", (11,), (16,)), mods), "ks", "mod_id") == {11: "m8", 16: None}
    assert by_key(lookups.attach_item_code(frame("mod_id STRING", ("m2",), ("m7",), ("m6",)), mods), "mod_id", "ks") == {"m2": 12, "m7": None, "m6": None}


def test_delivery_outcome(frame):
    attempts = [(i, 0, "run: " + f) for i, f in enumerate(C.TRANSIENT_FRAGMENTS, 10)]
    attempts += [(i, 0, f) for i, f in enumerate(C.TRANSIENT_FRAGMENTS, 20)]
    attempts += [(1, 2, None), (2, 2, ""), (3, 2, "bad model"), (4, 3, "x timed out"), (5, 4, "x timed out")]
    found = by_key(delivery.delivery_outcome(frame("id INT, retry_cnt INT, error STRING", *attempts), "site", NOW), "id", "change_status", "retry_cnt", "resend")
    for i in range(len(C.TRANSIENT_FRAGMENTS)):
        assert found[10 + i] == (10 + i, 1, True)
        # A fragment at the very start is not transient.
        assert found[20 + i] == (-1, 0, False)
    assert found[1] == found[2] == (1, 2, False)
    assert found[3] == (-1, 0, False)
    assert found[4] == (4, 4, True)
    assert found[5] == (2, 5, False)
    expected = delivery.expected_outcome(frame("id INT, retry_cnt INT, error STRING", (1, 2, None), (4, 0, "bad")), "site", NOW)
    assert rows(expected, "id", "status", "dt_sent") == [(1, 1, datetime(2024, 2, 1)), (4, -1, datetime(2024, 2, 1))]


def test_affected_by_payments(frame):
    lines = frame("invoice_no INT, ks INT", (1, 11), (1, 12), (2, 21), (3, 31), (4, 41), (5, 51))
    changes = frame(
        "op STRING, before STRUCT<invoice_no: INT>, after STRUCT<invoice_no: INT>",
        ("I", None, (1,)), ("D", (2,), None), ("U", (None,), (3,)), ("U", (4,), (None,)), ("I", (5,), (1,)),
    )
    # An update that loses its invoice does not reach the old one: the comparison is unknown.
    assert rows(propagate.affected_by_payments(changes, lines)) == [(11,), (12,), (21,), (31,)]
    moved = frame("op STRING, before STRUCT<invoice_no: INT>, after STRUCT<invoice_no: INT>", ("U", (4,), (5,)), ("U", (2,), (2,)))
    assert rows(propagate.affected_by_payments(moved, lines)) == [(21,), (41,), (51,)]


def test_affected_by_reserves_and_stock(frame):
    row = "STRUCT<ks: INT, invoice_no: INT, released_at: TIMESTAMP_NTZ>"
    day = datetime(2024, 1, 1)
    changes = frame(
        f"op STRING, before {row}, after {row}",
        ("I", None, (1, 1, None)), ("D", (2, 1, None), None), ("U", (3, 1, None), (3, 1, None)), ("U", (4, 1, None), (5, 1, day)),
        ("U", (6, None, None), (6, 2, None)), ("I", None, (None, 1, None)),
    )
    assert rows(propagate.affected_by_reserves(changes)) == [(1,), (2,), (5,), (6,)]
    assert rows(propagate.affected_by_stock(changes)) == [(i,) for i in range(1, 7)]


def test_affected_by_orders(frame):
    orders = frame("order_no INT, supplier_code INT", (1, 5), (2, 203463), (3, 225073), (4, 210463), (5, None))
    changes = frame(
        "op STRING, before STRUCT<order_no: INT, ks: INT>, after STRUCT<order_no: INT, ks: INT>",
        *[("I", None, (n, n * 10)) for n in (1, 2, 3, 4, 5, 6)],
    )
    # The suppliers left out here are not those left out of the open orders.
    assert rows(propagate.affected_by_orders(changes, orders)) == [(10,), (40,)]
