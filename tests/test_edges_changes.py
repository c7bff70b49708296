"""Hand-made inputs for the change log and notifications."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from shelfline.functions.text import format_payload, mod_number, trailing_number
from shelfline.operators import changes, lookups
from shelfline.sources.notifications import route_notifications
from tests.helpers import by_key, rows

LOG = "id INT, mod_id STRING, change_status INT, dt_sent TIMESTAMP_NTZ, time_delivery STRING, qnt DECIMAL(18,2), dbl_cnt INT"


def at(hour):
    return datetime(2024, 1, 1, hour)


def log(frame):
    return frame(
        LOG,
        (1, "a", 1, at(1), "t", Decimal(1), 0), (2, "a", 1, at(2), "t", Decimal(2), 5), (3, "a", 2, at(3), "t", Decimal(9), 0),
        (4, "b", 1, at(1), "t", Decimal(1), 0), (5, "b", 0, None, "t", Decimal(1), 0),
        (6, "c", 1, at(4), "t", Decimal(1), 0), (7, "c", 1, at(4), "u", Decimal(1), 0),
        (8, "d", 1, at(4), "t", Decimal(1), 0), (9, "d", 1, None, "u", Decimal(1), 1), (10, "d", -1, at(9), "v", Decimal(1), 0),
    )


def test_last_sent_ties_and_missing_times(frame):
    # Equal times: the highest id. A missing time counts as the newest.
    assert rows(changes.last_sent(log(frame)), "mod_id", "id") == [("a", 2), ("b", 4), ("c", 7), ("d", 9)]


def candidates(frame):
    return frame(
        "mod_id STRING, time_delivery STRING, qnt DECIMAL(18,2)",
        ("a", "t", Decimal(2)), ("a", "t", Decimal(1)), ("b", "t", Decimal(1)), ("c", "u", Decimal(1)), ("c", "u", Decimal(1)),
        ("c", "t", None), ("d", "u", None), ("nope", "t", Decimal(1)),
    )


def test_equals_last_sent(frame):
    found = rows(changes.equals_last_sent(candidates(frame), log(frame)), "mod_id", "time_delivery", "qnt", "equal")
    assert found == [
        ("a", "t", Decimal(1), False), ("a", "t", Decimal(2), True), ("b", "t", Decimal(1), False), ("c", "t", None, False),
        ("c", "u", Decimal(1), True), ("c", "u", Decimal(1), True), ("d", "u", None, None), ("nope", "t", Decimal(1), False),
    ]


def test_count_duplicates(frame):
    counted = by_key(changes.count_duplicates(log(frame), candidates(frame)), "id", "dbl_cnt")
    assert counted == {1: 0, 2: 6, 3: 0, 4: 0, 5: 0, 6: 0, 7: 2, 8: 0, 9: 1, 10: 0}


def test_supersede_pending(frame):
    pending = frame("id INT, mod_id STRING, change_status INT", (1, "a", 0), (2, "a", 0), (3, "a", 1), (4, "b", 0), (5, None, 0), (6, "c", None))
    assert by_key(changes.supersede_pending(pending), "id", "change_status") == {1: -2, 2: -2, 3: 1, 4: 0, 5: 0, 6: None}


def test_changed_rows(frame):
    status = frame("id INT, before STRUCT<stock_status: INT>, after STRUCT<stock_status: INT>",
                   (1, (0,), (1,)), (2, (0,), (0,)), (3, (None,), (None,)), (4, (0,), (None,)))
    assert rows(changes.changed_rows(status, "stock_status"), "id") == [(1,), (3,)]
    computed = frame(
        "id INT, before STRUCT<dt_trans: TIMESTAMP_NTZ>, after STRUCT<ks: INT, change_status: INT, dt_trans: TIMESTAMP_NTZ>",
        (1, (None,), (1, 0, at(1))), (2, (at(1),), (1, 0, at(1))), (3, (None,), (None, 0, at(1))), (4, (None,), (1, 1, at(1))), (5, (None,), (1, 0, None)),
    )
    assert rows(changes.changed_rows(computed, "computed"), "id") == [(1,)]


def test_resend_ignores_sent_and_blocked(frame):
    assert changes.resend_changes(log(frame), 1).count() == 0
    assert changes.resend_changes(log(frame), -1).count() == 0
    assert [tuple(r) for r in changes.resend_changes(log(frame), 2).collect()] == [(3, "do_compute_single", "3")]
    assert [r.payload for r in changes.resend_changes(log(frame), 2, compute_mode=False).collect()] == ["a^t^3^9.00"]


def test_resend_expected(frame):
    shipments = frame("id INT, ks INT, expected STRING, status INT", (2, 11, None, 5), (1, 11, "x", 5), (3, 12, "y", 5), (4, 11, "z", 1))
    mods = frame("mod_id STRING, version_num INT, ks INT", ("m", 1, 11), ("n", 2, 12))
    found = changes.resend_expected(shipments, mods, 5).collect()
    assert [(r.id, r.payload) for r in found] == [(1, "m^x^1"), (2, "m^2")]


def test_payload_null_rules(frame):
    row = frame("a STRING, b STRING", ("x", None))
    shown = row.select(*[format_payload(["a", "b", "a"], nulls=n).alias(n) for n in ("skip", "propagate", "blank")]).first()
    assert tuple(shown) == ("x^x", None, "x^^x")


def test_site_update_messages(frame):
    pending = frame(
        "id INT, mod_id STRING, change_status INT, time_delivery STRING, qnt DECIMAL(18,2), active BOOLEAN",
        (1, "a", 0, "t", None, None), (2, "a", 0, "t", Decimal(2), False), (3, "a", 5, "t", Decimal(2), True),
    )
    assert rows(lookups.site_update_messages(pending), "id", "qnt", "active", "deactivate") == [(1, "", True, False), (2, "2.00", False, True)]
    assert rows(lookups.site_update_messages(pending, null_quantity="None"), "id", "qnt")[0] == (1, "None")


def test_pack_change_events(frame):
    events = frame("id INT, ks INT, qnt DECIMAL(18,2)", (1, 1, Decimal(5)), (2, 2, Decimal(5)), (3, 3, Decimal(5)), (4, 4, None))
    listed = frame("ks INT", (1,), (1,), (2,), (4,))
    pushes = frame(
        "id INT, ks INT, change_status INT, dt_sent TIMESTAMP_NTZ",
        (1, 1, 99, at(3)), (2, 1, 99, at(1)), (3, 1, 0, at(5)), (4, 4, 99, datetime(2024, 1, 1, 5, 59, 57, 500000)),
    )
    packs = frame("ks INT, pack_qty DECIMAL(18,2)", (1, Decimal(2)), (4, Decimal(3)))
    found = changes.pack_change_events(events, listed, pushes, packs, "2024-01-01 06:00:00")
    # The newest confirmed push is the one with the highest id; a half second rounds up.
    assert by_key(found, "id", "elapsed", "payload") == {
        1: (5 * 3600, "1^2.00^1^18000"), 2: (None, "2^^2^"), 4: (3, "4^3.00^4^3"),
    }


def test_route_notifications(frame):
    notes = frame(
        "seq INT, channel STRING, payload STRING",
        (1, "do_compute_single", "7"), (2, "do_compute_single", "x"), (3, "do_expected", "m^e^9"), (4, "do_expected", "m^9"),
        (5, "do_expected", "m^e^f^9"), (6, "do_expected", "m^^9"), (7, "do_export", "8"), (8, "other", "1"), (9, None, "1"), (10, "do_export", None),
    )
    routes = route_notifications(notes)
    assert rows(routes["do_compute_single"], "seq", "target_id") == [(1, 7)]
    assert rows(routes["do_expected"], "seq", "target_id", "mod_id", "expected") == [(3, 9, "m", "e"), (6, 9, "m", "")]
    assert rows(routes["do_export"], "seq", "target_id") == [(7, 8)]
    assert rows(routes["rejected"], "seq") == [(10,), (2,), (4,), (5,), (8,), (9,)]


def test_trailing_number_and_mod_number(frame):
    names = frame("n STRING", ("a: 0012",), ("a:12",), ("a: b: 7",), ("a: x",), ("a: 12\n",), ("a: 12 ",), (None,))
    assert [r[0] for r in names.select(trailing_number("n")).collect()] == ["0012", "12", "7", None, None, None, None]
    ids = frame("n STRING", ("000000000012",), ("12",), ("x",), (None,), ("1000000000000",))
    assert [r[0] for r in ids.select(mod_number(F.col("n"))).collect()] == [Decimal(12), Decimal(12), None, None, Decimal("1" + "0" * 12)]
