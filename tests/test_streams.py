"""Streams against their batch forms."""

import random
import time
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.operators import changes, delivery, propagate
from shelfline.sources.change_feed import change_schema, read_changes
from shelfline.streaming import dedupe, notify, recompute, sinks, stateful
from tests.conftest import SMALL
from tests.helpers import rows
from workloads.queries import QUERIES, SUPPLIERS, _affected, _tables
from workloads.views import domain

LOG = "id BIGINT, mod_id STRING, time_delivery STRING, qnt DECIMAL(18,2)"


def feed(spark, folder, ddl, *batches):
    """Write the batches one file each and read them one a micro-batch."""
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, ddl).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.01 * n)
    schema = spark.createDataFrame([], ddl).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drained(result, folder):
    query = sinks.start(result, f"{folder}/checkpoint", path=f"{folder}/out", catch_up=True)
    query.awaitTermination()
    assert query.exception() is None
    return result.sparkSession.read.schema(result.schema).parquet(f"{folder}/out")


def test_dedupe_over_many_batches(spark, tmp_path):
    random.seed(3)
    from decimal import Decimal

    source = [(i, f"m{i % 3 % 2}", random.choice(["t", "t", "u", None]), random.choice([Decimal("1.00"), Decimal("1.00"), None])) for i in range(60)]
    batches = [source[:7], source[7:8], source[8:30], source[30:]]
    for batch in batches:
        random.shuffle(batch)
    found = deduped(feed(spark, tmp_path / "in", LOG, *batches), tmp_path)
    assert rows(found) == rows(changes.suppress_repeats(spark.createDataFrame(source, LOG)))


def deduped(stream, folder):
    query = dedupe.stream_dedupe(stream, f"{folder}/dedupe", f"{folder}/checkpoint", catch_up=True)
    query.awaitTermination()
    assert query.exception() is None
    found = stream.sparkSession.read.parquet(f"{folder}/dedupe/out")
    return found.select("id", "mod_id", "time_delivery", "qnt", "sent", "dbl_cnt")


def test_dedupe_of_a_hot_modification(spark, tmp_path):
    source = [(i, "hot" if i % 10 < 7 else f"m{i % 5}", "t" if i % 50 else "u", None if i % 90 == 3 else 1) for i in range(600)]
    schema = "id BIGINT, mod_id STRING, time_delivery STRING, qnt INT"
    found = deduped(feed(spark, tmp_path / "in", schema, source[:300], source[300:]), tmp_path)
    assert rows(found) == rows(changes.suppress_repeats(spark.createDataFrame(source, schema)))


def test_dedupe_tells_late_rows(spark, tmp_path):
    schema = "id BIGINT, mod_id STRING, time_delivery STRING, qnt INT"
    batches = [[(5, "a", "t", 1), (6, "b", "t", 1)], [(4, "a", "t", 1), (5, "a", "t", 1), (7, "a", "t", 1), (3, "c", "t", 1)]]
    found = deduped(feed(spark, tmp_path / "in", schema, *batches), tmp_path)
    assert rows(found, "id", "mod_id", "sent", "dbl_cnt") == [(3, "c", True, 0), (5, "a", True, 0), (6, "b", True, 0), (7, "a", False, 1)]
    assert rows(spark.read.parquet(f"{tmp_path}/dedupe/late"), "id", "mod_id") == [(4, "a"), (5, "a")]


@pytest.fixture(autouse=True)
def rocksdb(spark):
    stateful.use_rocksdb(spark)


def test_retry_counts_across_batches(spark, tmp_path):
    ddl = "id BIGINT, seq BIGINT, retry_cnt BIGINT, error STRING"
    lost = "call: timed out"
    batches = [
        [(7, 1, 0, lost), (8, 1, 4, lost), (9, 1, 0, "bad")], [(7, 2, 0, lost), (9, 2, 0, None)], [(7, 3, 0, lost), (7, 4, 0, lost)], [(7, 5, 0, lost)],
    ]
    result = drained(stateful.stream_retry(feed(spark, tmp_path / "in", ddl, *batches)), tmp_path)
    outcomes = rows(result.where("event = 'outcome'"), "id", "retry_cnt", "change_status", "resend")
    assert outcomes == sorted(
        [(7, 1, 7, True), (7, 2, 7, True), (7, 3, 7, True), (7, 4, 7, True), (7, 5, 2, False), (8, 5, 2, False), (9, 0, -1, False), (9, 0, 1, False)],
        key=repr,
    )
    # At most four resends.
    assert result.where("event = 'resend' AND id = 7").count() == 4 and result.where("event = 'resend'").count() == 4


def test_retry_agrees_with_the_batch_outcome(spark, tmp_path):
    attempts = [(i, i, i % 6, [None, "", "x client.y", "client.y", "no"][i % 5]) for i in range(100)]
    ddl = "id BIGINT, seq BIGINT, retry_cnt BIGINT, error STRING"
    result = drained(stateful.stream_retry(feed(spark, tmp_path / "in", ddl, attempts)), tmp_path)
    batch = delivery.delivery_outcome(spark.createDataFrame(attempts, ddl), "site", "2024-02-01 00:00:00")
    columns = ["id", "change_status", "retry_cnt", "resend"]
    assert rows(result.where("event = 'outcome'"), *columns) == rows(batch, *columns)


def paused(spark, tmp_path, *batches, wait):
    """Rows a retry stream with a pause writes within ``wait`` seconds after its last attempt."""
    ddl = "id BIGINT, seq BIGINT, retry_cnt BIGINT, error STRING"
    attempts = sum(map(len, batches))
    result = stateful.stream_retry(feed(spark, tmp_path / "in", ddl, *batches), pause_ms=3000)
    query = sinks.start(result, f"{tmp_path}/checkpoint", path=f"{tmp_path}/out")
    read = spark.read.schema(result.schema)
    try:
        done = None
        for _ in range(120):
            time.sleep(1)
            assert query.exception() is None
            if (tmp_path / "out" / "_spark_metadata").exists():
                found = read.parquet(f"{tmp_path}/out")
                if done is None and found.where("event = 'outcome'").count() == attempts:
                    done = time.time()
            if done and time.time() - done > wait:
                return rows(read.parquet(f"{tmp_path}/out"), "id", "event", "resend")
        raise AssertionError("attempts were not worked off")
    finally:
        query.stop()


def test_retry_pause_keeps_every_resend_and_drops_stale_ones(spark, tmp_path):
    lost = "call: timed out"
    found = paused(spark, tmp_path, [(7, 1, 0, lost), (7, 2, 0, lost), (8, 1, 0, lost), (8, 2, 0, None), (9, 1, 0, lost), (9, 2, 0, "bad")], wait=14)
    # Two attempts in one batch, two resends; none after a success or a final failure.
    assert [f for f in found if f[1] == "resend"] == [(7, "resend", True)] * 2
    assert len([f for f in found if f[1] == "outcome"]) == 6


def test_recompute_equals_the_batch(spark):
    d = domain(spark, SMALL)
    batch = propagate.recompute_status(_affected(d), _tables(d), excluded_suppliers=SUPPLIERS)
    assert rows(QUERIES["stream_recompute"](spark, SMALL)) == rows(batch)


def test_recompute_from_a_change_feed(spark, tmp_path):
    tables = {
        "content": spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "ks INT, stock_status INT"),
        "stock_qty": spark.createDataFrame([(1, 2, 1.0), (3, 2, 1.0)], "ks INT, warehouse_id INT, free_qty DOUBLE"),
        "reserve": spark.createDataFrame([], "ks INT, invoice_no INT, reserved_qty DOUBLE, reserve_status INT, released_at TIMESTAMP_NTZ"),
        "incoming_reserve": spark.createDataFrame([], "ks INT, invoice_no INT, reserved_qty DOUBLE, released_at TIMESTAMP_NTZ"),
        "payment": spark.createDataFrame([], "invoice_no INT, amount DOUBLE"),
        "purchase_order": spark.createDataFrame([(5, 1, None, None), (6, 225073, None, None)], "order_no INT, supplier_code INT, cancelled BOOLEAN, done BOOLEAN"),
        "purchase_order_line": spark.createDataFrame(
            [], "order_no INT, ks INT, qty DOUBLE, cancelled BOOLEAN, done BOOLEAN, invoice_no INT, received_at TIMESTAMP_NTZ, expected_date TIMESTAMP_NTZ"
        ),
        "invoice_line": spark.createDataFrame([(10, 1), (10, 2), (11, 3)], "invoice_no INT, ks INT"),
    }
    row = spark.createDataFrame([], "invoice_no INT").schema
    written = spark.createDataFrame([("I", 1, None, (10,)), ("D", 2, (12,), None)], change_schema(row))
    written.write.parquet(str(tmp_path / "payments"))
    paid = recompute.tagged(read_changes(spark, str(tmp_path / "payments"), row), "payment")
    query = recompute.stream_recompute(paid, lambda: tables, f"{tmp_path}/out", f"{tmp_path}/checkpoint", catch_up=True)
    query.awaitTermination()
    assert query.exception() is None
    assert rows(spark.read.parquet(f"{tmp_path}/out/status"), "ks", "cur", "clc") == [(1, 0, 2), (2, 0, 0)]
    # A repeated batch replaces its own result.
    sinks.write_batch(spark.createDataFrame([(9, 0, 0)], "ks INT, cur INT, clc INT"), f"{tmp_path}/out/status", 0)
    assert rows(spark.read.parquet(f"{tmp_path}/out/status"), "ks") == [(9,)]


def test_recompute_reads_tables_anew_and_writes_back(spark, tmp_path):
    folder, calls = str(tmp_path / "stock"), []
    stock = "ks INT, warehouse_id INT, free_qty DOUBLE"
    spark.createDataFrame([(2, 2, 1.0)], stock).write.parquet(folder)
    fixed = {
        "content": spark.createDataFrame([(1, 0), (2, 2)], "ks INT, stock_status INT"),
        "reserve": spark.createDataFrame([], "ks INT, invoice_no INT, reserved_qty DOUBLE, reserve_status INT, released_at TIMESTAMP_NTZ"),
        "incoming_reserve": spark.createDataFrame([], "ks INT, invoice_no INT, reserved_qty DOUBLE, released_at TIMESTAMP_NTZ"),
        "payment": spark.createDataFrame([], "invoice_no INT, amount DOUBLE"),
        "purchase_order": spark.createDataFrame([], "order_no INT, supplier_code INT, cancelled BOOLEAN, done BOOLEAN"),
        "purchase_order_line": spark.createDataFrame(
            [], "order_no INT, ks INT, qty DOUBLE, cancelled BOOLEAN, done BOOLEAN, invoice_no INT, received_at TIMESTAMP_NTZ, expected_date TIMESTAMP_NTZ"
        ),
        "invoice_line": spark.createDataFrame([(10, 1), (11, 1), (12, 1)], "invoice_no INT, ks INT"),
        "modification": spark.createDataFrame([("m", 5, 1, 1, None)], "mod_id STRING, dev_id INT, version_num INT, ks INT, mod_delivery_time STRING"),
        "device": spark.createDataFrame([(5, 1, "d", "3 weeks", datetime(2024, 1, 1))], "dev_id INT, version_num INT, dev_name STRING, timedelivery STRING, ie_xml_id_dt TIMESTAMP_NTZ"),
        "availability": spark.createDataFrame([(1, 7.0)], "ks INT, available_qty DOUBLE"),
    }

    def tables():
        if len(calls) == 1:  # a stock file arrives between two micro-batches
            spark.createDataFrame([(1, 2, 4.0)], stock).write.mode("append").parquet(folder)
        calls.append(1)
        return fixed | {"stock_qty": spark.read.schema(stock).parquet(folder)}

    ddl = "op STRING, seq LONG, before STRUCT<invoice_no: INT>, after STRUCT<invoice_no: INT>"
    stream = feed(spark, tmp_path / "in", ddl, [("I", 1, None, (10,))], [("I", 2, None, (11,))], [("I", 3, None, (12,))])
    query = recompute.stream_recompute(recompute.tagged(stream, "payment"), tables, f"{tmp_path}/out", f"{tmp_path}/checkpoint", catch_up=True)
    query.awaitTermination()
    assert query.exception() is None and len(calls) == 3
    read = spark.read.parquet
    # The second batch sees the new file, the third one what the second wrote.
    assert rows(read(f"{tmp_path}/out/status"), "batch", "ks", "cur", "clc") == [(0, 1, 0, 0), (1, 1, 0, 2), (2, 1, 2, 2)]
    assert rows(read(f"{tmp_path}/out/changes"), "batch", "ks", "mod_id", "stock_status_old", "stock_status_new") == [(1, 1, "m", 0, 2)]
    assert len(list((tmp_path / "out" / "affected").iterdir())) <= 2


def test_notifications_by_route(spark, tmp_path):
    notes = feed(spark, tmp_path / "in", "seq INT, channel STRING, payload STRING", [(1, "do_export", "5"), (2, "nobody", "5")], [(3, "do_expected", "m^e^6")])
    query = notify.stream_notifications(notes, f"{tmp_path}/out", f"{tmp_path}/checkpoint", catch_up=True)
    query.awaitTermination()
    assert query.exception() is None
    found = spark.read.parquet(f"{tmp_path}/out")
    assert rows(found, "seq", "route", "target_id", "mod_id") == [(1, "do_export", 5, None), (2, "rejected", None, None), (3, "do_expected", 6, "m")]


def test_affected_keys_cover_what_changed(spark):
    """Items whose status a payment, a reserve or an order line moved are among the keys."""
    d = domain(spark, SMALL)
    tables = _tables(d, "invoice_line")
    before = propagate.recompute_status(tables["content"], tables, excluded_suppliers=SUPPLIERS).select("ks", F.col("clc").alias("was"))
    gone = d.payment.where(F.col("invoice_no") % 3 == 0)
    after = propagate.recompute_status(
        tables["content"], tables | {"payment": d.payment.where(F.col("invoice_no") % 3 != 0)}, excluded_suppliers=SUPPLIERS
    )
    moved = after.join(before, "ks").where("clc <> was").select("ks")
    feed_rows = gone.select(
        F.lit("D").alias("op"), F.struct("invoice_no").alias("before"), F.when(F.lit(False), F.struct("invoice_no")).alias("after")
    )
    keys = recompute.affected_items(recompute.tagged(feed_rows, "payment"), tables)
    assert moved.count() > 0
    assert moved.join(keys, "ks", "left_anti").count() == 0


class Lists:
    """State lists and timers of one bucket, with the calls made of them."""

    def __init__(self):
        self.calls, self.lists, self.timers = 0, {}, set()

    def getListState(self, name, _):
        handle = self

        class Kept:
            def get(self):
                handle.calls += 1
                return iter(handle.lists.get(name, []))

            def put(self, rows):
                handle.calls += 1
                handle.lists[name] = rows

            def clear(self):
                handle.lists.pop(name, None)
                handle.calls += 1

        return Kept()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class At:
    def __init__(self, at):
        self.getCurrentProcessingTimeInMs = self.getExpiryTimeInMs = lambda: at


def attempted(*attempts):
    return iter([pd.DataFrame(attempts, columns=["id", "seq", "retry_cnt", "ok", "transient"])])


def told(found):
    return [r for part in found for r in part.itertuples(index=False, name=None)]


def test_retry_state_is_called_by_bucket_not_by_change():
    retry, handle = stateful.Retry(3, 0), Lists()
    retry.init(handle)
    for seq in (1, 2):
        found = told(retry.handleInputRows((0,), attempted(*[(i, seq, 0, i % 2 == 0, True) for i in range(1000)]), At(0)))
        assert len(found) == 1500 and {r[3] for r in found if r[0] % 2} == {seq} and handle.calls <= 2 * seq
    assert handle.lists["open"] == [(i, 2) for i in range(1, 1000, 2)]


def test_retry_timers_of_a_bucket_stand_for_all_of_its_changes():
    retry, handle = stateful.Retry(3, 50), Lists()
    retry.init(handle)
    told(retry.handleInputRows((0,), attempted((7, 1, 0, False, True), (7, 2, 0, False, True), (8, 1, 0, False, True)), At(100)))
    told(retry.handleInputRows((0,), attempted((9, 1, 0, False, True)), At(200)))
    assert handle.timers == {150, 250}
    told(retry.handleInputRows((0,), attempted((9, 2, 0, True, False), (8, 2, 0, False, False)), At(210)))
    assert handle.timers == {150}
    assert told(retry.handleExpiredTimer((0,), None, At(150))) == [(7, "resend", 7, 2, True)] * 2
    assert told(retry.handleExpiredTimer((0,), None, At(250))) == []
    assert handle.lists == {"open": [(7, 2)]}
