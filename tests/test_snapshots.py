"""Changes from snapshots, log reports without pairs, exports that wait for answers."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.operators import outcomes, propagate, reports
from shelfline.sources import change_feed, snapshots
from shelfline.streaming import stages, stateful
from tests.helpers import rows
from tests.test_streams import drained, feed

ROW = "id LONG, a STRING, b STRING, x DOUBLE, n STRUCT<p: INT, q: INT>"


def changes_of(found):
    return sorted((r.op, tuple(r.before) if r.before else None, tuple(r.after) if r.after else None) for r in found.collect())


def test_row_changes(frame):
    nan = float("nan")
    old = frame(ROW, (1, "s", None, 1.0, (1, None)), (2, "s", None, 1.0, None), (3, "v", "w", 0.0, None), (4, "s", "t", nan, (None, 2)),
                (5, None, None, None, None), (6, "s", "t", 1.0, (1, None)), (None, "s", None, 1.0, None))
    new = frame(ROW, (1, "s", None, 1.0, (1, None)), (2, None, "s", 1.0, None), (3, "v", "w", -0.0, None), (4, "s", "t", nan, (None, 2)),
                (7, None, None, None, None), (6, "s", "t", 1.0, (None, 1)), (None, "changed", None, 1.0, None))
    found = snapshots.row_changes(old, new.select("x", "n", "b", "a", "id"), "id", seq=4)
    # A value that moved to the next column is a change, within a struct too; -0.0, NaN and NULL are none.
    assert changes_of(found) == sorted([
        ("D", (5, None, None, None, None), None), ("I", None, (7, None, None, None, None)),
        ("U", (2, "s", None, 1.0, None), (2, None, "s", 1.0, None)), ("U", (6, "s", "t", 1.0, (1, None)), (6, "s", "t", 1.0, (None, 1))),
    ], key=lambda r: (r[0], r[1] or (), r[2] or ()))
    assert {r.seq for r in found.collect()} == {4}
    rejects = rows(snapshots.snapshot_rejects(old, new, "id"))
    assert rejects == [(None, 1, 1, "no key")]


def test_row_changes_against_a_join(spark):
    old = spark.range(4000).select("id", (F.col("id") % 7).alias("v"), F.lit("same").alias("before"))
    new = spark.range(1000, 5000).select("id", F.when(F.col("id") % 11 == 0, -1).otherwise(F.col("id") % 7).alias("v"), F.lit("same").alias("before"))
    found = snapshots.row_changes(old, new, "id", 1)
    assert dict(rows(found.groupBy("op").count())) == {"I": 1000, "D": 1000, "U": len([n for n in range(1000, 4000) if n % 11 == 0])}
    # Keys that a snapshot holds twice are reported and give no change.
    twice = new.unionByName(new.where("id < 1010"))
    assert found.where("after.id < 1010").count() > 0
    assert snapshots.row_changes(old, twice, "id", 1).where("coalesce(after.id, before.id) BETWEEN 1000 AND 1009").count() == 0
    assert rows(snapshots.snapshot_rejects(old, twice, "id")) == [(n, 1, 2, "repeated key") for n in range(1000, 1010)]
    empty = new.where("false")
    assert snapshots.row_changes(empty, empty, "id", 1).count() == 0
    assert snapshots.row_changes(empty, new, ["id", "v"], 1).where("op = 'I'").count() == 4000


def test_row_changes_move_whole_rows_of_changed_keys_only(spark, tmp_path):
    wide = spark.range(3000).select("id", F.repeat(F.lit("text"), 50).alias("wide"))
    wide.write.parquet(str(tmp_path / "old"))
    wide.withColumn("wide", F.when(F.col("id") == 5, "new").otherwise(F.col("wide"))).write.parquet(str(tmp_path / "new"))
    found = snapshots.row_changes(spark.read.parquet(str(tmp_path / "old")), spark.read.parquet(str(tmp_path / "new")), "id", 1)
    assert [r.after.wide for r in found.collect()] == ["new"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in final and "BroadcastHashJoin" in final and "CartesianProduct" not in final


def test_different_columns_are_refused(frame):
    with pytest.raises(ValueError, match="differ in columns"):
        snapshots.row_changes(frame("id LONG, a STRING"), frame("id LONG, a INT"), "id", 1)


def test_snapshots_feed_a_stream_and_the_operators(spark, frame, tmp_path):
    ddl = "payment_id LONG, invoice_no LONG, amount DECIMAL(18,2)"
    old, new = frame(ddl, (1, 10, None), (2, 20, None), (3, 30, None)), frame(ddl, (1, 10, None), (2, 21, None), (4, 40, None))
    lines = frame("invoice_no LONG, ks LONG", *[(n, n * 100) for n in (10, 20, 21, 30, 40)])
    snapshots.row_changes(old, new, "payment_id", 9).write.parquet(str(tmp_path / "feed"))
    stream = change_feed.read_changes(spark, str(tmp_path / "feed"), old.schema)
    arrived = drained(stream, tmp_path)
    assert rows(propagate.affected_by_payments(arrived, lines)) == [(2000,), (2100,), (3000,), (4000,)]


LOG = "id LONG, descript STRING, operation STRING, dt TIMESTAMP_NTZ, num STRING"
CHANGE = "id LONG, ks LONG, dt_change TIMESTAMP_NTZ, position STRING"


def test_log_reports_without_pairs(spark, frame):
    t = datetime(2024, 1, 1)
    log = frame(LOG, (1, "a TX", "o", t, "7"), (2, "b TX", "o", t, "7"), (3, "c", "o", t, "7"), (4, "TX", "o", t, "x"), (5, "TX", "o", t, "8"), (6, "TX", "o", t, None))
    changes = frame(CHANGE, (10, 7, t, "p"), (11, 7, None, "q"), (12, 7, t, "r"), (13, 9, t, "s"), (14, None, t, "t"))
    groups = rows(reports.log_groups(log, changes, "%TX%", slice_bits=2))
    assert groups == [(7, "change", 10, 2, 2, 3), (7, "change", 11, 2, 2, 3), (7, "change", 12, 3, 2, 3), (7, "log", 1, 0, 2, 3), (7, "log", 2, 0, 2, 3)]
    shown = reports.log_with_newest_changes(log, changes, "%TX%", newest=2)
    assert shown.columns == ["log_id", "descript", "operation", "log_dt", "position", "id", "ks", "dt_change", "position"]
    assert sorted((r[0], r[4], r[5]) for r in shown.collect()) == [(1, 1, 12), (1, 2, 10), (2, 1, 12), (2, 2, 10)]
    everything = reports.log_with_newest_changes(log, changes, "%TX%", newest=9)
    pairs = reports.log_with_changes(log, changes.drop("position"), "%TX%")
    assert everything.count() == pairs.count() == 6
    assert sorted(r[5] for r in everything.where("log_id = 1").collect()) == [10, 11, 12]


def test_hot_item_in_the_log(spark):
    log = spark.range(300).select("id", F.lit("TX").alias("descript"), F.lit("o").alias("operation"), F.lit(None).cast("timestamp_ntz").alias("dt"), F.lit("1").alias("num"))
    changes = spark.range(40000).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(1).alias("ks"), F.lit(None).cast("timestamp_ntz").alias("dt_change"))
    groups = reports.log_groups(log, changes, "TX")
    assert groups.count() == 300 + changes.where("ks = 1").count()
    shown = reports.log_with_newest_changes(log, changes, "TX", newest=4)
    assert shown.count() == 1200 and {r.id for r in shown.where("position = 1").collect()} == {39999}
    # The first four of an item are taken before rows are shuffled.
    assert shown._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


EXPORT = ("exp_id LONG, dev_id LONG, exp_version_num INT, exp_mod INT, exp_csv_status INT, exp_dt TIMESTAMP_NTZ, exp_creator INT, exp_site STRING")
DEVICE = "dev_id LONG, version_num INT, dev_name STRING, ie_xml_id LONG, ip_prop674 LONG, ip_prop675 LONG"
EVENT = "exp_id LONG, at TIMESTAMP, stage INT, planned INT, failed BOOLEAN"


def test_unfinished_exports(frame):
    t = datetime(2024, 1, 1)
    log = frame(EXPORT, *[(n, 1, 1, m, None, d, 5, "s") for n, m, d in (
        (1, 7, t), (2, 7, t + timedelta(days=3)), (3, 2, t), (4, 2, t), (5, None, t), (6, 6, None), (7, 0, t))])
    device = frame(DEVICE, (1, 1, "d", 1, 1, 1))
    answers = frame("exp_id LONG, stage INT, returned_text STRING, error STRING",
                    (1, 2, "1", None), (1, 4, "1", None), (3, 2, "1", None), (4, 2, "1", "broken"), (4, 4, "1", None), (99, 2, "1", None))
    found = outcomes.unfinished_exports(answers, log, device, "2024-01-02 00:00:00")
    # 3 finished, 4 failed, 5 and 7 plan nothing; 2 and 6 have no answer at all, and of 6 no start is known.
    assert rows(found, "exp_id", "answered", "missing", "expired") == [(1, 6, 1, True), (2, 0, 7, False), (6, 0, 6, False)]


def test_stage_stream(spark, tmp_path):
    stateful.use_rocksdb(spark)
    t = datetime(2024, 1, 1)
    at = lambda minutes: t + timedelta(minutes=minutes)
    batches = [
        [(n, at(0), 0, 7 if n < 4 else 2, None) for n in (1, 2, 3, 4, 5)] + [(8, at(0), 2, None, False), (None, at(0), 2, None, False), (9, None, 0, 7, None)],
        [(1, at(5), 2, None, False), (1, at(5), 2, None, False), (2, at(5), 2, None, False), (3, at(5), 4, None, True), (4, at(6), 4, None, False)],
        [(1, at(10), 4, None, False), (1, at(10), 1, None, False), (4, at(10), 2, None, False), (6, at(10), 1, None, False), (6, at(11), 0, 1, None)],
        [(100, at(500), 0, 1, None)],
        [(101, at(501), 0, 1, None)],
    ]
    events = feed(spark, tmp_path / "in", EVENT, *batches)
    found = rows(drained(stages.stream_stages(events, patience_ms=60 * 60 * 1000, delay="30 minutes"), tmp_path))
    # Unplanned stages do not count, repeated answers once; 5 has no answer at all, 8 no start, 100 still waits.
    assert found == sorted([
        (1, "finished", 7, 0), (2, "expired", 2, 5), (3, "failed", 4, 3), (4, "finished", 2, 0), (5, "expired", 0, 2), (6, "finished", 1, 0), (8, "unplanned", 2, 0),
    ], key=repr)
