"""State in buckets, totals kept up by changes, key indexes."""

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators import stock
from shelfline.plans.buckets import look_up, write_index
from shelfline.streaming.state import KeyedState
from shelfline.streaming.totals import COLUMNS, StockTotals
from tests.helpers import rows


def test_state_keeps_its_size_and_repeats_a_batch(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), "k LONG, v STRING", "k", buckets=4)
    frame = lambda *r: spark.createDataFrame(list(r), "k LONG, v STRING").coalesce(1)
    files, expected = [], {}

    def batch(n, *changed):
        new = frame(*changed)
        touched = state.buckets_of(new)
        known = state.before(n, touched)
        state.fold(n, known, touched, new)
        return dict(map(tuple, known.collect())) | dict(changed)

    for n in range(14):
        changed = [(k, f"{k} in {n}") for k in {n % 5, (n + 3) % 7}]
        expected |= dict(changed)
        batch(n, *changed)
        files.append(len(spark.read.parquet(str(tmp_path / "s")).inputFiles()))
    everything = state.before(99, range(4))
    assert dict(map(tuple, everything.collect())) == expected and everything.count() == len(expected)
    assert max(files[10:]) <= max(files[:10]) <= 8 * 4
    # The last batch again, with another result: what was there before it is found again.
    batch(13, (13 % 5, "anew"))
    again = dict(map(tuple, state.before(99, range(4)).collect()))
    assert again[13 % 5] == "anew" and len(again) == len(expected)


def test_state_reads_touched_buckets_only(spark, tmp_path):
    state = KeyedState(spark, str(tmp_path / "s"), "k LONG, v STRING", "k", buckets=16)
    all_rows = spark.range(200).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    state.write(0, list(range(16)), all_rows)
    few = state.buckets_of(spark.createDataFrame([(3,), (None,)], "k LONG"))
    assert len(few) <= 2
    found = state.before(1, few)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", found._jdf.queryExecution().toString())
    assert 0 < found.count() < 60 and 3 in {r.k for r in found.collect()}


def test_index_reads_the_keys_buckets(spark, tmp_path):
    lines = spark.range(2000).select((F.col("id") % 300).cast("int").alias("invoice_no"), F.col("id").alias("ks"))
    write_index(lines.unionByName(lines.limit(10)), str(tmp_path / "i"), "invoice_no", buckets=32)
    keys = spark.createDataFrame([(7,), (8,), (None,), (7,)], "invoice_no INT")
    found = look_up(spark, str(tmp_path / "i"), T.StructType.fromDDL("invoice_no LONG, ks LONG"), keys, "invoice_no", buckets=32)
    assert rows(found) == sorted(((i % 300, i) for i in range(2000) if i % 300 in (7, 8)), key=repr)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", found._jdf.queryExecution().toString())
    assert look_up(spark, str(tmp_path / "i"), T.StructType.fromDDL("invoice_no LONG, ks LONG"), keys.limit(0), "invoice_no", buckets=32).count() == 0


def movement(rng, table, now):
    """A random row; order numbers are unique."""
    day = lambda: None if rng.random() < 0.4 else datetime(2024, 1, 1) + timedelta(days=rng.randrange(5))
    flag = lambda: rng.choice([None, False, False, True])
    ks, gate, qty = rng.choice([None, *range(6)]), rng.choice([None, *range(8)]), float(rng.randrange(-3, 6))
    return {
        "stock_qty": lambda: (ks, rng.randrange(12), qty), "reserve": lambda: (ks, gate, qty, rng.randrange(3), day()),
        "incoming_reserve": lambda: (ks, gate, qty, day()), "payment": lambda: (gate, Decimal(rng.randrange(-2, 4))),
        "purchase_order": lambda: (rng.choice([g for g in range(60) if g not in {r[0] for r in now["purchase_order"]}]), rng.randrange(5), flag(), flag()),
        "purchase_order_line": lambda: (rng.choice([None, *range(40)]), ks, qty, flag(), flag(), rng.choice([None, None, 1]), rng.choice([None, None, datetime(2024, 2, 1)]), day()),
    }[table]()


@pytest.mark.parametrize("seed", [1, 2])
def test_totals_follow_inserts_moves_and_deletes(spark, tmp_path, seed):
    rng, now = random.Random(seed), {t: [] for t in COLUMNS}
    rules = dict(excluded_suppliers=(3,), excluded_warehouses=(5,), closed_status=2)
    for t in COLUMNS:
        for _ in range(25):
            now[t].append(movement(rng, t, now))
    frame = lambda t: spark.createDataFrame(now[t], COLUMNS[t])
    totals = StockTotals(spark, str(tmp_path / "t"), buckets=2, **rules)
    totals.fill({t: frame(t) for t in COLUMNS})
    kept = {}
    for batch in range(3):
        changes = {}
        for t in COLUMNS if batch else ("payment", "purchase_order"):
            made = []
            for _ in range(6):
                op = rng.choice("IUD")
                before = now[t].pop(rng.randrange(len(now[t]))) if op != "I" else None
                after = movement(rng, t, now) if op != "D" else None
                now[t] += [after] if after is not None else []
                made.append((op, before, after))
            changes[t] = spark.createDataFrame(made, f"op STRING, before STRUCT<{COLUMNS[t].replace(' ', ': ').replace(',: ', ', ')}>, after STRUCT<{COLUMNS[t].replace(' ', ': ').replace(',: ', ', ')}>")
        found = totals.apply(batch, changes)
        if batch == 1:  # the batch again gives the same
            first = rows(found)
            found = totals.apply(batch, changes)
            assert rows(found) == first
        touched = {r.ks: r for r in found.collect()}
        kept |= touched
        want = stock.stock_totals(*[frame(t) for t in COLUMNS], **rules).where("ks IS NOT NULL").collect()
        state = {r.ks: r for r in totals.totals.before(99, range(2)).collect()}
        for r in want:
            assert (state[r.ks].on_hand, state[r.ks].on_order) == (r.on_hand, r.on_order), (batch, r)
            if r.ks in kept and r.ks in touched:
                assert kept[r.ks].expected_date == r.expected_date
        assert all(not (s.on_hand or s.on_order) for k, s in state.items() if k not in {r.ks for r in want})
