"""What the plans look like and how hot keys are handled."""

import random

import pytest

from shelfline.operators import changes, lookups, migrate, propagate, stock
from tests.conftest import SMALL
from tests.helpers import rows
from workloads.queries import QUERIES

STREAMS = {n for n in QUERIES if n.startswith("stream_")}


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_plan_is_distributed(spark, name):
    plan = initial_plan(QUERIES[name](spark, SMALL))
    assert "Python" not in plan and "InPandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = initial_plan(QUERIES["paid_reserves"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_linenumber), EqualTo(l_returnflag,A)" in plan
    assert "l_extendedprice" not in plan


def scans(plan: str) -> int:
    return plan.count("FileScan parquet")


def test_one_pass_where_one_is_enough(spark):
    plans = {n: initial_plan(QUERIES[n](spark, SMALL)) for n in ("to_wide", "check_constraints", "route_notifications", "sync_report")}
    assert "SortAggregate" not in plans["to_wide"]
    # Three tables with one pass for rules on rows, one for uniqueness, one for each foreign key.
    assert scans(plans["check_constraints"]) <= 9
    assert scans(plans["route_notifications"]) == 1
    assert scans(plans["sync_report"]) <= 16


def test_ranking_and_totals_combine_before_the_shuffle(spark):
    status = initial_plan(QUERIES["stock_status"](spark, SMALL))
    assert "partial_sum" in status and status.count("Exchange hashpartitioning(ks") <= 2
    assert "partial_max_by" in initial_plan(QUERIES["last_sent"](spark, SMALL))


def test_slices_share_one_shuffle(spark):
    df = QUERIES["suppress_repeats"](spark, SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 2 and "ReusedExchange" in final


def hot_log(spark, n=3000):
    """Changes of which most belong to one modification."""
    random.seed(7)
    source = [(i * 3, "hot" if random.random() < 0.7 else f"m{i % 50}", random.choice(["t", "t", "u", None]), random.choice([1, 1, 2])) for i in range(n)]
    return source, spark.createDataFrame(source, "id INT, mod_id STRING, time_delivery STRING, qnt INT")


def folded(source):
    last, result = {}, []
    for id_, mod, term, qnt in sorted(source):
        before = last.get(mod)
        same = before is not None and None not in (term, qnt, before[0]) and before[:2] == (term, qnt)
        held = before[2] + 1 if same else 0
        last[mod] = (term, qnt, held)
        result.append((id_, mod, term, qnt, not same, held))
    return sorted(result, key=repr)


def test_suppression_of_a_hot_key(spark):
    source, df = hot_log(spark)
    for bits in (2, 7, 16):
        assert rows(changes.suppress_repeats(df, slice_bits=bits)) == folded(source)


@pytest.fixture
def tiny_skew(spark):
    """Thresholds at which a few thousand rows count as a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8192",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


N = 30000


def hot(spark, ddl, row):
    """Rows whose key is the same for two of three."""
    return spark.createDataFrame([row(i, 1 if i % 3 else i) for i in range(N)], ddl).repartition(8)


def reserves(spark):
    return hot(spark, "ks INT, invoice_no INT, reserved_qty DOUBLE, reserve_status INT, released_at TIMESTAMP_NTZ", lambda i, k: (i % 997, k, 1.0, 0, None))


def log_rows(spark):
    ddl = "id INT, mod_id STRING, change_status INT, dt_sent TIMESTAMP_NTZ, time_delivery STRING, qnt INT, ks INT, dbl_cnt INT"
    return hot(spark, ddl, lambda i, k: (i, str(k), 0 if i % 2 else 1, None, "t", i % 5, k, 0))


def payments(spark):
    return spark.createDataFrame([(i, 1.0 if i % 2 else -1.0) for i in range(N)], "invoice_no INT, amount DOUBLE")


def every_invoice_paid_anew(spark):
    row = "STRUCT<invoice_no: INT>"
    return spark.createDataFrame([("I", None, (i,)) for i in range(N)], f"op STRING, before {row}, after {row}")


def mods(spark):
    return spark.createDataFrame([(str(i), 1, i) for i in range(N)], "mod_id STRING, version_num INT, ks INT")


def agreeing(spark):
    """Two of three devices' modifications sit on one device."""
    ddl = "dev_id INT, version_num INT, mod_id STRING, dev_param_id INT, param_value STRING"
    rows = [(1 if i % 3 else i, v, f"{v}-{i:05d}", 1, "same") for i in range(N // 2) for v in (1, 2)]
    return spark.createDataFrame(rows, ddl).repartition(8)


# Name, result, and its size computed by hand.
HOT = {
    "paid_reserves": (lambda s: stock.paid_reserves(reserves(s), payments(s)), sum(1 for i in range(N) if (1 if i % 3 else i) % 2)),
    "equals_last_sent": (lambda s: changes.equals_last_sent(log_rows(s).drop("ks"), log_rows(s)), N),
    "supersede_pending": (lambda s: changes.supersede_pending(log_rows(s)), N),
    "attach_mod_id": (lambda s: lookups.attach_mod_id(log_rows(s).drop("mod_id"), mods(s)), N),
    "attach_item_code": (lambda s: lookups.attach_item_code(log_rows(s).drop("ks"), mods(s)), N),
    "affected_by_payments": (lambda s: propagate.affected_by_payments(every_invoice_paid_anew(s), reserves(s).select("ks", "invoice_no")), 997),
    "winning_matches": (lambda s: migrate.winning_matches(agreeing(s), 1, 2), N // 2),
}


@pytest.mark.parametrize("name", HOT)
def test_hot_key_is_split(spark, tiny_skew, name):
    build, size = HOT[name]
    result = build(spark)
    assert len(result.collect()) == size
    assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()


def test_big_tables_are_not_broadcast(spark, tiny_skew):
    for name in ("stock_status", "compare_price", "match_versions", "equals_last_sent", "export_wide_prices"):
        assert "Broadcast" not in initial_plan(QUERIES[name](spark, SMALL))


def test_equal_modifications_are_not_paired_out(spark):
    """A device whose modifications all agree: the carry-over needs no pairs of them."""
    n = 3000
    params = [(1, v, f"{v}-{i:05d}", 1, "same") for v in (1, 2) for i in range(n)]
    df = spark.createDataFrame(params, "dev_id INT, version_num INT, mod_id STRING, dev_param_id INT, param_value STRING")
    winners = migrate.winning_matches(df, 1, 2)
    assert winners.count() == n
    assert {r.mod_id_from for r in winners.select("mod_id_from").distinct().collect()} == {f"1-{n - 1:05d}"}


#: Queries whose joins have two sides that grow: small files tell nothing about them.
GROWING = ("match_groups", "winning_matches", "match_versions", "carry_prices", "unfinished_exports", "apply_export_outcome_devices")


@pytest.mark.parametrize("name", GROWING)
def test_growing_sides_are_not_broadcast_by_a_guess(spark, name):
    assert "Broadcast" not in initial_plan(QUERIES[name](spark, SMALL))
