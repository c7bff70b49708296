"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) say on what. Every query
runs twice; the second time counts, the first one (code generation, compilation) is shown as well.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests.session import local_session  # noqa: E402
from workloads.queries import QUERIES  # noqa: E402

HEADLINES = [
    "stock_status",
    "to_wide",
    "match_versions",
    "match_groups",
    "equals_last_sent",
    "compare_delivery_by_name",
    "compare_price",
    "recompute_status",
    "stock_change_records",
    "export_plan",
    "apply_export_outcome",
    "batch_prices",
    "carry_prices",
    "suppress_repeats",
    "log_with_changes",
    "check_constraints",
    "stream_recompute",
    "maintained_totals",
]


def run(spark, name: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, partitions=cpus)
    run(spark, "free_stock", folder)  # starts the engine
    first = {name: round(run(spark, name, folder), 3) for name in names}
    times = {name: round(run(spark, name, folder), 3) for name in names}
    line = {
        "metric": "headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": first,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
