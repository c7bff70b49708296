"""Run registered queries in Spark and their SQL in DuckDB and compare whole results.

    python tools/check_oracles.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pyarrow as pa  # noqa: E402

from tests.session import local_session  # noqa: E402
from workloads.oracles import oracles  # noqa: E402
from workloads.queries import QUERIES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr) if columns else []


def plain(data_type: pa.DataType) -> str:
    text = str(data_type)
    return {"large_string": "string", "timestamp[us]": "timestamp"}.get(text, text)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    sql, bad = oracles(), 0
    for name in args.names or QUERIES:
        begin = time.time()
        try:
            got = QUERIES[name](spark, folder).toArrow()
            spent = time.time() - begin
            if name not in sql:
                print(f"{name:32s} {got.num_rows:8d} rows {spent:6.2f}s  no SQL", flush=True)
                continue
            want = con.execute(sql[name]).to_arrow_table()
            sql_spent = time.time() - begin - spent
            if sorted(got.column_names) != sorted(want.column_names):
                verdict = f"COLUMNS {sorted(got.column_names)} {sorted(want.column_names)}"
            else:
                types = [(n, plain(got.schema.field(n).type), plain(want.schema.field(n).type)) for n in got.column_names]
                odd = [t for t in types if t[1] != t[2]]
                a, b = rows(got), rows(want)
                verdict = "ok" if a == b else f"VALUES {got.num_rows} {want.num_rows} " + str(
                    [x for x in a if x not in set(b)][:2] + ["<>"] + [x for x in b if x not in set(a)][:2]
                )
                if odd:
                    verdict += f" TYPES {odd}"
            bad += verdict != "ok"
            print(f"{name:32s} {got.num_rows:8d} rows {spent:6.2f}s sql {sql_spent:6.2f}s  {verdict}", flush=True)
        except Exception as e:  # report and go on with the next query
            bad += 1
            print(f"{name:32s} FAILED {type(e).__name__} {str(e)[:600]}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
