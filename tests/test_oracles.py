"""Every registered query against its independent SQL, whole results."""

import duckdb
import pytest

from tests.conftest import SMALL
from tools.check_oracles import TABLES, plain
from tools.check_oracles import rows as table_rows
from workloads.oracles import SQL, oracles
from workloads.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SMALL).toArrow()
    want = con.sql(oracles()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    types = {n: (plain(got.schema.field(n).type), plain(want.schema.field(n).type)) for n in got.column_names}
    assert {n: t for n, t in types.items() if t[0] != t[1]} == {}
    assert got.num_rows > 0
    assert table_rows(got) == table_rows(want)


def test_entry(spark):
    import __spark_entry__ as contract

    counts = {r.clc: r["count"] for r in contract.entry(spark).groupBy("clc").count().collect()}
    assert counts == {0: 68, 1: 120, 2: 12}
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert set(QUERIES) <= contract.oracle_sql().keys()
