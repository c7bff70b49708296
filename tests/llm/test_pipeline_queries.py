"""The pipeline stage by stage, and every query over the small tables."""

import duckdb
import pytest

import corpus_pipeline
from shelfline.llm.queries import QUERIES
from shelfline.llm.sql import SQL
from tests.llm.helpers import components, shingle_set


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(SQL) <= set(QUERIES)
    import __spark_entry__ as contract

    assert {*QUERIES, "pipeline"} <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    got = QUERIES[name](spark, small).toArrow()
    want = con.sql(SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    rows = [sorted(map(repr, t.select(sorted(t.column_names)).to_pylist())) for t in (got, want)]
    assert rows[0] == rows[1] and got.num_rows


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before, held = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, small)
        assert after.columns == docs.columns
        held[name] = after.collect()
        before = spark.createDataFrame(held[name], docs.schema)
    good, lined, single, mixed = held.values()
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    assert all((i in kept) == (q == 1) for i, q in quality.items())
    assert {r.doc_id for r in lined} == kept
    sets = {r.doc_id: shingle_set(r.text) for r in lined}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    groups = components(sets, links)
    assert {r.doc_id for r in single} == {d for d, g in groups.items() if d == g}
    copies = {}
    for r in mixed:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert set(copies) <= {r.doc_id for r in single} and max(copies.values()) == 2
    packed = corpus_pipeline.STAGES[-1][1](spark, before, small).toPandas()
    assert packed[packed.piece == 0].groupby("doc_id").size().to_dict() == copies
    assert (packed.groupby("sequence_id").length.sum() <= 1024).all()


def test_odd_tables_pass_every_stage(spark, small, tmp_path):
    more = (1, 2, 3, 4, "x", "y", 7)
    docs = spark.createDataFrame(
        [(1, None, None, None, None, *more), (1, None, None, None, None, *more), (None, "a b c d e f", "en", "s", 3, *more), (2, "", "en", "s", 0, *more), (3, "x" * 90_000, "en", None, 9, *more)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "_lookup int, _copies int, dropped int, _dropped int, copy string, component_id string, label int",
    )
    for table in (docs, docs.limit(0)):
        at = table
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, at, small)
            assert name == "packing" or rows.columns == docs.columns
            at = spark.createDataFrame(rows.collect(), rows.schema)
        assert (at.count() > 0) == (not table.isEmpty())
