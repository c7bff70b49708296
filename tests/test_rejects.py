"""Values that do not fit: told, not lost."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import types as T

from shelfline.operators import export, migrate
from shelfline.sources.tables import from_source, from_source_rejects
from shelfline.streaming.stateful import unnamed_attempts
from tests.helpers import rows


def test_source_values_that_do_not_fit(frame):
    raw = frame("`КодСодержания` STRING, `Цена` STRING, stock_status LONG", ("3000000000", "2.5", 0), ("x", "free", 1), (None, None, 3_000_000_000))
    assert rows(from_source(raw, "content"), "ks", "stock_status") == sorted([(3_000_000_000, 0), (None, 1), (None, None)], key=repr)
    found = rows(from_source_rejects(raw, "content"))
    assert found == sorted([("x", "ks", "x"), ("x", "price", "free"), ("NULL", "stock_status", "3000000000")], key=repr)
    with pytest.raises(ValueError, match="КодСодержания"):
        from_source(raw.drop("КодСодержания"), "content")


def test_wide_rows_and_their_rejects_in_one_pass(spark, frame):
    fields = [(1, 1, 4, "price", "12"), (2, 1, 4, "n", "7"), (3, 1, 4, "price", "x"), (4, 1, 4, "n", "1.5"), (5, 1, 4, "price", " "), (6, 1, 4, "n", None)]
    chunked = export.chunk_records(frame("csv_id LONG, exp_id LONG, mod_csv INT, bx_fld_name STRING, bx_fld_value STRING", *fields))
    dictionary = [export.Field("price", T.StringType(), True), export.Field("n", T.IntegerType(), False)]
    seen = Observation("wide")
    judged = export.judged_wide(chunked, dictionary, seen)
    assert rows(export.to_wide(chunked, dictionary), "rec", "price", "n") == [(0, "12", 7), (1, None, None), (2, None, None)]
    assert rows(export.to_wide_rejects(judged), "rec", "field", "value") == [(1, "n", "1.5"), (1, "price", "x")]
    assert seen.get == {"records": 3, "rejects": 2}


def test_group_keys_of_marks_in_values(frame):
    params = "dev_id INT, version_num INT, mod_id STRING, dev_param_id INT, param_value STRING"
    rows_ = [(1, 1, "old", 1, "x;2=y"), (1, 1, "old", 2, "z"), (1, 2, "new", 1, "x"), (1, 2, "new", 2, "y;2=z"), (1, 1, "o2", 1, "a\\"), (1, 1, "o2", 2, "b"), (1, 2, "n2", 1, "a\\"), (1, 2, "n2", 2, "b")]
    found = {r.mod_id: (r.group_key, r.matched) for r in migrate.match_groups(frame(params, *rows_), 1, 2).collect()}
    assert not found["old"][1] and not found["new"][1] and found["old"][0] != found["new"][0]
    assert found["o2"] == found["n2"] and found["o2"][1]
    pairs = {(r.mod_id_from, r.mod_id_to) for r in migrate.match_versions(frame(params, *rows_), 1, 2).collect()}
    assert pairs == {("old", None), ("o2", "n2")}


def test_attempts_without_id_have_a_way_of_their_own(frame):
    attempts = frame("id LONG, seq LONG, retry_cnt LONG, error STRING", (1, 1, 0, None), (None, 2, 0, "x"))
    assert [r.seq for r in unnamed_attempts(attempts).collect()] == [2]
