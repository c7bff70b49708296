"""Hand-made inputs for exports, outcomes, files and constraints."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators import export, outcomes, quality
from shelfline.sources.caret_csv import read_caret_csv, write_caret_csv
from tests.helpers import by_key, rows

FIELDS = "csv_id INT, exp_id INT, mod_csv INT, bx_fld_name STRING, bx_fld_value STRING"
DEVICE = (
    "dev_id INT, version_num INT, dev_name STRING, ie_xml_id INT, ip_prop674 INT, ip_prop675 INT, "
    "ie_xml_id_dt TIMESTAMP_NTZ, ip_prop674_dt TIMESTAMP_NTZ, ip_prop675_dt TIMESTAMP_NTZ"
)
LOG = "exp_id INT, exp_version_num INT, dev_id INT, exp_mod INT, exp_csv_status INT, exp_creator INT, exp_status INT, exp_site STRING, exp_batch_id INT"
NOW = "2024-02-01 00:00:00"
BEFORE = datetime(2024, 1, 1)


@pytest.fixture
def dictionary(frame):
    return export.read_dictionary(
        frame(
            "dict_name STRING, dict_order INT, data_type STRING",
            ("b", 2, "numeric"), ("a", 1, "character varying(20)"), ("C", 3, "integer"), ("d", 4, "numeric(10,3)"),
        )
    )


def test_dictionary(dictionary):
    assert [(f.column, f.data_type, f.number) for f in dictionary] == [
        ("a", T.StringType(), False), ("b", T.StringType(), True), ("c", T.IntegerType(), False), ("d", T.DecimalType(10, 3), False),
    ]


def test_to_wide(frame, dictionary):
    fields = frame(
        FIELDS,
        (10, 1, 4, "a", "x"), (12, 1, 4, "b", "12.345"), (13, 1, 4, "C", "7"),
        (14, 1, 4, "a", None), (15, 1, 4, "b", ""), (16, 1, 4, "C", "many"),
        (20, 1, 4, "b", "12345678901234567.5"),
        (11, 2, 4, "a", "y"), (30, 2, 4, "a", "z"),
        (40, 3, 1, "unknown", "?"), (41, 3, 1, "a", "k"),
        (50, None, 4, "a", "lost"), (60, 4, 4, None, "nameless"),
    )
    wide = export.to_wide(export.chunk_records(fields), dictionary)
    # Empty or wrong text in a typed column is NULL; the last record may be incomplete; an
    # unknown field takes its place in the record but has no column.
    assert rows(wide) == [
        (1, 4, 0, "x", "12.345", 7, None), (1, 4, 1, "", None, None, None), (1, 4, 2, None, "12345678901234567.5", None, None),
        (2, 4, 0, "y", None, None, None), (2, 4, 1, "z", None, None, None), (3, 1, 0, "k", None, None, None),
    ]


def test_to_wide_returns_its_input(frame, dictionary):
    source = [(i, i // 40, 4, "abCd"[i % 4], str(i)) for i in range(200)]
    typed = export.to_wide(export.chunk_records(frame(FIELDS, *source)), dictionary)
    back = typed.select("exp_id", F.expr("stack(4, 'a', a, 'b', cast(b AS string), 'C', cast(c AS string), 'd', cast(d AS string)) AS (name, value)"))
    values = {"d": "{}.000"}
    assert rows(back) == sorted(((e, n, values.get(n, "{}").format(v)) for _, e, _, n, v in source), key=repr)


def test_numbering_does_not_depend_on_slices(frame):
    # One export holds most rows; its ids are scattered and cross many slices.
    source = [(i * 7 % 1009, 1 if i % 5 else i, 4, "abc"[i % 3], str(i)) for i in range(1, 800)]
    fields = frame(FIELDS, *source)
    names, position, expected = {}, {}, []
    for csv_id, exp, mode, name, _ in source:
        names.setdefault(exp, set()).add(name)
    for csv_id, exp, mode, name, value in sorted(source):
        n = position[exp] = position.get(exp, -1) + 1
        expected.append((exp, mode, csv_id, name, value, n // len(names[exp])))
    for bits in (0, 3, 6, 16):
        assert rows(export.chunk_records(fields, slice_bits=bits)) == sorted(expected, key=repr)


def devices(frame):
    return frame(
        DEVICE,
        (1, 1, "It's", None, None, None, None, None, None), (2, 1, "Two", 20, 21, 22, BEFORE, BEFORE, BEFORE),
        (2, 2, "Two", 20, 21, 22, BEFORE, BEFORE, BEFORE), (3, 0, "Three", None, 31, None, None, None, None),
    )


def test_export_plan(frame):
    params = frame(
        "ie_param_name STRING, brand_new BOOLEAN, imp_mode INT, ie_param_value STRING",
        ("csv_file", True, 2, "new-mods.csv"), ("csv_file", False, 2, "mods.csv"), ("import_profile", True, 4, "30"),
    )
    log = frame(
        "exp_id INT, dev_id INT, exp_version_num INT, exp_mod INT",
        (1, 1, 1, 7), (2, 2, 1, 6), (3, 3, 0, 5), (4, 2, 1, 0), (5, 2, 1, 8), (6, 2, 1, 15), (7, 2, 1, None), (8, 9, 1, 7),
    )
    assert rows(export.export_plan(log, devices(frame), params)) == [
        (1, 0, 2, True, "new-mods.csv", None), (1, 1, 4, True, None, "30"), (1, 2, 1, True, None, None),
        (2, 0, 2, False, "mods.csv", None), (2, 1, 4, False, None, None),
        (3, 0, 4, False, None, None), (3, 1, 1, True, None, None),
        (6, 0, 2, False, "mods.csv", None), (6, 1, 4, False, None, None), (6, 2, 1, False, None, None),
    ]


def test_guard_export_changes(frame):
    changes = frame(
        "exp_id INT, before STRUCT<exp_mod: INT, exp_csv_status: INT, exp_site: STRING, exp_status: INT>, "
        "after STRUCT<exp_mod: INT, exp_status: INT, exp_version_num: INT, dev_id: INT>",
        (1, (7, 7, "prod", 1), (7, 1, 1, 2)), (2, (7, 7, "prod", 1), (7, 1, 2, 2)), (3, (7, 7, "prod", 2), (7, 1, 2, 2)),
        (4, (None, 7, "prod", 0), (7, 1, 1, 2)), (5, (7, 7, "dev", 2), (2, 1, 1, 2)), (6, (7, 7, "prod", 0), (4, 1, 1, 1)),
        (7, (7, 0, "prod", 0), (7, 1, 1, 1)), (8, (7, 0, "prod", 0), (7, 1, 1, 9)), (9, (7, 0, "prod", None), (7, 1, 1, 1)), (10, (7, 0, "prod", 0), (None, 1, 1, 2)),
    )
    assert by_key(export.guard_export_changes(changes, devices(frame), "prod"), "exp_id", "verdict", "starts_export") == {
        1: ("archive locked", False), 2: ("archiving allowed", False), 3: ("archive locked", False), 4: ("ok", True),
        5: ("mode not supported", False), 6: ("mode not supported", False), 7: ("ok", True), 8: ("no device", False), 9: ("ok", False),
        10: ("mode not supported", False),
    }


def test_validate_exports(frame):
    log = frame("exp_id INT, dev_id INT, exp_version_num INT, exp_site STRING", (1, 2, 2, "prod"), (2, 2, 2, "dev"), (3, 9, 1, "prod"), (4, 2, 1, "prod"), (5, 3, 0, "dev"))
    assert [r[1][:4] for r in rows(export.validate_exports(log, devices(frame), "prod", "dev"))] == ["prod", "deve", "no d", "ok", "ok"]


def test_guard_synced_fields(frame):
    row = "STRUCT<version_num: INT, ie_xml_id: INT, ie_xml_id_dt: STRING, ip_prop674: INT, ip_prop675: INT>"
    changes = frame(
        f"dev_id INT, before {row}, after {row}",
        (1, (0, 5, None, None, None), (0, 6, None, None, None)), (2, (1, None, None, None, None), (1, 6, None, None, None)),
        (3, (1, 5, None, None, None), (1, 5, "t", None, None)), (4, (1, 5, None, 7, None), (1, 5, None, None, None)),
    )
    assert rows(export.guard_synced_fields(changes)) == [
        (4, "Попытка обновить версию не 'в разработке' \nie_xml_id(OLD/NEW)=5/5\nie_xml_id_dt(OLD/NEW)=NULL/NULL"
            "\nip_prop674(OLD/NEW)=7/NULL\nip_prop675(OLD/NEW)=NULL/NULL"),
    ]


def test_export_outcome(frame):
    log = frame(
        LOG,
        (1, 1, 1, 7, None, 50, 1, "s", 1), (2, 1, 2, 6, 1, 51, 1, "s", 1), (3, 1, 1, 7, 9, 52, 1, "s", 1),
        (4, 1, 2, 4, 0, 53, 1, "s", 1), (5, 1, 2, 5, None, 54, 1, "s", 1), (6, 0, 3, 4, 2, 55, 1, "s", 1),
        (7, 2, 2, 7, 3, 56, 1, "s", 1), (8, 2, 2, 7, 0, 57, 1, "s", 1), (9, 2, 2, 6, None, 58, 1, "s", 1),
    )
    results = frame(
        "exp_id INT, stage INT, returned_text STRING, error STRING",
        (1, 2, "102", None), (1, 4, "104", ""), (1, 1, "101", None), (2, 2, "no id needed", None), (2, 4, "oops", None),
        (2, 1, "not planned", None), (3, 2, "302", None), (3, 4, "304", None), (3, 1, "301", None), (4, 4, "1", None),
        (5, 4, "no id needed", None), (5, 1, "9", None), (6, 4, "3", None),
        # A stage missing; one stage failing although the device is known; both.
        (7, 2, "no id needed", None), (8, 2, "ERROR: import failed", "import failed"), (8, 4, "1", None), (8, 1, "ERROR", None),
        (9, 4, None, "no route"),
    )
    outcome = outcomes.apply_export_outcome(results, log, devices(frame), NOW)
    assert by_key(outcome.exports, "exp_id", "ok", "exp_csv_status", "exp_result") == {
        1: (True, 7, "Завершён экспорт модели 'It''s' на сайт s (exp_id=1)"),
        2: (False, 1, "stage 4 result=[oops]"),
        3: (True, 7, "Завершён экспорт модели 'It''s' на сайт s (exp_id=3)"),
        4: (True, 4, "Завершён экспорт модели 'Two' на сайт s (exp_id=4)"),
        5: (True, 5, "Завершён экспорт модели 'Two' на сайт s (exp_id=5)"),
        6: (True, 6, "Завершён экспорт модели 'Three' на сайт s (exp_id=6)"),
        7: (None, 3, None),
        8: (False, 0, "stage 2 error=[import failed]"),
        9: (False, None, "stage 4 error=[no route]"),
    }
    now = datetime(2024, 2, 1)
    assert {i for i, t in by_key(outcome.exports, "exp_id", "exp_finish_dt").items() if t} == {1, 3, 4, 5, 6}
    assert {n.split(":")[1] for n, *_ in rows(outcomes.export_notices(outcome.exports), "notice_id")} == set("12345689")
    # The first export fills the ids that were missing; ids that were there stay, and so do the
    # times of stages that did not run. Exports that failed or are not finished write nothing.
    assert rows(outcome.devices) == [
        (1, 1, 101, 104, 102, now, now, now), (2, 1, 20, 21, 22, now, now, BEFORE), (3, 0, None, 31, None, None, now, None),
    ]


def test_batch_outcome_and_notices(frame):
    batches = frame("id INT, who INT, title STRING, dt_created TIMESTAMP_NTZ", *[(i, 124 if i == 2 else i, "t'", datetime(2024, 1, 1)) for i in range(1, 6)])
    results = frame(
        "batch_id INT, import_err STRING, import_out STRING, price_info_err STRING",
        (1, "", "", ""), (2, "e", "", ""), (3, "e", "o", ""), (4, "", "o", "p"), (5, None, None, "p"),
    )
    log = frame(LOG, *[(i, 1, 2, 4, None, 9, i % 3, "s", i) for i in range(1, 6)], (7, 2, 2, 4, None, 9, 0, "s", 3), (8, 1, 1, 4, None, 9, 0, "s", 77))
    outcome = outcomes.apply_batch_outcome(results, batches, log, devices(frame), NOW)
    found = by_key(outcome.batches, "id", "status", "article")
    assert {i: s for i, (s, _) in found.items()} == {1: 1, 2: -1, 3: -2, 4: -3, 5: -3}
    assert found[1][1] is None
    assert found[3][1] == "Пакетный экспорт №3 't''' от 2024-01-01 00:00:00 завершился с ошибкой:e/o"
    assert found[4][1].endswith(":/o/p") and found[5][1].endswith(":/p")
    # Members take the batch's status whatever their own was.
    assert by_key(outcome.exports, "exp_id", "exp_status", "exp_csv_status") == {1: (1, 4), 2: (-1, 4), 3: (-2, 4), 4: (-3, 4), 5: (-3, 4), 7: (-2, 4)}
    assert rows(outcome.devices, "dev_id", "version_num") == [(2, 1), (2, 2)]
    told = outcomes.batch_notices(outcome.batches)
    assert rows(told, "notice_id", "recipient") == [("batch:2", 124), ("batch:3", 124), ("batch:3", 3), ("batch:4", 124), ("batch:4", 4), ("batch:5", 124), ("batch:5", 5)]


def test_export_notices(frame):
    done = frame("exp_id INT, exp_creator INT, ok BOOLEAN, exp_result STRING", (1, 5, True, "good"), (2, 6, False, "bad"))
    assert rows(outcomes.export_notices(done)) == [("export:1", 5, "good", True), ("export:2", 6, "exp_id=2/bad", False)]


def test_caret_csv(spark, frame, tmp_path):
    values = [(1, None), (2, ""), (3, " x "), (4, "a^b"), (5, 'q"t"'), (6, "two\nlines"), (7, '"'), (8, "NULL"), (9, "\\"), (10, '\\"^')]
    df = frame("id INT, v STRING", *values)
    write_caret_csv(df.coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    assert text.startswith('id^v\n1^\n2^""\n3^ x \n4^"a^b"\n5^"q""t"""\n')
    assert rows(read_caret_csv(spark, str(tmp_path / "out"), df.schema)) == sorted(values, key=repr)


def test_check_constraints(frame):
    df = frame(FIELDS, (1, 1, 1, "a", "x"), (2, 1, 1, "a", "xyz"), (3, 1, 4, "a", None), (4, 1, 4, "a", "x"), (4, 7, 2, "b", "x"), (5, None, 2, "b", "x"), (6, None, 2, "b", "x"))
    parents = frame("exp_id INT", (1,), (2,))
    found = quality.check_constraints(
        df,
        [
            quality.Unique("pk", ("csv_id",)), quality.Unique("name", ("exp_id", "mod_csv", "bx_fld_name"), where="mod_csv IN (1, 2)"),
            quality.ForeignKey("fk", "exp_id", parents, "exp_id"), quality.NotNull("value", "bx_fld_value", ("csv_id",)),
            quality.MaxLength("length", "bx_fld_value", 2, ("csv_id",)), quality.KnownValue("known", "bx_fld_name", ("a",), ("csv_id", "exp_id")),
        ],
    )
    assert rows(found) == [
        ("fk", "7", "1 orphans"), ("known", "4|7", "unknown b"), ("known", "5|NULL", "unknown b"), ("known", "6|NULL", "unknown b"),
        ("length", "2", "bx_fld_value has 3 characters"), ("name", "1|1|a", "2 rows"), ("pk", "4", "2 rows"), ("value", "3", "bx_fld_value is missing"),
    ]
    assert rows(quality.cascade_delete(df, frame("exp_id INT", (1,))), "csv_id") == [(4,), (5,), (6,)]
