"""Attribute rows to typed wide exports, and the plan of what to export."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import constants as C
from shelfline.functions.text import null_as_text
from shelfline.operators.lookups import import_parameters
from shelfline.plans.ordinals import SLICE_BITS, number_rows, slice_starts, with_slice

EXPORT_KEYS = ["exp_id", "mod_csv"]

# The stage each kind of export belongs to.
PRESETS = {"device": C.STAGE_DEVICE, "modificators": C.STAGE_MODIFIERS, "prices": C.STAGE_PRICES}

# A table of the source cannot have more columns than this, so neither can a dictionary have entries.
MAX_DICTIONARY = 1600
# Text that is a number; the type ``numeric`` without precision holds any of them.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


class Field(NamedTuple):
    """A dictionary entry; ``number``: text that has to be a number, of any length and scale."""

    name: str
    data_type: T.DataType
    number: bool = False

    @property
    def column(self) -> str:
        """Column names are folded to lower case, as unquoted SQL names are."""
        return self.name.lower()


def _unbounded(data_type: str) -> bool:
    return data_type.strip().lower() in ("numeric", "decimal")


def spark_type(data_type: str) -> T.DataType:
    """Spark type for a dictionary's SQL type name. A number without precision stays text: no
    decimal type holds all of them, and the export is a text file."""
    name, _, arguments = data_type.strip().lower().partition("(")
    name, arguments = name.strip(), re.findall(r"\d+", arguments)
    if name in ("numeric", "decimal"):
        if not arguments:
            return T.StringType()
        return T.DecimalType(int(arguments[0]), int(arguments[1]) if len(arguments) > 1 else 0)
    types = {
        "smallint": T.ShortType(),
        "integer": T.IntegerType(),
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "real": T.FloatType(),
        "double precision": T.DoubleType(),
        "boolean": T.BooleanType(),
        "date": T.DateType(),
        "timestamp without time zone": T.TimestampNTZType(),
        "timestamp": T.TimestampNTZType(),
    }
    return types.get(name, T.StringType())


def read_dictionary(export_dict: DataFrame, most: int = MAX_DICTIONARY) -> list[Field]:
    """Column names and types in dictionary order. The one read on the driver: the result's
    schema depends on it, and it is as short as a table is wide. More than ``most`` entries are
    an error."""
    rows = export_dict.select("dict_name", "data_type").orderBy("dict_order", "dict_name").take(most + 1)
    if len(rows) > most:
        raise ValueError(f"export dictionary has more than {most} entries")
    return [Field(r.dict_name, spark_type(r.data_type), _unbounded(r.data_type)) for r in rows]


def field_counts(export_field: DataFrame) -> DataFrame:
    """Distinct field names per export and mode, the width of its records."""
    return export_field.groupBy(*EXPORT_KEYS).agg(F.countDistinct("bx_fld_name").alias("field_count"))


def chunk_records(export_field: DataFrame, mode: int | None = None, slice_bits: int = SLICE_BITS) -> DataFrame:
    """Number the records of each export from 0: a record is as many rows, in ``csv_id`` order,
    as the export has distinct fields. Exports without a named field have no records.

    An export may be most of the table, so rows are numbered in slices. One pass counts the rows
    by slice and field name; record widths and slice starts both come from these counts.
    """
    rows = export_field.where(F.col("exp_id").isNotNull() & F.col("mod_csv").isNotNull())
    if mode is not None:
        rows = rows.where(F.col("mod_csv") == mode)
    rows = with_slice(rows, "csv_id", slice_bits)
    # The test on the count keeps both uses of this aggregate alike, so that it is shuffled once.
    names = rows.groupBy(*EXPORT_KEYS, "_slice", "bx_fld_name").agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    widths = field_counts(names).where(F.col("field_count") > 0)
    starts = slice_starts(names.groupBy(*EXPORT_KEYS, "_slice").agg(F.sum("_n").alias("_n")), EXPORT_KEYS)
    numbered = number_rows(rows, starts.join(widths, EXPORT_KEYS), EXPORT_KEYS, "csv_id")
    return numbered.withColumn("rec", F.expr("ordinal div field_count")).drop("_slice", "ordinal", "field_count")


REJECTS = "_rejects"


def to_wide(chunked: DataFrame, dictionary: list[Field]) -> DataFrame:
    """One row per record with a typed column per dictionary entry, in its order. A field that
    the record lacks is NULL, a field without a value is empty; text that does not fit the type
    is NULL here and told by :func:`to_wide_rejects`. Of several values of a field the greatest counts.
    """
    return judged_wide(chunked, dictionary).drop(REJECTS)


def to_wide_rejects(judged: DataFrame) -> DataFrame:
    """The values of :func:`judged_wide` that do not fit their column's type: ``exp_id, mod_csv, rec,
    field, value``. Empty text is no value and no reject."""
    return judged.where(F.size(REJECTS) > 0).select(*EXPORT_KEYS, "rec", F.inline(REJECTS))


def judged_wide(chunked: DataFrame, dictionary: list[Field], observed: str | Observation | None = None) -> DataFrame:
    """:func:`to_wide` with what it could not type, ``_rejects``: an array of ``field, value``, empty for a
    record in order. One pass gives both: write it once, or cache it, and take either part. With
    ``observed``, a name or an Observation, it counts ``records`` and ``rejects`` on the way.

    A record's fields are gathered, as many as the record has (a record is as long as its export
    has fields), and looked up by name: one comparison a row, not one for every column.
    """
    value = F.coalesce("bx_fld_value", F.lit(""))
    pairs = F.sort_array(F.collect_list(F.struct(F.col("bx_fld_name").alias("k"), value.alias("v"))), asc=False)
    # Sorted downwards: the first place of a name has its greatest value.
    wide = chunked.groupBy(*EXPORT_KEYS, "rec").agg(pairs.alias("_pairs"))
    wide = wide.select(*EXPORT_KEYS, "rec", F.col("_pairs.k").alias("_names"), F.col("_pairs.v").alias("_values"))

    def text(f: Field) -> Column:
        return F.get("_values", (F.array_position("_names", f.name) - 1).cast("int"))

    def typed(f: Field) -> Column:
        if f.number:
            return F.when(text(f).rlike(NUMBER), F.trim(text(f)))
        return text(f).try_cast(f.data_type)

    def reject(f: Field) -> Column:
        bad = (F.trim(text(f)) != "") & typed(f).isNull()
        return F.when(bad, F.struct(F.lit(f.name).alias("field"), text(f).alias("value")))

    checked = [f for f in dictionary if f.number or not isinstance(f.data_type, T.StringType)]
    none = F.array().cast("array<struct<field:string,value:string>>")
    rejects = F.array_compact(F.array(*[reject(f) for f in checked])) if checked else none
    judged = wide.select(*EXPORT_KEYS, "rec", *[typed(f).alias(f.column) for f in dictionary], rejects.alias(REJECTS))
    if observed is None:
        return judged
    return judged.observe(observed, F.count(F.lit(1)).alias("records"), F.sum(F.size(REJECTS)).alias("rejects"))


def export_headers(export_log: DataFrame, device: DataFrame) -> DataFrame:
    """Shop id and name of the device version each export is about."""
    versions = device.select("dev_id", F.col("version_num").alias("exp_version_num"), "ie_xml_id", "dev_name")
    return export_log.join(versions, ["dev_id", "exp_version_num"]).select("exp_id", "ie_xml_id", "dev_name")


def export_wide(
    export_field: DataFrame, dictionary: list[Field], device: DataFrame, export_log: DataFrame, preset: str
) -> DataFrame:
    """The wide rows of one kind of export, with the device they belong to."""
    wide = to_wide(chunk_records(export_field, PRESETS[preset]), dictionary)
    columns = [f.column for f in dictionary]
    return wide.join(export_headers(export_log, device), "exp_id", "left").select(
        "exp_id", "rec", "ie_xml_id", "dev_name", *columns
    )


def batch_prices(
    export_batch: DataFrame, export_log: DataFrame, export_field: DataFrame, dictionary: list[Field]
) -> DataFrame:
    """Prices of all started batches as one wide table: the exports of a batch that have not
    been exported yet, without the grouping columns. Batches without such an export give nothing."""
    started = export_batch.where(F.col("status") == C.BATCH_START).select(F.col("id").alias("exp_batch_id"))
    members = (
        export_log.where(F.col("exp_status") == 0)
        .join(started, "exp_batch_id", "left_semi")
        .select("exp_id", "exp_batch_id")
    )
    fields = export_field.join(members, "exp_id", "left_semi")
    wide = to_wide(chunk_records(fields, C.STAGE_PRICES), dictionary)
    columns = [f.column for f in dictionary if f.column not in C.BATCH_DROPPED_COLUMNS]
    return wide.join(members, "exp_id").select("exp_batch_id", "exp_id", "rec", *columns)


def mask_bits(mask: str) -> Column:
    """The three stage bits of a mask, NULL as none."""
    return F.coalesce(F.col(mask).cast("int"), F.lit(0)).bitwiseAND(F.lit(7))


def has_stage(mask: Column, stage: Column | int) -> Column:
    stage = F.lit(stage) if isinstance(stage, int) else stage
    return mask.bitwiseAND(stage) == stage


def is_new_for(stage: str) -> Column:
    """Whether the device has not been through this stage: its section or shop id is missing."""
    return (
        F.when(F.col(stage) == C.STAGE_MODIFIERS, F.col("ip_prop675").isNull())
        .when(F.col(stage) == C.STAGE_PRICES, F.col("ip_prop674").isNull())
        .when(F.col(stage) == C.STAGE_DEVICE, F.col("ie_xml_id").isNull())
    )


def export_plan(export_log: DataFrame, device: DataFrame, import_param: DataFrame) -> DataFrame:
    """One row per export and stage it has to run, in stage order, with the file and the import
    profile the stage uses."""
    order = F.array(*[F.lit(s) for s in C.STAGE_ORDER])
    versions = device.select(
        "dev_id", F.col("version_num").alias("exp_version_num"), "ie_xml_id", "ip_prop674", "ip_prop675"
    )
    stages = (
        export_log.select("exp_id", "dev_id", "exp_version_num", mask_bits("exp_mod").alias("_mask"))
        .join(versions, ["dev_id", "exp_version_num"])
        .withColumn("_stages", F.filter(order, lambda s: has_stage(F.col("_mask"), s)))
        .select("*", F.posexplode("_stages").alias("stage_pos", "stage"))
        .select("exp_id", "stage_pos", "stage", is_new_for("stage").alias("is_new"))
    )
    for name in ("csv_file", "import_profile"):
        stages = import_parameters(stages, import_param, name)
    return stages.select("exp_id", "stage_pos", "stage", "is_new", "csv_file", "import_profile")


def validate_exports(export_log: DataFrame, device: DataFrame, prod_site: str, dev_site: str) -> DataFrame:
    """First broken rule of every export: ``exp_id, rule``."""
    versions = device.select("dev_id", F.col("version_num").alias("exp_version_num"), F.lit(True).alias("_found"))
    version, site = F.col("exp_version_num"), F.col("exp_site")
    rule = (
        F.when((version != 1) & (site == prod_site), "production takes version 1 only")
        .when((version > 1) & (site == dev_site), "development site takes no archive")
        .when(F.col("_found").isNull(), "no device")
        .otherwise("ok")
    )
    return export_log.join(versions, ["dev_id", "exp_version_num"], "left").select("exp_id", rule.alias("rule"))


def guard_export_changes(changes: DataFrame, device: DataFrame, prod_site: str) -> DataFrame:
    """Whether each update of an export is allowed and whether it starts the export:
    ``exp_id, verdict, starts_export``. ``changes(exp_id, before, after)``."""
    before, after = (lambda c: F.col(f"before.{c}")), (lambda c: F.col(f"after.{c}"))
    versions = device.select(
        F.col("dev_id").alias("_dev"), F.col("version_num").alias("_version"), "ie_xml_id", F.lit(True).alias("_found")
    )
    finished = F.coalesce(
        (before("exp_mod") == before("exp_csv_status")) & (before("exp_site") == prod_site) & (before("exp_status") >= 1),
        F.lit(False),
    )
    known = F.col("ie_xml_id").isNotNull()
    supported = (~known & after("exp_mod").isin(*C.MODES_FOR_NEW_DEVICE)) | (
        known & after("exp_mod").isin(*C.MODES_FOR_KNOWN_DEVICE)
    )
    verdict = (
        F.when(finished & (before("exp_status") == 1) & (after("exp_version_num") > 1), "archiving allowed")
        .when(finished, "archive locked")
        .when(F.col("_found").isNull(), "no device")
        .when(supported, "ok")
        .otherwise("mode not supported")
    )
    started = F.coalesce((before("exp_status") != after("exp_status")) & (after("exp_status") == 1), F.lit(False))
    allowed = F.col("verdict").isin("ok", "archiving allowed")
    on_device = (after("dev_id") == F.col("_dev")) & (after("exp_version_num") == F.col("_version"))
    return (
        changes.join(versions, on_device, "left")
        .withColumn("verdict", verdict)
        .select("exp_id", "verdict", (allowed & started).alias("starts_export"))
    )


def guard_synced_fields(changes: DataFrame, texts: C.ExportTexts = C.ExportTexts()) -> DataFrame:
    """Updates of shop or section ids that must be refused: the version is not in development and
    one of the ids was set. ``dev_id, message`` for ``changes(dev_id, before, after)``."""
    ids = ("ie_xml_id", "ip_prop674", "ip_prop675")
    touched, was_set = F.lit(False), F.lit(False)
    for name in ids:
        touched = touched | ~F.col(f"before.{name}").eqNullSafe(F.col(f"after.{name}"))
        was_set = was_set | F.col(f"before.{name}").isNotNull()
    parts = [F.lit(texts.guarded_update)]
    for name in ("ie_xml_id", "ie_xml_id_dt", "ip_prop674", "ip_prop675"):
        parts += [F.lit(f"\n{name}(OLD/NEW)="), null_as_text(f"before.{name}"), F.lit("/"), null_as_text(f"after.{name}")]
    return changes.where((F.col("before.version_num") > 0) & was_set & touched).select(
        "dev_id", F.concat(*parts).alias("message")
    )
