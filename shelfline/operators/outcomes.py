"""What finished exports and batches leave behind: log entries, device ids, notices.

The exports themselves run elsewhere; their answers arrive as tables of results.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import constants as C
from shelfline.functions.text import quoted
from shelfline.operators.export import has_stage, is_new_for, mask_bits
from shelfline.plans.lookup import growing


class ExportOutcome(NamedTuple):
    exports: DataFrame
    devices: DataFrame


class BatchOutcome(NamedTuple):
    batches: DataFrame
    exports: DataFrame
    devices: DataFrame


def _judged_stages(stage_results: DataFrame, export_log: DataFrame, device: DataFrame) -> DataFrame:
    """Results of planned stages with the id each returned and whether the stage failed.

    A stage fails with an error of copying or importing. It also has to return a number when its section or the device is new, the device stage
    always, and the price stage also when no device stage follows. Results, several an export, move
    once: they come by export, and what groups them by it finds them in place.
    """
    exports = export_log.select(
        "exp_id", "dev_id", "exp_version_num", "exp_csv_status", "exp_creator", "exp_site", mask_bits("exp_mod").alias("mask")
    )
    versions = device.select(
        "dev_id",
        F.col("version_num").alias("exp_version_num"),
        "dev_name",
        "ie_xml_id",
        "ip_prop674",
        "ip_prop675",
    )
    returned = F.col("returned_text").try_cast("int").cast("long")
    last_is_prices = (F.col("stage") == C.STAGE_PRICES) & ~has_stage(F.col("mask"), C.STAGE_DEVICE)
    needs_id = F.col("is_new") | (F.col("stage") == C.STAGE_DEVICE) | last_is_prices
    return (
        stage_results.join(growing(exports.join(growing(versions), ["dev_id", "exp_version_num"])), "exp_id")
        .where(has_stage(F.col("mask"), F.col("stage")))
        .withColumn("is_new", is_new_for("stage"))
        .withColumn("returned_id", returned)
        .withColumn("faulty", F.coalesce(F.col("error"), F.lit("")) != "")
        .withColumn("failed", F.col("faulty") | (needs_id & F.col("returned_id").isNull()))
    )


def _stage_rank() -> Column:
    rank = F.when(F.col("stage") == C.STAGE_ORDER[0], 0)
    for position, stage in enumerate(C.STAGE_ORDER[1:], 1):
        rank = rank.when(F.col("stage") == stage, position)
    return rank


def apply_export_outcome(
    stage_results: DataFrame,
    export_log: DataFrame,
    device: DataFrame,
    as_of: str,
    texts: C.ExportTexts = C.ExportTexts(),
) -> ExportOutcome:
    """Outcome of every export with results ``stage_results(exp_id, stage, returned_text, error)``.

    An export succeeds or fails as a whole: it succeeds when every planned stage has a result and
    none failed. Success adds the stages to its status and writes the device: ids only where they
    were missing (the first export to fill one wins), the sync times of its stages, and the stored
    ones otherwise. Failure changes neither and leaves the offending answer as the result. An export
    without failure that lacks a stage is not finished: ``ok`` is NULL and nothing is changed.
    """
    stages = _judged_stages(stage_results, export_log, device)
    done_at = F.lit(as_of).cast("timestamp_ntz")
    per_export = stages.groupBy(
        "exp_id", "dev_id", "exp_version_num", "exp_csv_status", "exp_creator", "exp_site", "dev_name", "mask"
    ).agg(
        F.bit_or("stage").alias("done"),
        F.bool_or("failed").alias("failed"),
        F.min_by(
            F.concat(
                F.lit("stage "), F.col("stage").cast("string"), F.when(F.col("faulty"), " error=[").otherwise(" result=["),
                F.when(F.col("faulty"), F.col("error")).otherwise(F.coalesce("returned_text", F.lit(""))), F.lit("]"),
            ),
            F.when(F.col("failed"), _stage_rank()),
        ).alias("error"),
        *[
            F.max(F.when((F.col("stage") == stage) & F.col("is_new"), F.col("returned_id"))).alias(name)
            for name, stage in (("new_ie_xml_id", C.STAGE_DEVICE), ("new_ip_prop674", C.STAGE_PRICES), ("new_ip_prop675", C.STAGE_MODIFIERS))
        ],
    )
    ok = F.when(F.col("failed"), False).when(F.col("done") == F.col("mask"), True)
    status = F.col("exp_csv_status").cast("int")
    combined = F.coalesce(status.bitwiseAND(F.lit(7)), F.lit(0)).bitwiseOR(F.col("done"))
    success = F.concat(
        F.lit(texts.done_model), quoted("dev_name"), F.lit(texts.done_on_site), F.col("exp_site"),
        F.lit(" (exp_id="), F.col("exp_id").cast("string"), F.lit(")"),
    )
    exports = per_export.select(
        "exp_id",
        "exp_creator",
        ok.alias("ok"),
        F.when(ok, combined).otherwise(status).alias("exp_csv_status"),
        F.when(ok, success).when(~ok, F.col("error")).alias("exp_result"),
        F.when(ok, done_at).alias("exp_finish_dt"),
    )

    def first_new(name: str) -> Column:
        return F.min_by(f"new_{name}", F.when(F.col(f"new_{name}").isNotNull(), F.col("exp_id"))).alias(f"_{name}")

    def touched(stage: int, name: str) -> Column:
        return F.when(F.bool_or(has_stage(F.col("done"), stage)), done_at).alias(f"_{name}")

    updates = (
        per_export.where(ok)
        .groupBy("dev_id", F.col("exp_version_num").alias("version_num"))
        .agg(
            first_new("ie_xml_id"), first_new("ip_prop674"), first_new("ip_prop675"),
            touched(C.STAGE_DEVICE, "ie_xml_id_dt"), touched(C.STAGE_PRICES, "ip_prop674_dt"), touched(C.STAGE_MODIFIERS, "ip_prop675_dt"),
        )
    )
    ids, dates = ("ie_xml_id", "ip_prop674", "ip_prop675"), ("ie_xml_id_dt", "ip_prop674_dt", "ip_prop675_dt")
    devices = updates.join(growing(device.select("dev_id", "version_num", *ids, *dates)), ["dev_id", "version_num"])
    return ExportOutcome(
        exports,
        devices.select(
            "dev_id",
            "version_num",
            *[F.coalesce(c, f"_{c}").alias(c) for c in ids],
            *[F.coalesce(f"_{c}", c).alias(c) for c in dates],
        ),
    )


def unfinished_exports(
    stage_results: DataFrame, export_log: DataFrame, device: DataFrame, as_of: str, patience: str = "INTERVAL 1 DAY"
) -> DataFrame:
    """Exports with planned stages that neither failed nor have an answer for each, those without any
    answer too: ``exp_id, exp_creator, exp_site, exp_dt, answered, missing, expired``.

    ``answered`` and ``missing`` are stage masks. ``expired`` says that the export began ``patience``
    ago or earlier; one that began at an unknown time does not expire.
    """
    judged = _judged_stages(stage_results, export_log, device).groupBy("exp_id").agg(
        F.bit_or("stage").alias("_done"), F.bool_or("failed").alias("_failed")
    )
    answered = F.coalesce("_done", F.lit(0)).cast("int")
    until = F.lit(as_of).cast("timestamp_ntz") - F.expr(patience)
    return (
        export_log.select("exp_id", "exp_creator", "exp_site", "exp_dt", mask_bits("exp_mod").alias("_mask"))
        .join(growing(judged), "exp_id", "left")
        .withColumn("answered", answered)
        .withColumn("missing", F.col("_mask").bitwiseAND(F.bitwise_not(F.col("answered"))))
        .where((F.col("missing") != 0) & ~F.coalesce("_failed", F.lit(False)))
        .select("exp_id", "exp_creator", "exp_site", "exp_dt", "answered", "missing", F.coalesce(F.col("exp_dt") <= until, F.lit(False)).alias("expired"))
    )


def apply_batch_outcome(
    batch_results: DataFrame,
    export_batch: DataFrame,
    export_log: DataFrame,
    device: DataFrame,
    as_of: str,
    texts: C.ExportTexts = C.ExportTexts(),
) -> BatchOutcome:
    """Outcome of batches with ``batch_results(batch_id, import_err, import_out, price_info_err)``.

    The last problem decides the status (1 success, -1 import error, -2 import output, -3
    price-info error); the texts add up. Every member takes the batch's status, whatever its own
    was, and every member's device counts as synchronised, also after a failure.
    """
    def said(name: str) -> Column:
        return F.coalesce(name, F.lit("")) != ""

    def part(name: str, prefix: str = "/") -> Column:
        return F.when(said(name), F.concat(F.lit(prefix), F.col(name))).otherwise("")

    status = (
        F.when(said("price_info_err"), -3).when(said("import_out"), -2).when(said("import_err"), -1).otherwise(1)
    )
    problems = F.concat(part("import_err", ""), part("import_out"), part("price_info_err"))
    judged = batch_results.select(
        F.col("batch_id").alias("id"), status.alias("status"), problems.alias("problems"), (problems == "").alias("ok")
    )
    number = F.col("id").cast("string")
    lead, since, failed_with = texts.batch_notice
    article = F.concat(
        F.lit(lead), number, F.lit(" "), F.coalesce(quoted("title"), F.lit("")), F.lit(since),
        F.coalesce(F.date_format("dt_created", "yyyy-MM-dd HH:mm:ss"), F.lit("")), F.lit(failed_with), F.col("problems"),
    )
    done_at = F.lit(as_of).cast("timestamp_ntz")
    batches = judged.join(export_batch.select("id", "who", "title", "dt_created"), "id").select(
        "id",
        "who",
        "status",
        "ok",
        F.when(F.col("ok"), texts.batch_done).otherwise(texts.batch_failed).alias("exp_result"),
        F.when(~F.col("ok"), article).alias("article"),
        done_at.alias("dt_finished"),
    )
    members = export_log.select("exp_id", "dev_id", "exp_version_num", "exp_mod", F.col("exp_batch_id").alias("id")).join(
        judged, "id"
    )
    member_text = F.when(F.col("ok"), texts.batch_member_done).otherwise(texts.batch_member_failed)
    exports = members.select(
        "exp_id",
        F.col("exp_mod").alias("exp_csv_status"),
        F.col("status").alias("exp_status"),
        F.concat(member_text, number).alias("exp_result"),
        done_at.alias("exp_finish_dt"),
    )
    touched = members.select("dev_id", F.col("exp_version_num").alias("version_num")).distinct()
    devices = device.join(touched, ["dev_id", "version_num"], "left_semi").select(
        "dev_id", "version_num", done_at.alias("ie_xml_id_dt"), done_at.alias("ip_prop674_dt")
    )
    return BatchOutcome(batches, exports, devices)


def export_notices(exports: DataFrame) -> DataFrame:
    """Notice to the creator of every finished export: already read on success, the error otherwise."""
    key = F.col("exp_id").cast("string")
    return exports.where(F.col("ok").isNotNull()).select(
        F.concat(F.lit("export:"), key).alias("notice_id"),
        F.col("exp_creator").alias("recipient"),
        F.when(F.col("ok"), F.col("exp_result"))
        .otherwise(F.concat(F.lit("exp_id="), key, F.lit("/"), F.col("exp_result")))
        .alias("notice"),
        F.col("ok").alias("is_read"),
    )


def batch_notices(batches: DataFrame, observer: int = C.BATCH_OBSERVER) -> DataFrame:
    """Notices about failed batches, to the owner and the observer, once when they are the same."""
    owner = F.col("who")
    recipients = F.when(owner != observer, F.array(owner, F.lit(observer).cast("long"))).otherwise(F.array(owner))
    return batches.where(~F.col("ok")).select(
        F.concat(F.lit("batch:"), F.col("id").cast("string")).alias("notice_id"),
        F.explode(recipients).alias("recipient"),
        F.col("article").alias("notice"),
        F.lit(False).alias("is_read"),
    )


def outcome_notices(exports: DataFrame, batches: DataFrame, observer: int = C.BATCH_OBSERVER) -> DataFrame:
    """All notices: ``notice_id, recipient, notice, is_read``."""
    return export_notices(exports).unionByName(batch_notices(batches, observer))
