"""Key lookups between items, modifications and devices, and the messages built from changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions import constants as C
from shelfline.plans.lookup import lookup_join

CURRENT = 1


def current(df: DataFrame, version: int = CURRENT) -> DataFrame:
    """The rows of one catalogue version."""
    return df.where(F.col("version_num") == version)


def synced_modifications(modification: DataFrame, device: DataFrame) -> DataFrame:
    """Current modifications that are linked to an item and whose device is on the shop."""
    on_shop = current(device).where(F.col("ie_xml_id").isNotNull() & F.col("ie_xml_id_dt").isNotNull())
    return (
        current(modification)
        .where(F.col("ks").isNotNull())
        .join(on_shop, "dev_id")
        .select("ks", "dev_name", "supplier_code", "mod_id")
    )


def attach_item_code(df: DataFrame, modification: DataFrame, into: str = "ks") -> DataFrame:
    """Add the item code of ``mod_id``."""
    codes = current(modification).groupBy("mod_id").agg(F.max("ks").alias(into))
    return lookup_join(df, codes, "mod_id")


def attach_mod_id(df: DataFrame, modification: DataFrame, into: str = "mod_id") -> DataFrame:
    """Add the modification id of ``ks``; of several the highest."""
    ids = current(modification).where(F.col("ks").isNotNull()).groupBy("ks").agg(F.max("mod_id").alias(into))
    return lookup_join(df, ids, "ks")


def import_parameters(df: DataFrame, import_param: DataFrame, name: str) -> DataFrame:
    """Add column ``name``: the parameter for the row's ``is_new`` and ``stage``."""
    values = import_param.where(F.col("ie_param_name") == name).select(
        F.col("brand_new").alias("is_new"), F.col("imp_mode").alias("stage"), F.col("ie_param_value").alias(name)
    )
    return df.join(values, ["is_new", "stage"], "left")


def site_update_messages(changes: DataFrame, null_quantity: str = "") -> DataFrame:
    """One outgoing row per pending change; an unknown ``active`` counts as active."""
    active = F.coalesce("active", F.lit(True))
    return changes.where(F.col("change_status") == C.PENDING).select(
        "id",
        "mod_id",
        "time_delivery",
        F.coalesce(F.col("qnt").cast("string"), F.lit(null_quantity)).alias("qnt"),
        active.alias("active"),
        (~active).alias("deactivate"),
    )
