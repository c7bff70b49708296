"""Carrying prices from one catalogue version to another by the attributes they share.

``mod_param(dev_id, version_num, mod_id, dev_param_id, param_value)`` holds one row per
modification and attribute; all devices are handled in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.constants import CARRIED_COLUMNS as CARRIED
from shelfline.plans.lookup import growing, lookup_join


def shared_parameters(mod_param: DataFrame, v_from: int, v_to: int) -> DataFrame:
    """Per device the attributes of both versions, those they share and how they relate:
    1 the same, 3 one contains the other, 2 otherwise."""
    used = mod_param.where(F.col("version_num").isin(v_from, v_to)).select("dev_id", "version_num", "dev_param_id").distinct()

    def of(version: int):
        return F.array_sort(F.collect_set(F.when(F.col("version_num") == version, F.col("dev_param_id"))))

    sets = used.groupBy("dev_id").agg(of(v_from).alias("params_from"), of(v_to).alias("params_to"))
    only_from = F.size(F.array_except("params_from", "params_to"))
    only_to = F.size(F.array_except("params_to", "params_from"))
    relation = (
        F.when((only_from == 0) & (only_to == 0), 1).when((only_from == 0) | (only_to == 0), 3).otherwise(2)
    )
    return sets.select(
        "dev_id",
        "params_from",
        "params_to",
        F.array_sort(F.array_intersect("params_from", "params_to")).alias("shared"),
        relation.alias("relation"),
    )


def attribute_vectors(mod_param: DataFrame, v_from: int, v_to: int) -> DataFrame:
    """``dev_id, version_num, mod_id, vector``: the modification's values on the shared
    attributes, NULL when one is missing. Where nothing is shared all vectors are empty and equal.

    Attributes are gathered per modification first, a handful each, so that the join with the
    device's shared set handles one row per modification.
    """
    rows = mod_param.where(F.col("version_num").isin(v_from, v_to))
    gathered = rows.groupBy("dev_id", "version_num", "mod_id").agg(
        F.collect_list(
            F.when(F.col("param_value").isNotNull(), F.struct("dev_param_id", F.col("param_value").cast("string").alias("value")))
        ).alias("values")
    )
    shared = shared_parameters(mod_param, v_from, v_to).select("dev_id", "shared")
    vector = F.array_sort(F.filter("values", lambda v: F.array_contains("shared", v["dev_param_id"])))
    return (
        lookup_join(gathered, shared, "dev_id", "inner", many=True)
        .withColumn("vector", vector)
        .select(
            "dev_id", "version_num", "mod_id", F.when(F.size("vector") == F.size("shared"), F.col("vector")).alias("vector")
        )
    )


def _sides(mod_param: DataFrame, v_from: int, v_to: int) -> tuple[DataFrame, DataFrame]:
    vectors = attribute_vectors(mod_param, v_from, v_to)
    old = vectors.where(F.col("version_num") == v_from).select("dev_id", "vector", F.col("mod_id").alias("mod_id_from"))
    new = vectors.where((F.col("version_num") == v_to) & F.col("vector").isNotNull()).select(
        "dev_id", "vector", F.col("mod_id").alias("mod_id_to")
    )
    return old, new


def match_groups(mod_param: DataFrame, v_from: int, v_to: int) -> DataFrame:
    """The modifications of both versions by what they agree on: ``dev_id, group_key, version_num,
    mod_id, matched``. Members of a device with one ``group_key`` agree on all shared attributes (a backslash stands
    before ``;``, ``=`` and backslashes of a value);
    ``matched`` says that the group has members of both versions. As many rows as modifications,
    however large a group is; a modification that lacks a shared attribute has no key."""
    vectors = attribute_vectors(mod_param, v_from, v_to)
    # Marks inside a value are escaped, so that different vectors have different keys.
    text = F.transform("vector", lambda v: F.concat(v["dev_param_id"].cast("string"), F.lit("="), F.regexp_replace(v["value"], r"([\\;=])", r"\\$1")))
    rows = vectors.withColumn("group_key", F.when(F.col("vector").isNotNull(), F.array_join(text, ";")))
    sides = rows.where(F.col("group_key").isNotNull()).groupBy("dev_id", "group_key").agg(
        (F.min("version_num") != F.max("version_num")).alias("matched")
    )
    found = lookup_join(rows, sides, ["dev_id", "group_key"], many=True)
    return found.select("dev_id", "group_key", "version_num", "mod_id", F.coalesce("matched", F.lit(False)).alias("matched"))


def match_versions(mod_param: DataFrame, v_from: int, v_to: int) -> DataFrame:
    """Every old modification with the new ones that agree on all shared attributes:
    ``dev_id, mod_id_from, mod_id_to``; ``mod_id_to`` is NULL without a match.

    The pairs themselves are the result, as many as a group's sides multiply to. :func:`match_groups`
    says the same without them; to carry values over use :func:`winning_matches`.
    """
    old, new = _sides(mod_param, v_from, v_to)
    return old.join(growing(new), ["dev_id", "vector"], "left").select("dev_id", "mod_id_from", "mod_id_to")


def winning_matches(mod_param: DataFrame, v_from: int, v_to: int) -> DataFrame:
    """For every matched new modification the old one with the highest id:
    ``mod_id_from, mod_id_to``. One old modification stands for its whole group before the join,
    so groups of equal modifications are never paired out."""
    old, new = _sides(mod_param, v_from, v_to)
    winners = old.where(F.col("vector").isNotNull()).groupBy("dev_id", "vector").agg(F.max("mod_id_from").alias("mod_id_from"))
    return lookup_join(new, winners, ["dev_id", "vector"], "inner", many=True).select("mod_id_from", "mod_id_to")


def carry_prices(modification: DataFrame, matches: DataFrame, v_from: int, v_to: int) -> DataFrame:
    """The matched rows of version ``v_to`` with the carried columns of their old modification,
    NULLs included. Of several old ones for a row the highest id counts."""
    winners = (
        matches.where(F.col("mod_id_to").isNotNull()).groupBy("mod_id_to").agg(F.max("mod_id_from").alias("mod_id_from"))
    )
    old = modification.where(F.col("version_num") == v_from).select(
        F.col("mod_id").alias("mod_id_from"), *[F.col(c).alias(f"_{c}") for c in CARRIED]
    )
    carried = winners.join(growing(old), "mod_id_from").withColumnRenamed("mod_id_to", "mod_id")
    updated = {c: F.col(f"_{c}") for c in CARRIED} | {"mod_id_prev": F.col("mod_id_from")}
    return (
        modification.where(F.col("version_num") == v_to)
        .join(growing(carried), "mod_id")
        .withColumns(updated)
        .select(*modification.columns)
    )
