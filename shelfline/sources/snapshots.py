"""Row changes from two snapshots of a table, for sources that announce none.

Rows are compared by fingerprint: one shuffle carries a key, its side and 128 bits for each row,
combined before it moves. Whole rows are joined only for the keys that differ, and then have the form
of :mod:`shelfline.sources.change_feed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.sources.change_feed import change_schema

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _fingerprint(schema: T.StructType) -> list[Column]:
    """Two hashes over the values and over which of them are missing: a hash alone passes over NULL,
    so that a value moving to the next column would not show."""
    known = [_column(f.name).isNotNull() for f in schema]
    values = [
        F.to_json(F.struct(_column(f.name)), {"ignoreNullFields": "false"}) if isinstance(f.dataType, _NESTED) else _column(f.name)
        for f in schema
    ]
    return [F.xxhash64(*known, *values).alias("_h1"), F.xxhash64(F.lit("second"), *values, *known).alias("_h2")]


def _keys(key: Sequence[str]) -> list[str]:
    return [f"_key{n}" for n in range(len(key))]


def _checked(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``after`` with its columns in the order of ``before``, and the key as a list."""
    types = [{f.name: f.dataType for f in df.schema} for df in (before, after)]
    if types[0] != types[1]:
        raise ValueError(f"the snapshots differ in columns: {sorted(set(types[0].items()) ^ set(types[1].items()), key=str)}")
    return after.select(*[_column(c) for c in before.columns]), [key] if isinstance(key, str) else list(key)


def _compared(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """One row a key: rows on either side, and whether they differ."""
    names = _keys(key)

    def side(rows: DataFrame, is_after: bool) -> DataFrame:
        return rows.select(*[_column(k).alias(n) for k, n in zip(key, names)], F.lit(is_after).alias("_after"), *_fingerprint(before.schema))

    per_key = side(before, False).unionByName(side(after, True)).groupBy(*names).agg(
        F.count_if(~F.col("_after")).alias("rows_before"),
        F.count_if(F.col("_after")).alias("rows_after"),
        F.bit_xor("_h1").alias("_x1"),
        F.bit_xor("_h2").alias("_x2"),
    )
    # Of two rows, one a side, equal hashes cancel out.
    differs = (F.col("rows_before") != F.col("rows_after")) | (F.col("_x1") != 0) | (F.col("_x2") != 0)
    keyed = F.lit(True)
    for name in names:
        keyed = keyed & F.col(name).isNotNull()
    return per_key.select(*names, "rows_before", "rows_after", differs.alias("_differs"), keyed.alias("_keyed"))


def row_changes(before: DataFrame, after: DataFrame, key: str | Sequence[str], seq: int) -> DataFrame:
    """``op, seq, before, after`` of every key whose row came (``I``), went (``D``) or differs (``U``).

    ``seq`` numbers the later snapshot: it is the same for all its changes. Both have the same columns,
    in any order. NULL equals NULL and ``-0.0`` equals ``0.0``. Keys are unique and known; rows for which that
    is not so have no counterpart and are what :func:`snapshot_rejects` reports. Two different rows count
    as equal when 128 bits of hashes agree.
    """
    after, key = _checked(before, after, key)
    names = _keys(key)
    unique = (F.col("rows_before") <= 1) & (F.col("rows_after") <= 1)
    changed = _compared(before, after, key).where(F.col("_keyed") & F.col("_differs") & unique).select(*names)

    def side(rows: DataFrame, name: str) -> DataFrame:
        packed = rows.select(*[_column(k).alias(n) for k, n in zip(key, names)], F.struct(*[_column(c) for c in rows.columns]).alias(name))
        return packed.join(changed, names)

    op = F.when(F.col("before").isNull(), "I").when(F.col("after").isNull(), "D").otherwise("U")
    both = side(before, "before").join(side(after, "after"), names, "full")
    return both.select(op.alias("op"), F.lit(seq).cast("long").alias("seq"), "before", "after").to(change_schema(before.schema))


def snapshot_rejects(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that name no single row, as ``*key, rows_before, rows_after, reason``: ``no key`` when a part of
    it is NULL, ``repeated key`` when a snapshot has several rows for it."""
    after, key = _checked(before, after, key)
    reason = F.when(~F.col("_keyed"), "no key").when((F.col("rows_before") > 1) | (F.col("rows_after") > 1), "repeated key")
    found = _compared(before, after, key).withColumn("reason", reason).where("reason IS NOT NULL")
    return found.select(*[F.col(n).alias(k) for k, n in zip(key, _keys(key))], "rows_before", "rows_after", "reason")
