"""Joining rows with one row per key when one key may hold a large share of the rows.

Adaptive execution splits a skewed partition of a join only when both sides were shuffled for
that join. An aggregate by the same key is not: it already has the partitioning, and the other
side would just follow it, hot key and all. Here the key is wrapped, so that the aggregate, one
row per key, is shuffled once more and the hot partition of the rows can be split. A small
aggregate is still broadcast, by its measured size.

Before anything is measured, Catalyst goes by the size of compressed files, and a plan that starts
with a broadcast keeps it, as the sorted join costs one more shuffle. Where both sides grow with the
data, ``many`` and :func:`growing` rule the broadcast out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _wrapped(keys: Sequence[str]) -> Column:
    """The keys as one value, NULL when any is: NULL keys match nothing."""
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return F.when(known, F.struct(*keys))


def fresh_name(wanted: str, *frames: DataFrame) -> str:
    """``wanted``, or with marks after it, so that no column of the frames has that name."""
    taken = {c.lower() for df in frames for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def growing(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is sorted, never broadcast."""
    return df.hint("merge")


def lookup_join(rows: DataFrame, per_key: DataFrame, keys: str | Sequence[str], how: str = "left", many: bool = False) -> DataFrame:
    """Equi-join of ``rows`` with an aggregate by ``keys``: inner, left, left_semi or left_anti.
    The keys keep their place among the columns of ``rows``. ``many``: there are about as many keys
    as rows, at any size of the data."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    name = fresh_name("_lookup", rows, per_key)
    looked_up = per_key.withColumn(name, _wrapped(keys)).drop(*keys)
    looked_up = growing(looked_up) if many else looked_up
    return rows.withColumn(name, _wrapped(keys)).join(looked_up, name, how).drop(name)
