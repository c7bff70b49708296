"""One row per key: the newest by a given order.

An aggregate, not a ranking window: partial maxima are taken before the shuffle, so a key that
holds a large share of the rows sends one row per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(values: Sequence[str], order: Sequence[Column], where: Column | None = None) -> Column:
    """Aggregate giving the ``values`` of the row with the greatest ``order``; rows outside
    ``where`` do not take part. NULL order fields sort lowest."""
    rank = F.struct(*order)
    if where is not None:
        rank = F.when(where, rank)
    return F.max_by(F.struct(*values), rank)


def latest_per_key(df: DataFrame, key: str, order: Sequence[Column], values: Sequence[str]) -> DataFrame:
    """The ``values`` of the newest row of every ``key``."""
    return df.groupBy(key).agg(newest(values, order).alias("_row")).select(key, "_row.*")


def nulls_highest(column: str) -> tuple[Column, Column]:
    """Order fields that put NULL above every value, as a descending sort does in PostgreSQL."""
    return F.col(column).isNull(), F.col(column)
