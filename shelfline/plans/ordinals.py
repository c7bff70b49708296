"""Positions, predecessors and running totals inside a group of any size.

A window over the group would send the whole group to one task. Here the order column, a unique
whole number, cuts each group into slices of at most ``2 ** bits`` rows. Windows run inside slices;
what has to cross slices (row counts, last rows, sums) is one small row per slice.

Start with :func:`with_slice`, apply any of the others, drop ``_slice`` at the end. Rows are
shuffled by key and slice once; further steps over the same slices find them in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"
SLICE_BITS = 16


def with_slice(df: DataFrame, order: str, bits: int = SLICE_BITS) -> DataFrame:
    """Add ``_slice``, the stretch of the order column a row is in."""
    return df.withColumn(SLICE, F.shiftright(F.col(order).cast("long"), bits))


def _earlier_slices(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def _inside(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys, SLICE).orderBy(order)


def slice_starts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """From rows per slice, ``counts(*keys, _slice, _n)``, the rows before it in the group:
    ``*keys, _slice, _start``."""
    earlier = F.sum("_n").over(_earlier_slices(keys))
    return counts.select(*keys, SLICE, F.coalesce(earlier, F.lit(0)).alias("_start"))


def number_rows(rows: DataFrame, starts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add ``ordinal``, the 0-based position, to sliced ``rows``; further columns of ``starts``
    come along."""
    return (
        rows.withColumn("_pos", F.row_number().over(_inside(keys, order)))
        .join(starts, [*keys, SLICE])
        .withColumn("ordinal", F.col("_start") + F.col("_pos") - 1)
        .drop("_pos", "_start")
    )


def with_ordinal(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Add ``ordinal``, the 0-based position by ``order`` within ``keys``, to sliced ``rows``."""
    counts = rows.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    return number_rows(rows, slice_starts(counts, keys), keys, order)


def with_previous(
    rows: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], alias: str = "previous"
) -> DataFrame:
    """Add struct ``alias`` to sliced ``rows``: the ``values`` of the row before by ``order``
    within ``keys``, NULL for the first."""
    row = F.struct(*values)
    last = rows.groupBy(*keys, SLICE).agg(F.max_by(row, F.col(order)).alias("_last"))
    carried = last.select(*keys, SLICE, F.lag("_last").over(Window.partitionBy(*keys).orderBy(SLICE)).alias("_before"))
    return (
        rows.withColumn("_inside", F.lag(row).over(_inside(keys, order)))
        .join(carried, [*keys, SLICE])
        .withColumn(alias, F.coalesce("_inside", "_before"))
        .drop("_inside", "_before")
    )


def with_running_total(rows: DataFrame, keys: Sequence[str], order: str, amount: Column, alias: str) -> DataFrame:
    """Add ``alias`` to sliced ``rows``: the sum of ``amount`` up to and including each row."""
    sums = rows.groupBy(*keys, SLICE).agg(F.sum(amount).alias("_sum"))
    carried = sums.select(*keys, SLICE, F.coalesce(F.sum("_sum").over(_earlier_slices(keys)), F.lit(0)).alias("_carried"))
    so_far = _inside(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_inside", F.sum(amount).over(so_far))
        .join(carried, [*keys, SLICE])
        .withColumn(alias, F.col("_carried") + F.col("_inside"))
        .drop("_inside", "_carried")
    )
