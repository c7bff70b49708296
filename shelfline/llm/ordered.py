"""Places and running totals in the sort order of a whole table.

Rows are ranged by their order, so that no task holds more than its share, and written once: a place
is where a row lies in that table. What has to cross tasks is one small row per task or slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import materialized
from shelfline.plans.ordinals import SLICE_BITS

_PLACE_BITS = 33  # monotonically_increasing_id: number of the task above, place in it below


def indexed(rows: DataFrame, order: Sequence[str], alias: str = "index") -> DataFrame:
    """Add ``alias``: 0, 1, 2, ... in ascending order (nulls first) of the columns ``order``. Rows that
    are equal in all of them lie in one task, so ``order`` should tell rows apart."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialized(placed, "ordered").withColumn("_part", F.shiftright("_at", _PLACE_BITS))
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select("_part", F.coalesce(earlier, F.lit(0)).alias("_start"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.join(starts, "_part").withColumn(alias, F.col("_start") + inside).drop("_part", "_at", "_start")


def running_totals(rows: DataFrame, keys: Sequence[str], order: str, amounts: Mapping[str, Column], bits: int = SLICE_BITS) -> DataFrame:
    """Add for each of ``amounts`` its sum up to and including a row, by ``order`` within ``keys``
    (none: over all rows). ``order`` is a whole number, unique within ``keys``: stretches of
    ``2 ** bits`` of it are summed apart, and one row a stretch carries what came before."""
    sliced = rows.withColumn("_slice", F.shiftright(F.col(order).cast("long"), bits)).withColumns({f"_own_{a}": c for a, c in amounts.items()})
    sums = sliced.groupBy(*keys, "_slice").agg(*[F.sum(f"_own_{a}").alias(f"_sum_{a}") for a in amounts])
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(*keys, "_slice", *[F.coalesce(F.sum(f"_sum_{a}").over(before), F.lit(0)).alias(f"_before_{a}") for a in amounts])
    upto = Window.partitionBy(*keys, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = sliced.withColumns({f"_own_{a}": F.sum(f"_own_{a}").over(upto) for a in amounts}).join(carried, [*keys, "_slice"])
    return inside.withColumns({a: F.col(f"_own_{a}") + F.col(f"_before_{a}") for a in amounts}).drop("_slice", *[f"{p}_{a}" for a in amounts for p in ("_own", "_before")])
