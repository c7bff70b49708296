"""Ranking a linked list whose items are spread over a table.

A list of ``id, next, weight`` is shortened level by level: tasks take items together, run along what
lies in their hands, and leave one item for every stretch, with the stretch's weight. Which items
meet changes from level to level: first those with neighbouring ids, then an item and its successor
whenever a coin of the level falls 0 for the one and 1 for the other, a quarter of the list on
average. When the rest fits one bounded piece it is ranked there, and the levels are unrolled: an
item's rank is that of its stretch's first item and its distance from it. Work is in proportion to
the list, whatever its order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import materialized
from shelfline.plans.lookup import lookup_join

#: Items that a task holds at once, and those that are left when the last level ranks them.
CHUNK = 1 << 19
LEVELS = 400
#: What the last item's ``next`` is. Ids are not negative.
END = -1


def stretches(ids: np.ndarray, nexts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every item the first item of its stretch and the distance from there; for those first
    items where the stretch goes on and its whole weight (for others, END and 0)."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    at = np.minimum(np.searchsorted(sorted_ids, nexts), n - 1)
    inside = (sorted_ids[at] == nexts) & (nexts != END)
    successor = order[at]
    up, ahead = np.arange(n), np.zeros(n, np.int64)
    up[successor[inside]], ahead[successor[inside]] = np.flatnonzero(inside), weights[inside]
    first = np.ones(n, bool)
    first[successor[inside]] = False
    for _ in range(n.bit_length()):  # each step doubles how far back an item sees
        ahead += ahead[up]
        up = up[up]
        if first[up].all():
            break
    if not first[up].all():
        raise ValueError("the items form a ring")
    on, total = np.full(n, END, np.int64), np.zeros(n, np.int64)
    last = np.flatnonzero(~inside)
    on[up[last]], total[up[last]] = nexts[last], ahead[last] + weights[last]
    return ids[up], ahead, on, total


def _shortened(items: DataFrame, chunk: int) -> DataFrame:
    """``id, head, ahead, next, weight`` of every item: its stretch within a task, ``chunk`` items at a time."""
    names = ["id", "next", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush() -> pa.RecordBatch:
            ids, nexts, weights = (np.concatenate([h[i] for h in held]) for i in range(3))
            found = stretches(ids, nexts, weights)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (ids, *found)], ["id", "head", "ahead", "next", "weight"])

        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                piece = batch.slice(at, chunk)
                if rows + piece.num_rows > chunk:
                    yield flush()
                    held, rows = [], 0
                held.append([piece.column(c).to_numpy(zero_copy_only=False) for c in names])
                rows += piece.num_rows
        if rows:
            yield flush()

    return items.select(*names).mapInArrow(run, "id bigint, head bigint, ahead bigint, next bigint, weight bigint")


def list_ranks(links: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``id, rank`` of every item of one list ``id, next`` (whole numbers, not negative; the last item's
    ``next`` is -1): how many items come before it. An empty list has no rows."""
    items = links.select(F.col("id").cast("long"), F.col("next").cast("long"), F.lit(1).cast("long").alias("weight"))
    levels = [materialized(_shortened(items.repartitionByRange("id").sortWithinPartitions("id"), chunk), "list")]
    while True:
        items = levels[-1].where("id = head").select("id", "next", "weight")
        if items.count() <= chunk:
            break
        if len(levels) >= LEVELS:
            raise RuntimeError(f"the list did not shorten in {LEVELS} levels")
        coin = lambda c: F.xxhash64(F.col(c), F.lit(len(levels))).bitwiseAND(F.lit(1))  # noqa: E731, B023
        meets = F.when((coin("id") == 0) & (coin("next") == 1) & (F.col("next") != END), F.col("next")).otherwise(F.col("id"))
        met = items.withColumn("_at", meets).repartition("_at").sortWithinPartitions("_at")
        levels.append(materialized(_shortened(met, chunk), "list"))
    last = materialized(_shortened(items.coalesce(1), chunk), "list")
    ranks = last.select("id", F.col("ahead").alias("rank"))
    heads = last.agg(F.count_if(F.col("id") == F.col("head"))).first()[0]
    if heads > 1:
        raise ValueError(f"the items form {heads} lists")
    for level in reversed(levels):
        starts = ranks.withColumnRenamed("id", "head")
        ranks = lookup_join(level.select("id", "head", "ahead"), starts, "head", "inner").select("id", (F.col("rank") + F.col("ahead")).alias("rank"))
        ranks = materialized(ranks, "list")
    return ranks
