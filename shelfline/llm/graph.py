"""Connected components of a graph given by its links.

Large-star and small-star steps in turn: every node passes its neighbours on to its smallest one
until all components are stars around their smallest node. Before that, tasks contract the links
they hold on their own, which leaves few rounds. Sums are taken before rows move and joins can be
split, so that a node with very many neighbours is no one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import map_arrow, materialized
from shelfline.plans.lookup import lookup_join

CHUNK = 1 << 20
ROUNDS = 60


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links ``a, b`` as stars: every node but the smallest of its component, and that one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:
            further = new[new]
            if (further == new).all():
                break
            new = further
        if (new == root).all():
            break
        root = new
    leaf = root != np.arange(len(nodes))
    return nodes[leaf], nodes[root[leaf]]


def contracted(links: DataFrame) -> DataFrame:
    """Fewer links with the same components, each task on its own and in bounded pieces."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush():
            a, b = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in stars(a, b)], ["a", "b"])

        for batch in batches:
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")])
            rows += batch.num_rows
            if rows >= CHUNK:
                yield flush()
                held, rows = [], 0
        if rows:
            yield flush()

    return map_arrow(links, contract, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b`` (whole numbers): the smallest node
    that can be reached. Links of a node with itself say nothing; no link, no row."""
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    now, before = materialized(contracted(links), "links"), None
    for _ in range(ROUNDS):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = lookup_join(both.where("v > u"), low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        passed = lookup_join(large, low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        now = materialized(low.select(F.col("u").alias("a"), F.col("m").alias("b")).unionByName(passed).distinct(), "links")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
