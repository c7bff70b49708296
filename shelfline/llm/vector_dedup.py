"""Near duplicates among embeddings: an exact metric range join.

On unit vectors a cosine of at least ``c`` is a distance of at most ``sqrt(2 - 2c)``. Pivots cut each
label into cells, every vector belongs to its nearest pivot, and by the triangle inequality only
vectors close enough to a boundary can have a partner beyond it: those are copied to the cells on its
other side. Cells are then joined independently, block by block, so that no task's work grows with a
dense cell. Equal vectors are one node; within a task links are counted and reduced to a spanning
forest, never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import map_arrow, materialized
from shelfline.llm.graph import components, stars
from shelfline.llm.vectors import matrix, packed, units
from shelfline.plans.lookup import lookup_join

#: Vectors of a label for each pivot, about, and of a block of a cell.
CELL = 1024
#: Pivots at most, over all labels: they are sent to every task. With more vectors, cells have more blocks.
MOST_PIVOTS = 2048
STEP = 512


def _pivots(classes: DataFrame, cell: int, most: int) -> dict[int, np.ndarray]:
    """Unit pivots by label: vectors drawn by hash, one for every ``cell`` or fewer."""
    wanted = min(most, -(-classes.count() // cell))
    drawn = classes.orderBy(F.xxhash64("rep", F.lit(4))).limit(wanted).select("label", "vector").collect()
    by_label: dict[int, list] = {}
    for r in drawn:
        by_label.setdefault(r["label"], []).append(bytes(r["vector"]))
    return {k: np.concatenate([units(matrix([v])) for v in vs]) for k, vs in by_label.items() if len({len(v) for v in vs}) == 1}


def _placed(classes: DataFrame, pivots: dict[int, np.ndarray], reach: float) -> DataFrame:
    """``label, cell, home, rep, weight, vector``: every vector in its cell, and in those cells of a
    lower number that it may have partners in. Each pair of cells is so joined in one of them."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            vectors = batch.column("vector").to_pylist()
            row, cell, home = [], [], []
            for label in np.unique(labels).tolist():
                own = np.flatnonzero(labels == label)
                p = pivots.get(label)
                fits = np.array([p is not None and len(vectors[i]) == 8 * p.shape[1] for i in own])
                row.append(own[~fits])
                cell.append(np.zeros(int((~fits).sum()), np.int64))
                home.append(np.ones(int((~fits).sum()), bool))
                own = own[fits]
                if not len(own):
                    continue
                d = np.sqrt(np.maximum(2 - 2 * units(matrix(vectors[i] for i in own)) @ p.T, 0))
                at = d.argmin(1)
                nearest = d[np.arange(len(own)), at][:, None]
                apart = np.sqrt(np.maximum(2 - 2 * p @ p.T, 0))[at]
                # Triangle inequality, and the distance to the boundary plane between two pivots.
                near = (d <= nearest + 2 * reach) & (d * d - nearest * nearest <= 2 * reach * apart + 1e-9)
                near &= np.arange(len(p))[None, :] < at[:, None]
                i, j = np.nonzero(near)
                row += [own, own[i]]
                cell += [at, j]
                home += [np.ones(len(own), bool), np.zeros(len(i), bool)]
            row = np.concatenate(row) if row else np.zeros(0, np.int64)
            taken = batch.take(pa.array(row, pa.int64()))
            columns = [taken.column(c) for c in ("label", "rep", "weight", "vector")]
            columns += [pa.array(np.concatenate(c) if c else [], k) for c, k in ((cell, pa.int64()), (home, pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "rep", "weight", "vector", "cell", "home"])

    chosen = classes.select("label", "rep", "weight", "vector")
    return map_arrow(chosen, place, "label bigint, rep bigint, weight bigint, vector binary, cell bigint, home boolean")


def _grid(placed: DataFrame, block: int) -> DataFrame:
    """Each cell's rows dealt into tasks: a block of its own vectors against another such block, or
    against a block of the vectors copied to it."""
    counts = placed.groupBy("label", "cell").agg(F.sum(F.col("home").cast("int")).alias("h"), F.sum((~F.col("home")).cast("int")).alias("g"))
    blocks = [F.ceil(F.col(c) / block).cast("int").alias(f"{c}n") for c in ("h", "g")]
    rows = lookup_join(placed, counts.where("h > 0").select("label", "cell", *blocks), ["label", "cell"], "inner")
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("home"), F.col("hn")).otherwise(F.greatest("gn", F.lit(1)))).cast("int")
    rows = rows.withColumn("own", own)
    homes = F.transform(F.sequence(F.lit(0), F.col("hn") - 1), lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j"), F.when(k == F.col("own"), 0).when(k > F.col("own"), 1).otherwise(2).alias("side")))
    guests = F.transform(F.sequence(F.lit(0), F.col("gn") - 1), lambda k: F.struct(F.col("own").alias("i"), (-1 - k).alias("j"), F.lit(1).alias("side")))
    guests = F.when(F.col("gn") > 0, guests).otherwise(F.array().cast("array<struct<i:int,j:int,side:int>>"))
    visits = F.transform(F.sequence(F.lit(0), F.col("hn") - 1), lambda k: F.struct(k.alias("i"), (-1 - F.col("own")).alias("j"), F.lit(2).alias("side")))
    dealt = rows.withColumn("task", F.explode(F.when(F.col("home"), F.concat(homes, guests)).otherwise(visits)))
    return dealt.select("label", "cell", "task.i", "task.j", "task.side", "rep", "weight", "vector")


def _joined(grid: DataFrame, cosine: float) -> DataFrame:
    """``rep, n, root``: a row with ``n``, the linked vectors a task found for ``rep``, or with
    ``root``, a node in the same component."""

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        found, left, right = [], [], []
        width = frame["vector"].map(len)
        for _, part in frame.groupby(width, sort=False):
            same = (part["side"] == 0).any()
            one = part[part["side"] != 2]
            other = one if same else part[part["side"] == 2]
            if not len(one) or not len(other):
                continue
            x, y = matrix(one["vector"]), matrix(other["vector"])
            u, v = units(x), units(y)
            a, b, m, n = one["rep"].to_numpy(), other["rep"].to_numpy(), one["weight"].to_numpy(), other["weight"].to_numpy()
            ones, others = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            for at in range(0, len(a), STEP):
                near = u[at : at + STEP] @ v.T
                link = near >= cosine
                for i, j in zip(*np.nonzero(np.abs(near - cosine) < 1e-12), strict=True):
                    # On the edge rounding decides: the plain formula does.
                    p, q = x[at + i], y[j]
                    link[i, j] = float(p @ q) / float(np.linalg.norm(p) * np.linalg.norm(q)) >= cosine
                link &= a[at : at + STEP, None] != b[None, :]
                ones[at : at + STEP] += link @ n
                if not same:
                    others += m[at : at + STEP] @ link
                i, j = np.nonzero(link)
                leaf, root = stars(a[at + i], b[j])
                left.append(leaf)
                right.append(root)
            found.append(pd.DataFrame({"rep": np.concatenate([a, b]) if not same else a, "n": np.concatenate([ones, others]) if not same else ones}))
        counts = pd.concat(found, ignore_index=True) if found else pd.DataFrame({"rep": [], "n": []})
        counts = counts[counts["n"] > 0]
        leaf, root = stars(np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2
        out = pd.concat([counts.assign(root=None), pd.DataFrame({"rep": leaf, "n": None, "root": root})], ignore_index=True)
        return out.astype({"rep": "int64", "n": "Int64", "root": "Int64"})

    return grid.groupBy("label", "cell", "i", "j").applyInPandas(join, "rep bigint, n bigint, root bigint")


def near_duplicates(
    rows: DataFrame, cosine: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    cell: int = CELL, most_pivots: int = MOST_PIVOTS,
) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row.

    Two vectors are linked when their labels are equal and not null and their cosine, in double
    precision, is at least ``cosine``. Null, empty and zero vectors, those with null or non-finite
    numbers, and rows without label are linked with nothing; vectors of different width neither.
    Equal vectors are linked with each other. A row without key is linked with nothing, has no
    component and is kept. Rows that share a key and a vector are links of each other's. Keys and
    labels are whole numbers.
    """
    named = rows.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    held = materialized(packed(named, "vector"), "vectors")
    usable = held.where("key is not null and label is not null and vector is not null")
    # Minus zero equals zero: those differ in their bytes only, and are linked as near vectors are.
    classes = usable.groupBy("label", "vector").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("weight"))
    classes = materialized(classes, "classes")
    pivots = _pivots(classes, cell, most_pivots)
    reach = float(np.sqrt(max(2 - 2 * cosine, 0))) + 1e-9
    placed = materialized(_placed(classes, pivots, reach), "cells")
    found = materialized(_joined(_grid(placed, cell), cosine), "joined")
    degrees = found.where("n is not null").groupBy("rep").agg(F.sum("n").alias("n"))
    joined = components(found.where("root is not null").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = lookup_join(classes.select("label", "vector", "rep", "weight"), degrees, "rep")
    known = lookup_join(known, joined.toDF("rep", "component"), "rep")
    known = known.select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    told = lookup_join(held, known, ["label", "vector"])
    usable = F.col("key").isNotNull()
    component = F.when(usable, F.coalesce("component", "key"))
    links = F.when(usable, F.coalesce("n_links", F.lit(0))).otherwise(0)
    kept = F.coalesce(F.col("key") == component, F.lit(True))
    return told.select(F.col("key").alias(key), links.alias("n_links"), component.alias("component_id"), kept.alias("kept"))
