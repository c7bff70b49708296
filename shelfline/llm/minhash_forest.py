"""Near duplicates by word shingles: a forest of sorted MinHash signatures.

Every document gets one signature per tree. A tree is the sorted order of its signatures; documents
that share a longer prefix stand closer together. Candidates are found in two rounds:

1. Neighbours in each sorted order with a long enough common prefix. Their links, confirmed on full
   shingle sets, already join most of what belongs together.
2. Regions of a tree, that is documents with one prefix, that still hold several components: what
   is near by signature across components is gathered into families. A region too large for that is
   cut by a deeper prefix, as often as needed; what shares a whole signature and is still too large
   is compared block by block. Families are then compared in full within tasks, again by blocks,
   and only a spanning forest of the links leaves a task: no list of pairs grows with a family.
   Blocks of a family's largest component meet those of its other components only.

The number of trees and the depth make a link between two documents at the threshold a candidate
with a probability of ``1 - (1 - J^depth)^trees``. Below 0.85, documents of large regions get further
trees, so that cutting those misses no more links. A node is a shingle set, whichever rows hold
it; keys come in last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import by_bytes, map_arrow, materialized
from shelfline.llm.graph import components, stars
from shelfline.plans.lookup import lookup_join

WORDS = 5
TREES, DEPTH = 24, 8
#: Prefixes of this many values make a region; then deeper ones where regions are large. Above 2^24
#: documents the first is longer, so that chance does not fill regions.
DEPTHS = (4, 6, 8)
#: A link at this many percent is missed under whole signatures of all trees as rarely as is allowed.
SURE = 85
#: Documents of a region, or of one block of it, compared within one task.
REGION = 512
#: Documents and shingles of a block of a family, about.
FAMILY, FAMILY_SHINGLES = 256, 400_000
#: Shingles whose documents are multiplied at once.
COLUMNS = 4096
#: Standard deviations below the threshold at which a signature still counts as near.
MARGIN = 5.0
BATCH_BYTES = 4 << 20
#: Neighbouring words in one hash: an odd multiplier.
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingles of every text, one text after the other, and where each ends.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text with fewer than
    ``words`` words is one shingle; one without words, or null, has none.
    """
    texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = parts.values.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    lengths = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy()
    real = lengths[codes] > 0 if len(codes) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(real)])[parts.offsets.to_numpy()]
    h = hashes[codes[real]] if len(codes) else np.zeros(0, np.uint64)
    rolled = np.zeros(len(h), np.uint64)
    for i in range(words):
        rolled *= _STEP
        rolled[: max(0, len(h) - i)] += h[i:]
    rolled = _mixed(rolled)
    found, sizes = [], np.zeros(n, np.int64)
    for t in range(n):
        begin, end = int(ends[t]), int(ends[t + 1])
        if end - begin >= words:
            own = np.unique(rolled[begin : end - words + 1])
        elif end > begin:
            whole = np.uint64(end - begin)
            for w in h[begin:end]:
                whole = np.uint64((int(whole) * int(_STEP) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            own = _mixed(np.array([whole]))
        else:
            continue
        found.append(own)
        sizes[t] = len(own)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), np.cumsum(sizes)


def signatures(shingles: np.ndarray, ends: np.ndarray, count: int = TREES * DEPTH, seed: int = 20) -> np.ndarray:
    """``count`` MinHash values of 8 bits for every non-empty set."""
    begins = np.concatenate([[0], ends[:-1]])
    starts = begins[ends > begins]
    rng = np.random.default_rng(seed)
    flips, factors = rng.integers(0, 1 << 32, count, np.uint32), rng.integers(0, 1 << 32, count, np.uint32) | np.uint32(1)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    buffer, out = np.empty_like(x), np.empty((len(starts), count), np.uint8)
    for i in range(count):
        np.bitwise_xor(x, flips[i], out=buffer)
        np.multiply(buffer, factors[i], out=buffer)
        # The smallest are all small numbers: spread them before taking 8 bits.
        out[:, i] = (np.minimum.reduceat(buffer, starts) * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out


def _marks(rows: DataFrame, words: int) -> DataFrame:
    """``key, n_shingles, print, sig``: size, fingerprint and signature of every row's set."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            shingles, ends = shingle_sets(batch.column("text"), words)
            sizes = np.diff(np.concatenate([[0], ends]))
            prints = _prints(shingles, ends)
            sigs, empty = iter(signatures(shingles, ends).view(">i8").astype(np.int64)) if len(shingles) else iter(()), sizes == 0
            columns = [batch.column("key"), pa.array(sizes), pa.array(prints, pa.binary()), pa.array([None if e else next(sigs) for e in empty], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_shingles", "print", "sig"])

    return map_arrow(rows, mark, "key bigint, n_shingles bigint, print binary, sig array<bigint>")


def _prints(shingles: np.ndarray, ends: np.ndarray) -> list[bytes | None]:
    """A fingerprint of every set; none of an empty one."""
    return [xxhash.xxh3_128_digest(s) if len(s) else None for s in np.split(shingles, ends[:-1])] if len(ends) else []


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """``print, shingles``: the full set of every row."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            shingles, ends = shingle_sets(batch.column("text"), words)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(shingles.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(_prints(shingles, ends), pa.binary()), lists], ["print", "shingles"])

    return map_arrow(rows, build, "print binary, shingles array<bigint>")


def _depths(documents: int) -> tuple[int, ...]:
    """The prefixes for so many documents: values have 8 bits, and one more than it takes to number
    the documents keeps strangers apart."""
    first = min(DEPTH, max(DEPTHS[0], -(-max(documents - 1, 1).bit_length() // 8) + 1))
    return (first, *[d for d in DEPTHS if d > first])


def _further(percent: int) -> int:
    """How many trees more than ``TREES`` it takes until a link at ``percent`` is missed under whole
    signatures no more often than one at ``SURE`` in ``TREES``."""
    if percent >= SURE:
        return 0
    return math.ceil(TREES * math.log1p(-((SURE / 100) ** DEPTH)) / math.log1p(-((percent / 100) ** DEPTH))) - TREES


def _further_trees(members: DataFrame, sets: DataFrame, count: int) -> DataFrame:
    """``key, component, tree, bits``: ``count`` more trees of the documents ``key, component``."""
    rows = lookup_join(members, sets.where(F.size("shingles") > 0).select("key", "shingles"), "key", "inner")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("shingles")
            shingles = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            sigs = signatures(shingles, ends, count * DEPTH, seed=21).view(">i8").astype(np.int64)
            columns = [batch.column("key"), batch.column("component"), pa.array(list(sigs), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "component", "sig"])

    marked = map_arrow(rows.select("key", "component", "shingles"), mark, "key bigint, component bigint, sig array<bigint>")
    marked = marked.select("key", "component", F.posexplode("sig").alias("tree", "bits"))
    return marked.select("key", "component", (F.col("tree") + TREES).alias("tree"), "bits")


def _neighbours(trees: DataFrame, depth: int) -> DataFrame:
    """``a, b``: neighbours in the sorted order of each tree that share the shortest prefix.

    The order is cut into even ranges, however many signatures are alike; the last row of a range and
    the first of the next are put side by side afterwards.
    """
    mask = np.uint64(0xFFFFFFFFFFFFFFFF) << np.uint64(8 * (DEPTH - depth))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None

        def made(a, b, tree, bits, edge):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in ((a, pa.int64()), (b, pa.int64()), (tree, pa.int32()), (bits, pa.int64()), (edge, pa.bool_()))], ["a", "b", "tree", "bits", "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, tree, bits = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "tree", "bits"))
            if last is None:
                first = (key[0], tree[0], bits[0])
            else:
                key, tree, bits = (np.concatenate([[x], c]).astype(c.dtype) for x, c in zip(last, (key, tree, bits), strict=True))
            last = (key[-1], tree[-1], bits[-1])
            raw = bits.view(np.uint64)
            near = (tree[1:] == tree[:-1]) & (((raw[1:] ^ raw[:-1]) & mask) == 0) & (key[1:] != key[:-1])
            none = np.zeros(int(near.sum()), np.int64)
            yield made(key[:-1][near], key[1:][near], none, none, np.zeros(len(none), bool))
        if last is not None:
            ends = [first, last]
            yield made([e[0] for e in ends], [0, 1], [e[1] for e in ends], [e[2] for e in ends], [True, True])

    found = trees.repartitionByRange("tree", _unsigned("bits"), "key").sortWithinPartitions("tree", _unsigned("bits"), "key")
    found = materialized(map_arrow(found, scan, "a bigint, b bigint, tree int, bits bigint, edge boolean"), "neighbours")
    # Two rows for every range: few, whatever the number of documents.
    line = Window.orderBy("tree", _unsigned("bits"), "a", "b")
    before = [F.lag(c).over(line).alias(f"_{c}") for c in ("a", "tree", "bits")]
    edges = found.where("edge").select("a", "tree", "bits", *before)
    same = (F.col("tree") == F.col("_tree")) & (_prefix("bits", depth) == _prefix("_bits", depth)) & (F.col("a") != F.col("_a"))
    return found.where(~F.col("edge")).select("a", "b").unionByName(edges.where(same).select("a", F.col("_a").alias("b")))


def _unsigned(column: str) -> Column:
    """Signed numbers in the order of their bits."""
    return F.col(column).bitwiseXOR(F.lit(-(1 << 63)))


def _prefix(column: str, depth: int) -> Column:
    return F.shiftrightunsigned(F.col(column), 8 * (DEPTH - depth))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _similar(sig: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Whether two signatures agree in as many values as links at the threshold surely do."""
    equal = (sig[i] == sig[j]).mean(1)
    return (equal - 1 / 256) / (1 - 1 / 256) >= least


def _least(threshold: float) -> float:
    return threshold - MARGIN * (threshold * (1 - threshold) / (TREES * DEPTH)) ** 0.5


def _near(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs whose sizes and signatures allow a link."""
    least = _least(threshold)
    one = classes.select("rep", "n_shingles", "sig")
    both = lookup_join(pairs, one.toDF("a", "an", "asig"), "a", "inner")
    both = both.where(F.col("an") > 0)
    both = lookup_join(both, one.toDF("b", "bn", "bsig"), "b", "inner")
    both = both.where(F.least("an", "bn") >= F.lit(threshold) * F.greatest("an", "bn") - 1e-9)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sig = np.concatenate([_bytes(batch.column(c)) for c in ("asig", "bsig")])
            mask = pa.array(_similar(sig, np.arange(n), np.arange(n, 2 * n), least))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(mask) for c in ("a", "b")], ["a", "b"])

    return map_arrow(both.select("a", "b", "asig", "bsig"), keep, "a bigint, b bigint")


def _bytes(sigs: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(sigs.flatten().to_numpy(zero_copy_only=False)).view(np.uint8).reshape(len(sigs), TREES * DEPTH)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have ``100 * intersection >= percent * union``."""
    both = lookup_join(pairs, sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a", "inner")
    both = lookup_join(both, sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b", "inner")
    shared = F.size(F.array_intersect("x", "y"))
    measured = both.select("a", "b", shared.alias("_i"), (F.size("x") + F.size("y")).alias("_n"))
    return measured.where(100 * F.col("_i") >= percent * (F.col("_n") - F.col("_i"))).select("a", "b")


def _cells(trees: DataFrame, depths: tuple[int, ...], region: int, sets: DataFrame, further: int) -> DataFrame:
    """``cell, side, key, component, sig``: the documents to be compared with each other, no more
    than ``region`` (two blocks of it) a cell. A region is looked at only while it holds several
    components; ``side`` tells two different blocks apart and is -1 where all are compared. What is
    in large regions goes into ``further`` trees before it is cut. Of what is cut into blocks, the
    largest component is one thing already: a document of it is there once for each block of the rest."""
    made, rows = [], trees
    for depth in depths:
        rows = rows.withColumn("prefix", F.struct("tree", _prefix("bits", depth).alias("p")))
        if depth < depths[-1]:
            held = rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
            held = held.where("lo <> hi").select("prefix", "n")
        else:
            parts = rows.groupBy("prefix", "component").agg(F.count(F.lit(1)).alias("n"))
            held = parts.groupBy("prefix").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("main")).where("n > main.n")
        # Written: what is near here and what is cut deeper both come from it.
        rows = materialized(lookup_join(rows, held, "prefix", "inner"), "regions")
        cell = F.struct(F.lit(depth).alias("depth"), "prefix", F.lit(0).alias("i"), F.lit(0).alias("j"))
        made.append(rows.where(F.col("n") <= region).select(cell.alias("cell"), F.lit(-1).alias("side"), "key", "component", "tree"))
        large = rows.where(F.col("n") > region)
        rows = large.drop("n", "main", "prefix")
        if further and depth == depths[0]:
            # Written first: where few regions are large, the sets need not move for them.
            members = materialized(rows.select("key", "component").distinct(), "large")
            rows = rows.unionByName(materialized(_further_trees(members, sets, further), "further"))
    # Blocks of the largest component come after those of the rest and meet these alone.
    rests, mains = (F.ceil(n / region).cast("int") for n in (F.col("n") - F.col("main.n"), F.col("main.n")))
    large, in_main, hashed = large.withColumns({"rests": rests, "mains": mains}), F.col("component") == F.col("main.component"), F.xxhash64("key")
    own = F.when(in_main, F.col("rests") + F.pmod(hashed, "mains")).otherwise(F.pmod(hashed, "rests")).cast("int")
    meets = F.sequence(F.lit(0), F.when(in_main, F.col("rests")).otherwise(F.col("rests") + F.col("mains")) - 1)
    cut = large.withColumn("own", own).withColumn("other", F.explode(meets))
    cell = F.struct(F.lit(DEPTH + 1).alias("depth"), "prefix", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    side = F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int"))
    made.append(cut.select(cell.alias("cell"), side.alias("side"), "key", "component", "tree"))
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out.withColumn("cell", F.xxhash64("cell", F.lit(1)))


def _across(cells: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: which documents of a cell are connected by near pairs of different components, as
    stars. Cells lie next to each other in sorted
    partitions; a batch compares whole cells, the last one waits for the next batch. A pair that an
    earlier tree holds under a whole signature was found there."""
    least = _least(threshold)
    rows = lookup_join(cells, classes.select(F.col("rep").alias("key"), "n_shingles", "sig"), "key", "inner")
    rows = rows.repartition("cell").sortWithinPartitions("cell", "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cell, side, key, component, tree, size, sig):
            lists, n = [], len(cell)
            reach = np.searchsorted(cell, cell, side="right") - np.arange(n)
            trees_of = sig.reshape(n, TREES, DEPTH)
            for step in range(1, int(reach.max())):
                i = np.flatnonzero(reach > step)
                j = i + step
                ok = (component[i] != component[j]) & ((side[i] < 0) | (side[i] != side[j]))
                ok &= np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
                i, j = i[ok], j[ok]
                ok = _similar(sig, i, j, least)
                i, j = i[ok], j[ok]
                whole = (trees_of[i] == trees_of[j]).all(2)
                earlier = np.where(whole.any(1), whole.argmax(1), TREES) < tree[i]
                lists.append((key[i[~earlier]], key[j[~earlier]]))
            a, b = (np.concatenate([x[k] for x in lists]) if lists else np.zeros(0, np.int64) for k in (0, 1))
            a, b = stars(a, b)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        rest = None
        for batch in batches:
            part = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "side", "key", "component", "tree", "n_shingles")]
            part.append(_bytes(batch.column("sig")))
            part = part if rest is None else [np.concatenate(x) for x in zip(rest, part, strict=True)]
            if not len(part[0]):
                continue
            whole = int(np.searchsorted(part[0], part[0][-1]))
            if whole:
                yield found(*[x[:whole] for x in part])
            rest = [x[whole:] for x in part]
        if rest is not None and len(rest[0]):
            yield found(*rest)

    wanted = rows.select("cell", "side", "key", "component", "tree", "n_shingles", "sig")
    return map_arrow(wanted, compare, "a bigint, b bigint")


def _linked(keys: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among documents by their full sets, as stars. Shingles that several documents have are
    the columns of a 0/1 matrix; its product with itself counts what two documents share."""
    n, sizes = len(keys), np.array([len(s) for s in sets])
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(held > 1) - 1
    row, column = np.repeat(np.arange(n), sizes)[held[column] > 1], number[column[held[column] > 1]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((n, n), np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [begin, begin + COLUMNS]))
        incidence = np.zeros((n, COLUMNS), np.float32)
        incidence[row[part], column[part] - begin] = 1
        shared += incidence @ incidence.T
    shared = shared.astype(np.int64)
    i, j = np.nonzero(np.triu(100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared), 1))
    return stars(keys[i], keys[j])


def _blocks(n: Column, shingles: Column) -> Column:
    """How many blocks so many documents, with so many shingles, make."""
    return F.ceil(F.greatest(n / FAMILY, shingles / FAMILY_SHINGLES)).cast("int")


def _meetings(families: DataFrame) -> DataFrame:
    """``key, task``: where each document of ``key, family, component, n_shingles`` is compared, as a
    struct of ``family, i, j``. A family of one block shares a task with others. Of a larger one, the
    blocks of its largest component are one thing already: they meet the blocks of the rest, and those
    also each other. So a family whose rest is one block moves twice its rows, however large it is."""
    parts = families.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    sizes = parts.groupBy("family").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max(F.struct("n", "s", "component")).alias("main"))
    rest = _blocks(F.col("n") - F.col("main.n"), F.col("s") - F.col("main.s"))
    sizes = sizes.select("family", "n", "s", "main.component", _blocks(F.col("n"), F.col("s")).alias("blocks"), _blocks(F.col("main.n"), F.col("main.s")).alias("mains"), rest.alias("rests"))
    sizes = materialized(sizes.withColumnRenamed("component", "main"), "families")
    small = sizes.where("blocks = 1").agg(F.sum("n"), F.sum("s")).first()
    bins = max(1, -(-(small[0] or 0) // FAMILY), -(-(small[1] or 0) // FAMILY_SHINGLES))
    rows = lookup_join(families, sizes.select("family", "main", "blocks", "mains", "rests"), "family", "inner")

    def tasks(first: Column, count: Column, meet) -> Column:
        return F.when(count > 0, F.transform(F.sequence(first, first + count - 1), meet)).otherwise(F.array().cast("array<struct<family:bigint,i:int,j:int>>"))

    def task(i: Column, j: Column) -> Column:
        return F.struct(F.col("family").alias("family"), i.cast("int").alias("i"), j.cast("int").alias("j"))

    zero, hashed = F.lit(0), F.xxhash64("key")
    alone = F.array(F.struct(F.lit(-1).cast("long").alias("family"), F.lit(-1).alias("i"), F.pmod(F.xxhash64("family"), F.lit(bins)).cast("int").alias("j")))
    in_main, in_rest = F.pmod(hashed, "mains").cast("int"), F.pmod(hashed, F.greatest("rests", F.lit(1))).cast("int")
    of_main = tasks(zero, F.col("rests"), lambda k: task(k, F.col("rests") + in_main))
    with_rest = F.filter(tasks(zero, F.col("rests"), lambda k: task(F.least(k, in_rest), F.greatest(k, in_rest))), lambda t: t["i"] < t["j"])
    with_main = tasks(F.col("rests"), F.col("mains"), lambda k: task(in_rest, k))
    meets = F.when(F.col("blocks") == 1, alone).when(F.col("component") == F.col("main"), of_main).otherwise(F.concat(with_rest, with_main))
    return rows.select("key", meets.alias("tasks"))


def _within_families(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links among the documents of each family (``key, family, component, n_shingles``)
    between different components, as stars per task."""
    rows = lookup_join(materialized(_meetings(families), "meetings"), sets.select("key", "shingles"), "key", "inner")
    rows = rows.select("key", F.explode("tasks").alias("task"), "shingles").select("task.family", "task.i", "task.j", "key", "shingles")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = _linked(frame["key"].to_numpy(), [np.asarray(s) for s in frame["shingles"]], percent)
        return pd.DataFrame({"a": a, "b": b})

    return rows.groupBy("family", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, words: int = WORDS, region: int = REGION
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row of ``docs``.

    Two documents are linked when their shingle sets have ``100 * intersection >= percent * union``;
    ``component_id`` is the smallest key reachable by links, ``kept`` whether that is the row's own.
    Rows without words, and null texts, have no shingles and are linked with nothing, their component
    is their key. Keys are whole numbers; a row without key has no component and is kept. Rows that
    share a key are one document of several texts: links of any of them are links of the document.
    Other columns are not read.
    """
    threshold = percent / 100
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    marks = materialized(_marks(rows, words), "marks")
    known = marks.where("key is not null and print is not null")
    classes = known.groupBy("print").agg(F.min("key").alias("least"), F.min(F.struct("n_shingles", "sig")).alias("m"))
    # Numbers name the sets: no two share one, as keys or shorter fingerprints might.
    classes = materialized(classes.select("print", F.monotonically_increasing_id().alias("rep"), "least", "m.n_shingles", "m.sig"), "classes")
    placed = lookup_join(marks.select("key", "n_shingles", "print"), classes.select("print", "rep", "least"), "print")
    placed = materialized(placed.select("key", "n_shingles", "rep", "least"), "placed")

    trees = classes.select(F.col("rep").alias("key"), F.posexplode("sig").alias("tree", "bits"))
    # Everything that has a partner at all has one next to it.
    depths = _depths(classes.count())
    pairs = materialized(_ordered(_neighbours(trees, depths[0])), "pairs")
    some = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    some = materialized(lookup_join(classes, some, "rep", "left_semi"), "candidates")
    near = materialized(_near(pairs, classes, threshold), "near")
    # Keys alone, written first: while they are few, the texts need not move for them.
    wanted = materialized(some.select(F.col("least").alias("key")).distinct(), "wanted")
    sets = _sets(lookup_join(rows, wanted, "key", "left_semi"), words)
    # One row a set on both sides: no key of this join is hot.
    sets = sets.where("print is not null").dropDuplicates(["print"]).join(some.select("print", F.col("rep").alias("key")), "print")
    sets = materialized(sets.select("key", "shingles"), "sets")
    links = materialized(_confirmed(near, sets, percent).unionByName(_same_key(placed)), "links")
    joined = components(links)

    grown = lookup_join(some.select(F.col("rep").alias("key"), "n_shingles", "sig"), joined.toDF("key", "component"), "key")
    grown = materialized(grown.withColumn("component", F.coalesce("component", "key")), "grown")
    forest = grown.select("key", "component", F.posexplode("sig").alias("tree", "bits"))
    cells = _cells(materialized(forest, "forest"), depths, region, sets, _further(percent))
    families = materialized(components(_across(cells, classes, threshold)).toDF("key", "family"), "members")
    families = lookup_join(grown.select("key", "component", "n_shingles"), families, "key", "inner")
    more = materialized(_within_families(families, sets, percent), "more")
    joined = materialized(components(links.unionByName(more)).toDF("rep", "component"), "components")

    least = lookup_join(joined, classes.select("rep", "least"), "rep", "inner").groupBy("component").agg(F.min("least").alias("smallest"))
    named = materialized(lookup_join(joined, least, "component", "inner").select("rep", "smallest"), "named")
    found = lookup_join(placed, named, "rep")
    component = F.when(F.col("key").isNotNull(), F.coalesce("smallest", "least", "key"))
    kept = F.coalesce(F.col("key") == component, F.lit(True))
    return found.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _same_key(placed: DataFrame) -> DataFrame:
    """``a, b``: the sets of a key that has several, as a star."""
    held = placed.where("key is not null and rep is not null")
    several = held.groupBy("key").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b <> last").select("key", "b")
    several = materialized(several, "several")
    return lookup_join(held.select("key", F.col("rep").alias("a")), several, "key", "inner").where("a <> b").select("a", "b").distinct()
