"""Mixing sources to target token weights by entropy balancing.

Of all document rates that give every source its target of tokens, the mix takes those nearest to
"each document once" in relative entropy, with tokens as base measure. They are exponentially tilted:
the rate of a document is ``exp`` of the sum of the dual variables of the groups it belongs to. The
dual is convex; Newton steps solve it on the token totals of the groups, all in DataFrames. Rates are
rounded into copies; a hash decides who gets one more, and what this leaves of a source's target is
evened out with its shortest documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import materialized
from shelfline.plans.lookup import lookup_join

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
STEPS = 40
TOLERANCE = 1e-9


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``group, source_size, target`` from ``group, source_size``, one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` times all sizes;
    no target is above ``cap`` times its source's size, the rest reshared by weight. The sources
    that stop at the cap are those with the smallest size for their weight, so one pass in that
    order finds the price of a weight at which the others share what is left.
    """
    everyone = Window.orderBy(F.col("group").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(everyone) - 1) % len(weights) + 1)
    ranked = sizes.withColumn("_weight", weight).withColumn("_most", F.lit(cap) * F.col("source_size"))
    line = Window.orderBy(F.col("_most") / F.col("_weight"), F.col("group").asc_nulls_last())
    before, after = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))
    priced = ranked.withColumn("_price", left / F.sum("_weight").over(after))
    free = F.when(F.col("_most") / F.col("_weight") > F.col("_price"), F.col("_price"))
    shared = priced.withColumn("_shared", F.max(free).over(whole) * F.col("_weight"))
    return shared.select("group", "source_size", F.least("_most", F.coalesce("_shared", "_most")).alias("target"))


def balance(goals: DataFrame, tolerance: float = TOLERANCE, steps: int = STEPS) -> DataFrame:
    """``goals`` (``group, source_size, target``) with ``dual``, the tilt of each group's documents.

    The dual function has the gradient ``target - tokens`` and, as a document is in one group, the
    Hessian ``-tokens`` on its diagonal, ``tokens = source_size * exp(dual)``. A Newton step is the
    quotient, held to two so that far targets are reached safely. Stops when every group is within
    ``tolerance`` of its target.
    """
    tokens = F.col("source_size") * F.exp("dual")
    gap = F.when((F.col("target") > 0) & (F.col("source_size") > 0), (F.col("target") - tokens) / tokens)
    current = materialized(goals.withColumn("dual", F.lit(0.0)), "duals")
    for _ in range(steps):
        if (current.agg(F.max(F.abs(gap))).first()[0] or 0.0) <= tolerance:
            break
        step = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), gap))
        current = materialized(current.withColumn("dual", F.col("dual") + F.coalesce(step, F.lit(0.0))), "duals")
    return current


def _bucket() -> Column:
    return F.shiftrightunsigned("draw", 56)


def _switchable() -> Column:
    """Documents whose further copy, or its absence, may be switched for what their source is short of."""
    fit = (F.col("size") > 0) & (F.col("size") <= F.abs("short")) & (F.col("more") == (F.col("short") < 0))
    return fit & ((F.col("short") < 0) | F.col("may"))


def _drawn(rows: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """``rows`` (``key, group, size`` and any others) with the columns of ``sources``, ``least`` copies,
    ``more`` (one more by the draw), ``may`` (it is allowed one more) and ``draw``."""
    rated = lookup_join(rows.withColumn("gk", F.struct(F.col("group").alias("g"))), sources, "gk")
    rate = F.least(F.exp("dual"), F.lit(float(cap)))
    rate = F.when(F.col("target") > 0, rate).otherwise(0.0)
    unit = F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53))
    rated = rated.withColumn("rate", rate).withColumn("draw", F.xxhash64("key", "size")).withColumn("least", F.floor("rate"))
    return rated.withColumn("more", unit < F.col("rate") - F.col("least")).withColumn("may", F.col("least") + 1 <= cap)


def planned(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """What decides about copies, one row per source of ``rows`` (``key, group, size``): ``gk,
    source_size, target, dual, short, last_size, edge``.

    Where the draw leaves a source ``short`` (or over), its shortest documents without (with) one more
    copy are switched as long as their sum fits: whole sizes from counts by size, the last size from
    counts by hash, up to ``edge``. Only counts cross the network.
    """
    sizes = rows.groupBy("group").agg(F.sum("size").alias("source_size"))
    goals = balance(targets(sizes, weights, share, cap))
    sources = goals.select(F.struct(F.col("group").alias("g")).alias("gk"), "source_size", "target", "dual")
    got = F.sum(F.col("size") * (F.col("least") + F.col("more").cast("long")))
    short = _drawn(rows, sources, cap).groupBy("gk").agg((F.first("target") - got).alias("short"))
    sources = materialized(lookup_join(sources, short, "gk"), "shortfall")
    told = _drawn(rows, sources, cap)
    counted = told.where(_switchable()).groupBy("gk", "size").agg(F.count(F.lit(1)).alias("n"), F.first("short").alias("short"))
    upto = Window.partitionBy("gk").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    at = counted.withColumn("_before", F.coalesce(F.sum(F.col("size") * F.col("n")).over(upto), F.lit(0)))
    over = at.where(F.col("_before") + F.col("size") * F.col("n") > F.abs("short"))
    last = over.groupBy("gk").agg(F.min(F.struct("size", "_before", "short")).alias("l"))
    last = last.select("gk", F.col("l.size").alias("last_size"), F.floor((F.abs("l.short") - F.col("l._before")) / F.col("l.size")).alias("room"))
    sources = materialized(lookup_join(sources, last, "gk"), "last-size")
    told = _drawn(rows, sources, cap)
    counted = told.where(_switchable() & (F.col("size") == F.col("last_size"))).groupBy("gk", _bucket().alias("b")).agg(F.count(F.lit(1)).alias("n"), F.first("room").alias("room"))
    upto = Window.partitionBy("gk").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = counted.withColumn("_sum", F.sum("n").over(upto)).where(F.col("_sum") <= F.col("room"))
    edge = edge.groupBy("gk").agg(F.max("b").alias("edge"))
    return materialized(lookup_join(sources, edge, "gk").drop("room"), "sources")


def copied(rows: DataFrame, sources: DataFrame, cap: float = CAP) -> DataFrame:
    """``rows`` (``key, group, size`` and any others) with ``source_size``, ``target`` and ``copies``, as
    the :func:`planned` ``sources`` decide: each row on its own, none moves where there are few sources."""
    told = _drawn(rows, sources, cap)
    small = F.col("last_size").isNull() | (F.col("size") < F.col("last_size"))
    some = (F.col("size") == F.col("last_size")) & (_bucket() <= F.coalesce("edge", F.lit(-1)))
    switched = _switchable() & (small | some)
    one = (F.col("more") != F.coalesce(switched, F.lit(False))).cast("long")
    return told.withColumn("copies", F.col("least") + one).select(*rows.columns, "source_size", "target", "copies")


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
) -> DataFrame:
    """``key, size, source_size, target, copies, taken`` for every row of ``docs``.

    ``size`` counts words (0 for null and empty texts), ``taken`` is ``size * copies``. Null sources
    form one group, last in order. No document gets more than ``cap`` copies. Repeated rows are
    documents of their own with the same draw. Draws depend on keys and sizes only, so equal tables give
    equal results however they are split. An empty table gives an empty result.
    """
    rows = sized(docs, key, text, source)
    chosen = copied(rows, planned(rows, weights, share, cap), cap)
    return chosen.select(
        F.col("key").alias(key), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def take(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix` takes them. Rows that share a key share its copies,
    the most any of them has; a row without key stays once. Copies are counted where a row lies, so
    texts move only for keys that several rows have, and only where these are many."""
    rows = sized(docs, key, text, source)
    sources = planned(rows)
    shared = copied(rows, sources).where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("copies").alias("most"))
    shared = materialized(shared.where("n > 1").select("key", "most"), "shared")
    held = docs.select(F.col(key).alias("key"), F.col(source).alias("group"), word_count(F.col(text)).alias("size"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    told = lookup_join(copied(held, sources), shared, "key")
    times = F.when(F.col("key").isNull(), 1).otherwise(F.coalesce("most", "copies")).cast("int")
    taken = told.withColumn("times", times).where("times > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """Sizes of all rows, written once: ``key, group, size``."""
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("group"), word_count(F.col(text)).alias("size"))
    return materialized(rows, "sizes")
