"""The prefix trie of conversations, summed by an Euler tour.

A node is a distinct sequence of first turns. Its subtree is a stretch of the tour that goes down every
branch and back: each node has an arc that enters it and one that leaves it, and the tour is a linked
list of them, ranked by :mod:`shelfline.llm.listrank`. With running totals along the tour, what a
subtree holds is the total when it is left less that before it is entered; no subtree is gathered.

Only digests, lengths and ids of turns move, texts do not. A sequence of turns is known by the sums of
four hashes of its turns and their places, so prefixes of a very long conversation are running totals
too and need no task to walk through it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import materialized
from shelfline.llm.listrank import CHUNK, END, list_ranks
from shelfline.llm.ordered import indexed, running_totals
from shelfline.plans.lookup import lookup_join
from shelfline.plans.ordinals import with_previous, with_slice

#: Hash sums that name a sequence, each of 32-bit numbers: right up to 2^31 turns.
_SUMS = 4
#: Copies of a row that are made at once, and members of a node written into one piece.
_COPIES, _PIECE = 1 << 16, 1 << 14
_NOBODY = hashlib.sha256(b"").hexdigest()


def _node(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth, *sums)))


def original_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, pos, print, chars``: the turns of every conversation from 1 on, by turn (null first),
    equal ones by the digest of role and text. Null role or text is empty; rows without conversation
    take no part. Equal rows are counted first and given consecutive places."""
    said, who = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (text, role))
    digest = F.unhex(F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)))
    turns = rows.select(F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), digest.alias("print"), F.length(said).cast("long").alias("chars"))
    counted = turns.where("conv IS NOT NULL").groupBy("conv", "turn", "print", "chars").agg(F.count(F.lit(1)).alias("n"))
    upto = running_totals(indexed(counted, ["conv", "turn", "print"]), ["conv"], "index", {"upto": F.col("n")})
    blocks = upto.withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {_COPIES}"))))
    first = F.col("upto") - F.col("n") + F.col("_block") * _COPIES + 1
    places = F.explode(F.sequence(first, F.least(first + (_COPIES - 1), F.col("upto"))))
    return blocks.select("conv", places.alias("pos"), "print", "chars")


def rebuilt(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations ``conv``, and their rebuilt turns ``conv, pos, print, chars``: the first ``h`` turns
    of conversation ``conv - conv % family``, then the own ones after the first ``h``, where ``h`` is
    ``crc32(conv) % most``."""
    shared = F.crc32(F.col("conv").cast("string")) % most
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("turns")).withColumn("h", shared).withColumn("base", F.col("conv") - F.col("conv") % family)
    first = turns.where((F.col("conv") % family == 0) & (F.col("pos") < most)).groupBy(F.col("conv").alias("base"))
    first = first.agg(F.sort_array(F.collect_list(F.struct("pos", "print", "chars"))).alias("first"))  # fewer than ``most``
    convs = convs.join(first, "base", "left").withColumn("head", F.coalesce(F.slice("first", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<pos:bigint,print:binary,chars:bigint>>")))
    convs = materialized(convs.select("conv", "h", "head", F.size("head").cast("long").alias("k")), "conversations")
    heads = convs.select("conv", F.inline("head"))
    own = lookup_join(turns, convs.select("conv", "h", "k"), "conv", "inner").where("pos > h")
    return convs.select("conv"), heads.unionByName(own.select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "print", "chars"))


def nodes_of(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes ``index, key, parent_key, conv, depth, n_convs, chars`` and the node each conversation ends
    at, ``conv, key``. ``conv`` of a node is its smallest member; ``index`` counts by it and depth."""
    salted = {f"s{i}": F.xxhash64("print", "pos", F.lit(i)).bitwiseAND(F.lit(0xFFFFFFFF)) for i in range(_SUMS)}
    summed = running_totals(turns, ["conv"], "pos", salted)
    before = [F.col(s) - own for s, own in salted.items()]
    steps = materialized(summed.select("conv", "pos", "chars", _node(F.col("pos"), [F.col(s) for s in salted]).alias("key"), _node(F.col("pos") - 1, before).alias("parent_key")), "prefixes")
    root = _node(F.lit(0), [F.lit(0)] * _SUMS)
    below = steps.groupBy("key").agg(F.min("parent_key").alias("parent_key"), F.min("conv").alias("conv"), F.min("pos").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"))
    top = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = top.select(root.alias("key"), F.lit(None).cast("binary").alias("parent_key"), "conv", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("chars"))
    nodes = materialized(indexed(below.unionByName(top), ["conv", "depth"]), "nodes")
    last = steps.groupBy("conv").agg(F.max_by("key", "pos").alias("key"))
    ends = convs.join(last, "conv", "left").select("conv", F.coalesce("key", root).alias("key"))
    return nodes, ends


def linked(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``parent``, ``parent_conv``, ``n_children``, ``child`` (the first) and ``sibling`` (the
    next), all by index; children stand in the order of their smallest members."""
    named = nodes.select(F.col("key").alias("parent_key"), F.col("index").alias("parent"), F.col("conv").alias("parent_conv"))
    tree = materialized(lookup_join(nodes, named, "parent_key").drop("key", "parent_key"), "tree")
    kids = tree.where("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.min("index").alias("child"))
    backwards = with_slice(tree.where("parent IS NOT NULL").select("index", "parent", (-F.col("index")).alias("_back")), "_back")
    later = with_previous(backwards, ["parent"], "_back", ["index"], "_next").select("index", F.col("_next.index").alias("sibling"))
    found = tree.join(kids.withColumnRenamed("parent", "index"), "index", "left").join(later, "index", "left")
    return materialized(found.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "linked")


def tour(tree: DataFrame) -> DataFrame:
    """The arcs ``id, next``: ``2 index`` enters a node, ``2 index + 1`` leaves it."""
    enters = F.coalesce(2 * F.col("child"), 2 * F.col("index") + 1)
    leaves = F.coalesce(2 * F.col("sibling"), 2 * F.col("parent") + 1, F.lit(END))
    arcs = F.array(F.struct((2 * F.col("index")).alias("id"), enters.alias("next")), F.struct((2 * F.col("index") + 1).alias("id"), leaves.alias("next")))
    return tree.select(F.inline(arcs))


def subtree_totals(tree: DataFrame, ranks: DataFrame, amounts: dict[str, Column]) -> DataFrame:
    """``index`` and for each of ``amounts`` (not negative) its sum over the node's subtree, itself
    included: nodes add their amount where they are entered."""
    entered = F.col("id") % 2 == 0
    arcs = ranks.select("id", "rank", F.shiftright("id", 1).alias("index")).join(tree.select("index", *[c.alias(f"_of_{a}") for a, c in amounts.items()]), "index")
    own = {a: F.when(entered, F.col(f"_of_{a}")).otherwise(0) for a in amounts}
    totals = running_totals(arcs, [], "rank", own)
    return totals.groupBy("index").agg(*[(F.max(a) - F.min(F.col(a) - own[a])).alias(a) for a in amounts])


def _ends_digests(ends: DataFrame) -> DataFrame:
    """``index, ends_sha256``: the digest of the conversations that end at a node, ascending, with
    commas. Members are written into pieces first; one digest can only be made in order, so a node's
    pieces, not its members, run through one task, one at a time."""
    placed = indexed(ends, ["index", "conv"], "place").withColumn("piece", F.shiftright("place", _PIECE.bit_length() - 1))
    pieces = placed.groupBy("index", "piece").agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: tuple[list, list] = ([], [])
            for index, ids in zip(batch.column("index").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if index != node:
                    if node is not None:
                        done[0].append(node), done[1].append(state.hexdigest())
                    node, state = index, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.int64()), pa.array(done[1], pa.string())], ["index", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([state.hexdigest()])], ["index", "ends_sha256"])

    dealt = pieces.repartition("index").sortWithinPartitions("index", "piece").select("index", "ids")
    return dealt.mapInArrow(digest, "index bigint, ends_sha256 string")


def prefix_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every
    node of the rebuilt conversations' trie; ``conv_id`` and ``depth`` name a node.

    Null turns come first, equal ones by the digest of role and text, repeated rows are turns of their
    own; null role or text is empty; rows without conversation take no part; a rebuilt conversation
    without turns ends at the root; an empty table has no nodes. Other columns may have any name.
    """
    turns = materialized(original_turns(rows, conv, turn, role, text), "turns")
    convs, steps = rebuilt(turns)
    nodes, ends = nodes_of(convs, steps)
    tree = linked(nodes)
    ranks = list_ranks(tour(tree), chunk)
    leaf, saved = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), (F.col("n_convs") - 1) * F.col("chars")
    totals = subtree_totals(tree, ranks, {"n_leaves": leaf, "saved_tokens": saved})
    members = lookup_join(ends, nodes.select("key", "index"), "key", "inner").select("index", "conv")
    found = tree.join(totals, "index").join(_ends_digests(members), "index", "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_NOBODY)).alias("ends_sha256"),
    )
