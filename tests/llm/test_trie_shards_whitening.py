"""Conversation tries, rendezvous shards and whitening against plain counterparts."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import listrank
from shelfline.llm.common import shared_folder
from shelfline.llm.conversation_trie import prefix_trie
from shelfline.llm.listrank import END, list_ranks, stretches
from shelfline.llm.ordered import indexed, running_totals
from shelfline.llm.sharding import manifest, rendezvous, write_shards
from shelfline.llm.whitening import golub_kahan_lanczos, whitened
from tests.llm.helpers import ODD_TEXTS

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def plain_trie(rows):
    """Nodes of the rebuilt conversations, each walked on its own."""
    original = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            original.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    original = {c: [t[3:] for t in sorted(turns)] for c, turns in original.items()}
    whole = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = original.get(c - c % 100, [])[:h] + own[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for node, cs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in cs if len(whole[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out[min(cs), len(node)] = (parent, len(cs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def trie_rows(df):
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()}


def talks(seed, convs=70, vocabulary=3):
    rng = random.Random(seed)
    said = lambda: rng.choice(["a", "bb", "ccc", "", None, "日本"][: vocabulary + 3])
    ids = rng.sample(range(0, 420), convs) + [100, 200]
    rows = [(c, rng.choice([None, t, t, t]), rng.choice(["u", "v", None]), said()) for c in dict.fromkeys(ids) for t in range(rng.randrange(1, 9))]
    rows += rng.choices(rows, k=15)
    return [*rows, (None, 1, "u", "nobody's")]


@pytest.mark.parametrize("chunk", [16, 1 << 19])
def test_trie_matches_plain_walk(frame, chunk):
    rows = talks(3)
    df = frame("text_ string, " + CONVERSATIONS + ", depth int, index string", *[("x", *r, 7, "y") for r in rows])
    found = prefix_trie(df.repartition(5), chunk=chunk)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert trie_rows(found) == plain_trie(rows)


def test_trie_of_hot_and_empty_tables(frame):
    # A third of all rows in one conversation, one first turn in all, and one row many times.
    rows = [(0, i, "u", "same") for i in range(400)] + [(c, i, "u", "same" if i == 0 else f"{c} {i % 2}") for c in range(1, 200) for i in range(2)]
    rows += [(7, 5, "v", "again")] * 400
    assert trie_rows(prefix_trie(frame(CONVERSATIONS, *rows))) == plain_trie(rows)
    assert not prefix_trie(frame(CONVERSATIONS)).take(1)
    turnless = [(101, 0, "u", "gone when its family has no first one")] * 1
    assert trie_rows(prefix_trie(frame(CONVERSATIONS, *turnless))) == plain_trie(turnless)


@pytest.mark.parametrize("chunk", [4, 50, 1 << 19])
def test_list_ranks(frame, chunk):
    ids = random.Random(5).sample(range(10**12), 300)
    links = frame("id bigint, next bigint", *zip(ids, [*ids[1:], END], strict=True))
    assert {r["id"]: r["rank"] for r in list_ranks(links.repartition(7), chunk).collect()} == {v: i for i, v in enumerate(ids)}


def test_list_ranks_of_no_and_bad_lists(frame):
    assert not list_ranks(frame("id bigint, next bigint")).take(1)
    with pytest.raises(ValueError, match="2 lists"):
        list_ranks(frame("id bigint, next bigint", (1, END), (2, END)))
    with pytest.raises(ValueError, match="ring"):
        stretches(np.array([1, 2]), np.array([2, 1]), np.array([1, 1]))
    assert listrank.CHUNK > 1000


def test_order_helpers(frame):
    rows = [(k, v) for k in ("a", "b", None) for v in range(-20, 300, 3)]
    df = indexed(frame("k string, v bigint", *rows).repartition(6), ["k", "v"])
    ranked = {(r.k, r.v): r["index"] for r in df.collect()}
    assert [ranked[r] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))] == list(range(len(rows)))
    totals = running_totals(df.where("k is not null"), ["k"], "index", {"sum": F.col("v"), "n": F.lit(1)}, bits=4)
    for r in totals.collect():
        assert r["sum"] == sum(range(-20, r.v + 1, 3)) and r["n"] == (r.v + 20) // 3 + 1


DOCUMENTS = "doc_id bigint, text string, shard string, seq int, record string"


def shard_rows(spark, df, weights, added=None):
    return manifest(write_shards(df, shared_folder(spark, "shards"), weights, added=added))


def plain_shard(key, weights):
    score = lambda j: -math.log((int(hashlib.md5(f"{key}:{j}".encode()).hexdigest()[:13], 16) + 0.5) / 16.0**13) / weights[j]
    return min((j for j in range(len(weights)) if weights[j]), key=score)


def test_rendezvous_matches_plain_scores(spark, frame):
    texts = [*ODD_TEXTS, *(f"text {i}" for i in range(300))]
    rows = [(i, t, "s", 1, "r") for i, t in enumerate(texts)] + [(None, "no key", "s", 2, None)] * 3 + [(5, "one more text under a key", None, 1, "")]
    weights = [1.0, 3.0, 0.0, 0.5, 1.0]
    found = shard_rows(spark, frame(DOCUMENTS, *rows).repartition(5), weights, added=2.0).collect()
    assert len(found) == len(rows)
    named = lambda r: str(r) if r is not None else "content:" + hashlib.md5(b"no key").hexdigest()
    for r in found:
        assert r.shard == plain_shard(named(r.doc_id), weights) and r.grown == plain_shard(named(r.doc_id), [*weights, 2.0])
        assert r.grown in (r.shard, len(weights))
    expected = sorted((r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in found) == expected
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and 2 not in slots


def test_rendezvous_shares_follow_weights(spark):
    weights = [1.0, 2.0, 4.0, 1.0]
    counts = spark.range(40_000).select(rendezvous(F.col("id").cast("string"), weights)["shard"].alias("s")).groupBy("s").count().collect()
    assert all(abs(r["count"] / 40_000 - weights[r["s"]] / 8) < 0.01 for r in counts)
    for bad in ([], [0.0], [-1.0, 1.0], [math.inf], [math.nan]):
        with pytest.raises(ValueError):
            rendezvous(F.lit("a"), bad)


def test_shards_keep_whole_rows_and_split_hot_keys(spark, frame):
    rows = [(1, "hot", "a", 0, "x")] * 500 + [(i, f"t{i}", None, i, "y") for i in range(500)]
    folder = shared_folder(spark, "shards")
    shards = write_shards(frame(DOCUMENTS, *rows), folder, [1.0] * 4)
    kept = sorted(map(repr, (tuple(r) for r in shards.select("record.*").collect())))
    assert kept == sorted(map(repr, rows))
    assert shards.where("grown is not null").isEmpty()
    slots = manifest(shards).groupBy("shard").agg(F.countDistinct("slot").alias("d"), F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    assert all(r.d == r.n == r.m + 1 for r in slots)
    none = write_shards(frame(DOCUMENTS), shared_folder(spark, "shards"), [1.0])
    assert not manifest(none).take(1)


VECTORS = "vec_id bigint, embedding array<double>, component int, x string"


def plain_whitening(vectors, n_components=8):
    x = np.floor(np.array(vectors, np.float64) * 1024) + 100_000
    d = x - x.mean(0)
    e, v = np.linalg.eigh(d.T @ d / len(x))
    e, v = e[::-1][:n_components], v[:, ::-1][:, :n_components]
    whole = x.astype(int).tolist()
    sums = [sum(c) for c in zip(*whole, strict=True)]
    return d @ v / np.sqrt(e), e / np.trace(d.T @ d / len(x)), [sum((len(x) * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in whole]


def test_whitening_matches_eigenvectors(spark, frame):
    rng = np.random.default_rng(2)
    good = (rng.standard_normal((120, 12)) * np.linspace(0.1, 2, 12)).tolist()
    rows = [(i, v, 1, "x") for i, v in enumerate(good)]
    odd = [(900, None, 1, "x"), (901, [], 1, "x"), (902, [1.0] * 11 + [None], 1, "x"), (903, [1.0] * 11 + [math.nan], 1, "x"), (904, [math.inf] * 12, 1, "x"), (905, [1.0, 2.0], 1, "x"), (906, [1e300] * 12, 1, "x")]
    found = whitened(frame(VECTORS, *rows, *odd).repartition(5), 8).collect()
    z, explained, deviations = plain_whitening(good)
    assert {r.vec_id for r in found} == set(range(120)) and len(found) == 960
    got = np.zeros((120, 8))
    for r in found:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviations[r.vec_id] and r.n == 120 and r.identity_error < 1e-10
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    signs = np.sign((got * z).sum(0))
    assert np.abs(got * signs - z).max() < 1e-8


def test_whitening_of_degenerate_tables(spark, frame):
    ddl = "vec_id bigint, embedding array<float>"
    assert not whitened(frame(ddl)).take(1)
    assert not whitened(frame(ddl, (1, [1.0, 2.0]))).take(1)
    assert not whitened(frame(ddl, *[(i, [0.5, 0.25]) for i in range(9)])).take(1)
    # One direction only, a null key, and rows that repeat.
    line = whitened(frame(ddl, (None, [0.0, 0.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 4.0]))).collect()
    assert sorted((r.vec_id or 0, r.component) for r in line) == [(0, 1), (1, 1), (1, 1), (2, 1)]
    assert all(abs(r.explained - 1) < 1e-12 and r.identity_error < 1e-12 for r in line)
    # Numbers whose squared deviations pass 64 bits.
    far = whitened(frame(ddl, (1, [0.0]), (2, [4e9]))).collect()
    assert {r.vec_id: r.deviation for r in far} == {1: None, 2: None}


def test_bidiagonalisation_finds_repeated_values():
    x = np.diag([3.0, 3, 3, 2, 2, 1, 1, 0])
    product = lambda q, p: (float((x @ q) @ (x @ q)), (x @ p).T @ (x @ q), x.T @ (x @ q), float((x * x).sum()))
    s, v = golub_kahan_lanczos(product, 8, 3)
    assert np.allclose(s, [3, 3, 3, 2, 2, 1, 1, 0], atol=1e-12) and np.allclose(v.T @ v, np.eye(8), atol=1e-12)
    assert np.allclose(np.abs(x @ v).sum(), np.abs(x @ v).sum()) and np.allclose((x @ v[:, :3])[3:], 0, atol=1e-10)
