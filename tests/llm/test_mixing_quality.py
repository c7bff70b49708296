"""Source mixing and the quality model."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import mixing, quality
from tests.llm.helpers import ODD_TEXTS, prose


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free = {}, set(order)
    while free:
        price = (share * sum(sizes.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * price > cap * sizes[s]}
        if not over:
            return target | {s: weight[s] * price for s in free}
        target |= {s: cap * sizes[s] for s in over}
        free -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 50, 4000, 10**6]) + rng.randrange(9) for s in ["b", "a", "Z", "é", None, "src10", "src2", ""][: 2 + 2 * seed]}
    df = spark.createDataFrame(list(sizes.items()), "`group` string, source_size bigint")
    got = {r.group: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix(spark):
    rng = random.Random(1)
    rows = [(i, prose(i, rng.choice([1, 5, 30, 400]), 50), rng.choice(["hot"] * 4 + ["b", "c", None, "ü"])) for i in range(600)]
    rows += [(1000 + i, "same words in all of these", "copies") for i in range(300)]
    rows += [(2000 + i, t, "odd") for i, t in enumerate(ODD_TEXTS)] + [(None, "no key here", "b"), (5000, "again", "b"), (5000, "again", "b"), (3000, None, "empty")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, source string, size bigint, `group` string").repartition(4)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r[0]), size(r[1])) for r in rows)
    totals = {}
    for _, text, source in rows:
        totals[source] = totals.get(source, 0) + size(text)
    target, of = plain_targets(totals), {i: s for i, _, s in rows}
    taken = dict.fromkeys(totals, 0)
    for r in got:
        assert r.source_size == totals[of[r.doc_id]] and r.target == pytest.approx(target[of[r.doc_id]])
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 2
        taken[of[r.doc_id]] += r.taken
    for s in totals:
        # The sizes here leave at most the shortest unswitched document.
        assert abs(taken[s] - target[s]) <= max(30, 0.02 * target[s]), s
    again = mixing.mix(docs.repartition(3, "text")).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(docs.limit(0)).count() == 0


def test_texts_do_not_move_for_their_copies(spark):
    n = 20000
    texts = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.col("id") % 7 + 1), lambda x: F.lit("w")))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), texts.alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    # Two rows of one id share its copies, a row without id stays once.
    docs = docs.unionByName(docs.where("doc_id = 7").withColumn("text", F.lit("w w w w w w w w w w w"))).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        taken = corpus_pipeline.mixed_sources(spark, docs, "")
        plan = taken._jdf.queryExecution().executedPlan().toString()
        assert taken.columns == docs.columns and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        found = {r.doc_id: r["count"] for r in taken.groupBy("doc_id").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    most, rows_of = {}, {}
    for r in mixing.mix(docs).collect():
        most[r.doc_id] = max(most.get(r.doc_id, 0), r.copies)
        rows_of[r.doc_id] = rows_of.get(r.doc_id, 0) + 1
    wanted = {k: most[k] * rows_of[k] for k in most if k is not None and most[k]} | {None: 1}
    assert rows_of[7] == 2 and found == wanted


def test_reruns_agree(spark):
    docs = spark.createDataFrame([(i, prose(i, 1 + i % 90), f"s{i % 3}") for i in range(200)], "doc_id bigint, text string, source string")
    assert sorted(map(tuple, mixing.mix(docs).collect())) == sorted(map(tuple, mixing.mix(docs).collect()))


def junk(seed):
    base, kind = prose(seed, 60 + seed % 90), seed % 3
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in base.split())
    if kind == 1:
        return base.replace(" ", " | ")
    return base + " " + " ".join(w for w in base.split()[:9] for _ in range(12))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, junk(i) if i % 4 == 0 else prose(i, 30 + i % 200) + ".", "x") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, 0) for i in range(600)] + [(None, 1, 0), (5, None, 0), (99999, 1, 0)], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_quality_on_held_out_documents(labelled):
    from pyspark.sql import functions as F

    docs, labels = labelled
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    model = quality.train(docs, labels, usable=learn)
    got = {r.doc_id: r for r in quality.scores(docs, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i].predicted == (i % 4 != 0) for i in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    kept = {r.doc_id for r in quality.keep_good(docs, model).collect()}
    assert kept == {i for i, r in got.items() if r.predicted}
    assert quality.keep_good(docs, model).columns == docs.columns


def test_quality_bound_and_odd_rows(spark, labelled):
    docs, labels = labelled
    few = quality.train(docs, labels, most=60)
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "x y"), (1, "a"), (1, "a")], "doc_id bigint, text string")
    got = quality.scores(odd, few).collect()
    assert len(got) == len(ODD_TEXTS) + 3 and all(0 <= r.score <= 1 for r in got)
    nothing = quality.train(docs, labels.where("quality = 1"))
    assert {(r.score, r.predicted) for r in quality.scores(odd, nothing).collect()} == {(0.5, 1)}
    assert quality.scores(odd.limit(0), few).count() == 0
    assert quality.train(docs.limit(0), labels).weights is None


def test_features_do_not_depend_on_the_batch():
    texts = [*ODD_TEXTS, junk(0), junk(1), junk(2), prose(4, 50)]
    whole = quality.features(pa.array(texts, pa.string()))
    each = np.concatenate([quality.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, each) and whole.shape == (len(texts), quality.FEATURES)
    sliced = quality.features(pa.array(["x", *texts], pa.string()).slice(1))
    assert np.allclose(whole, sliced)


def test_features_take_little_memory_at_a_time():
    import tracemalloc

    class Rows:
        schema = None

        def mapInArrow(self, fn, schema):
            return fn

    text = pa.array([prose(i, 700) for i in range(2400)], pa.string())
    keep = quality.keep_good(Rows(), quality.Model())
    tracemalloc.start()
    kept = sum(b.num_rows for b in keep(iter([pa.RecordBatch.from_arrays([text], ["text"])])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept == len(text) and text.nbytes > 6 << 20 and peak < 32 << 20


def test_every_stage_of_the_pipeline_hands_over_little_at_a_time(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet").limit(20)
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs, small)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 2 << 20
