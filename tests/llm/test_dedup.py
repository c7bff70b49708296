"""Deduplication operators against brute force."""

import numpy as np
import pytest

from shelfline.llm import cross_polytope, graph, line_dedup, minhash_forest, vector_dedup
from shelfline.llm.vectors import units
from tests.llm.helpers import ODD_TEXTS, changed, components, prose, shingle_set


def near(a, b, percent):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def check_forest(spark, texts, region=minhash_forest.REGION, percent=85):
    rows = [(i, t, "x", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key string, component bigint")
    got = {r.doc_id: r for r in minhash_forest.near_duplicates(docs, percent=percent, region=region).collect()}
    sets = [shingle_set(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if near(sets[a], sets[b], percent)]
    want = components(range(len(sets)), links)
    assert {d: r.component_id for d, r in got.items()} == want
    assert all(r.n_shingles == len(sets[d]) and r.kept == (want[d] == d) for d, r in got.items())
    return want


def test_forest_odd_texts_and_copies(spark):
    base = [prose(s, 150) for s in range(12)]
    copies = [changed(t, s, n) for s, t in enumerate(base) for n in (1, 2, 3)]
    want = check_forest(spark, [*ODD_TEXTS, *base, *copies, *base[:3], "One", "a b c d e"])
    assert len(set(want.values())) < len(want)


@pytest.mark.parametrize("region", [512, 8])
def test_forest_large_group(spark, region):
    # One group whose members are linked with some and just not with others; small regions force
    # deeper prefixes and blocks.
    base = prose(99, 140)
    texts = [changed(base, s, s % 4) for s in range(160)] + [prose(s, 100) for s in range(40)]
    check_forest(spark, texts, region)


def test_forest_small_regions_at_80(spark):
    base = prose(7, 139)
    first = [changed(base, s, 3) for s in range(60)]
    check_forest(spark, first + [changed(t, 1000 + s, 3) for s, t in enumerate(first)], region=8, percent=80)


def test_whole_signatures_hold_links_at_80(spark):
    # Pairs of sets that share 80 of 100: regions of one document compare whole signatures only.
    n, rng = 300, np.random.default_rng(3)
    sets = []
    for _ in range(n):
        x = rng.integers(-(1 << 63), (1 << 63) - 1, 100)
        sets += [np.sort(x[:90].view(np.uint64)), np.sort(np.concatenate([x[:80], x[90:]]).view(np.uint64))]
    sigs = minhash_forest.signatures(np.concatenate(sets), np.cumsum([90] * len(sets))).view(">i8").astype(np.int64)
    trees = [(k, k, t, int(b)) for k, sig in enumerate(sigs) for t, b in enumerate(sig)]
    trees = spark.createDataFrame(trees, "key bigint, component bigint, tree int, bits bigint")
    full = spark.createDataFrame([(k, s.view(np.int64).tolist()) for k, s in enumerate(sets)], "key bigint, shingles array<bigint>")
    missed = {}
    for further in (0, minhash_forest._further(80)):
        cells = minhash_forest._cells(trees, minhash_forest.DEPTHS, 1, full, further)
        both = cells.groupBy("cell").agg({"key": "collect_set"}).toDF("cell", "keys").collect()
        met = {k // 2 for r in both for k in r["keys"] if k ^ 1 in r["keys"]}
        missed[further] = n - len(met)
    assert missed[0] > 0 and missed[minhash_forest._further(80)] == 0, missed


def test_further_trees_miss_no_more():
    missed = lambda percent, trees: (1 - (percent / 100) ** minhash_forest.DEPTH) ** trees
    assert all(minhash_forest._further(p) == 0 for p in range(85, 101)) and minhash_forest._further(80) == 18
    for p in range(73, 101):
        assert missed(p, minhash_forest.TREES + minhash_forest._further(p)) <= missed(85, minhash_forest.TREES)


def test_forest_null_keys_repeats_and_nothing(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in minhash_forest.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (4, 2, 2, False), (4, 2, 2, False), (2, 2, 2, True), (7, 0, 7, True)], key=str)
    assert minhash_forest.near_duplicates(docs.limit(0)).count() == 0


def test_forest_texts_that_share_a_key(spark):
    # One text of 5 is near 1, another near 7, a third like nothing; 9 and 3 share no text but a key's.
    a, b, c = prose(1, 120), prose(2, 120), prose(3, 120)
    rows = [(1, a), (5, changed(a, 1, 1)), (5, changed(b, 2, 1)), (5, prose(9, 90)), (7, b), (9, c), (9, prose(4, 80)), (3, prose(4, 80)), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for shuffled in (docs, docs.repartition(5, "text")):
        got = {(r.doc_id, r.n_shingles): r.component_id for r in minhash_forest.near_duplicates(shuffled).collect()}
        assert {k: v for k, v in got.items() if k != (5, 0)} == {(1, 116): 1, (5, 116): 1, (5, 86): 1, (7, 116): 1, (9, 116): 3, (9, 76): 3, (3, 76): 3}
        assert got[5, 0] == 5


def test_meetings_cover_all_pairs_of_components_and_grow_with_the_family(spark, monkeypatch):
    monkeypatch.setattr(minhash_forest, "FAMILY", 8)
    # Families: a large component and few others; nothing but single documents; one block.
    rows = [(i, 1, 0 if i < 400 else i, 10) for i in range(406)] + [(1000 + i, 2, 1000 + i, 10) for i in range(40)] + [(2000 + i, 3, 2000 + i % 2, 10) for i in range(6)]
    families = spark.createDataFrame(rows, "key bigint, family bigint, component bigint, n_shingles bigint")
    held, moved = {}, {}
    for r in minhash_forest._meetings(families).collect():
        for t in r.tasks:
            held.setdefault(tuple(t), set()).add(r.key)
        moved[r.key // 1000] = moved.get(r.key // 1000, 0) + len(r.tasks)
    met = {(a, b) for keys in held.values() for a in keys for b in keys}
    family, component = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    assert all((a, b) in met for a in family for b in family if family[a] == family[b] and component[a] != component[b])
    assert max(map(len, held.values())) < 50 and moved[0] <= 2 * 406 and moved[2] == 6


def test_prefixes_grow_with_the_table():
    assert minhash_forest._depths(0) == minhash_forest._depths(1) == minhash_forest._depths(1 << 24) == (4, 6, 8)
    assert minhash_forest._depths((1 << 24) + 1) == (5, 6, 8) and minhash_forest._depths(10**10) == (6, 8)
    assert minhash_forest._depths(10**15) == (8,)


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 900, (700, 2))]
    links += [(i, i + 1) for i in range(1000, 1400)] + [(2000, i) for i in range(2001, 2500)] + [(5, 5)]
    df = spark.createDataFrame(links, "a bigint, b bigint").repartition(7)
    got = {r.node: r.component for r in graph.components(df).collect()}
    want = components({n for e in links for n in e}, links)
    assert got == {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in links)}
    assert graph.components(df.limit(0)).count() == 0


def test_site_lines(spark):
    rows = [(i, "a", f"menu\nbody {i}\n menu \n\nend{i % 2}", None) for i in range(10)]
    rows += [(20, "a", None, 1), (21, None, "menu\nx", 1), (22, "b", "menu\nmenu", 1), (None, "a", "", 1), (3, "a", "menu", 7)]
    rows += [(30 + i, "c", "copy", 2) for i in range(6)] + [(40 + i, "c", f"own {i}", 2) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, site bigint")
    got = line_dedup.drop_site_lines(docs, ratio=0.1, least_pages=5)
    assert got.columns == ["doc_id", "source", "text", "site", "_dropped"]
    found = [tuple(r) for r in got.collect()]
    # menu: 11 of 12 pages; end0 and end1: 5 of 12; copy: 6 of 66 is less than a tenth.
    want = []
    for i, site, text, extra in rows:
        gone = {"menu", "end0", "end1"} if site == "a" else set()
        lines = None if text is None else text.split("\n")
        kept = None if text is None else "\n".join(x for x in lines if x.strip(" ") not in gone)
        want.append((i, site, kept, extra, 0 if text is None else sum(x.strip(" ") in gone for x in lines)))
    assert sorted(found, key=str) == sorted(want, key=str)
    assert line_dedup.drop_site_lines(docs.limit(0)).count() == 0


def test_site_lines_null_texts_are_no_pages(spark):
    # On 5 of 40 pages, an eighth; with the 40 rows without text it would be a sixteenth.
    rows = [(i, "a", f"menu\nown {i}" if i < 5 else f"own {i}") for i in range(40)] + [(100 + i, "a", None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = {r.doc_id: (r.text, r["_dropped"]) for r in line_dedup.drop_site_lines(docs, ratio=0.1, least_pages=5).collect()}
    assert got == {i: (None, 0) if text is None else (f"own {i}", int(i < 5)) for i, _, text in rows}


def unit_rows(n, width, seed, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    near_rows = x[rng.integers(0, n, copies)] + rng.normal(scale=0.2, size=(copies, width))
    return np.concatenate([x, near_rows])


def test_vector_links(spark):
    x = unit_rows(120, 16, 1, 200)
    rows = [(i, i % 3, v.tolist(), "x", 1) for i, v in enumerate(x)]
    rows += [(1000 + i, 0, rows[0][2], "x", 1) for i in range(40)] + [(2000, 0, (2 * x[0]).tolist(), "x", 1)]
    odd = [(3000, None, rows[0][2]), (3001, 0, None), (3002, 0, [0.0] * 16), (3003, 0, [float("nan")] + [1.0] * 15), (3004, 0, [None] + [1.0] * 15), (3005, 0, []), (3006, 0, [1.0, 2.0]), (3007, 0, [float("inf")] * 16)]
    rows += [(*o, "x", 1) for o in odd]
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>, key string, rep bigint")
    good = [r for r in rows if r[0] < 3000]
    v = np.array([r[2] for r in good])
    u = v / np.linalg.norm(v, axis=1)[:, None]
    label, ids = np.array([r[1] for r in good]), np.array([r[0] for r in good])
    link = (u @ u.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    want = components(ids.tolist() + [o[0] for o in odd], [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(link), strict=True)])
    degree = dict(zip(ids.tolist(), link.sum(1).tolist(), strict=True))
    for cell in (1024, 20):
        got = {r.vec_id: r for r in vector_dedup.near_duplicates(frame, cosine=0.93, cell=cell).collect()}
        assert {i: r.component_id for i, r in got.items()} == want
        assert {i: r.n_links for i, r in got.items()} == {i: degree.get(i, 0) for i in want}
        assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert vector_dedup.near_duplicates(frame.limit(0)).count() == 0


def exact_neighbours(ids, x, query, k):
    d = np.sqrt(np.square(x[query] - x).sum(1))
    d[ids == ids[query]] = np.inf
    order = np.lexsort((ids, d))[:k]
    return [(int(ids[i]), d[i]) for i in order if np.isfinite(d[i])]


@pytest.mark.parametrize("bucket", [4096, 8])
def test_cross_polytope(spark, bucket):
    x = unit_rows(1500, 24, 2, 300)
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(len(x))
    rows = [(int(i), v.tolist(), "x", 1) for i, v in zip(ids, x, strict=True)] + [(9000, None, "x", 1), (9100, [0.0] * 24, "x", 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, id string, tab bigint")
    from pyspark.sql import functions as F

    got = cross_polytope.nearest(frame, F.col("vec_id") % 100 == 0, k=10, bucket=bucket).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by) == set(range(0, len(x), 100)) and all(len(v) == 10 for v in by.values())
    hits = 0
    for q, found in by.items():
        assert found == sorted(found, key=lambda f: (f[1], f[0]))
        want = exact_neighbours(ids, x, q, 10)
        hits += len({f[0] for f in found} & {w[0] for w in want})
        for i, score in found:
            assert score == pytest.approx(np.sqrt(np.square(x[q] - x[i]).sum()), abs=1e-14)
    assert hits >= 0.9 * 10 * len(by)


def test_cross_polytope_recall_with_two_rotations():
    import pyarrow.parquet as pq

    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pydict()
    ids, x = np.array(rows["vec_id"]), np.array(rows["embedding"], np.float64)
    u, queries = units(x), np.flatnonzero(ids % 40 == 0)
    found = np.zeros((len(queries), len(x)), bool)
    for table in range(cross_polytope.TABLES * cross_polytope.MORE_TABLES):
        home = cross_polytope._buckets(u, table, 2, 1)[:, 0]
        asked = cross_polytope._buckets(u[queries], table, 2, cross_polytope.PROBES)
        found |= np.array([np.isin(home, a) for a in asked])
    hits = [found[r, np.flatnonzero(ids == i)[0]] for r, q in enumerate(queries) for i, _ in exact_neighbours(ids, x, q, 10)]
    assert np.mean(hits) >= 0.9


def test_cross_polytope_few_rows_and_ties(spark):
    from pyspark.sql import functions as F

    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [-1.0, 0.0]), (3, [-1.0, 0.0]), (None, [1.0, 0.0]), (4, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in cross_polytope.nearest(frame, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    assert cross_polytope.nearest(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_a_cut_region_grows_with_its_strays_not_with_its_square(spark):
    n, strays, region = 2000, 30, 100
    ddl = "key BIGINT, component BIGINT, tree INT, bits BIGINT"
    trees = spark.createDataFrame([(i, i if i < strays else strays, 0, 7) for i in range(n)], ddl)
    cells = minhash_forest._cells(trees, (4, 6, 8), region, None, 0).collect()
    assert len(cells) <= n + strays * (n // region + 2)
    by_cell = {}
    for c in cells:
        by_cell.setdefault(c.cell, []).append(c)
    assert max(map(len, by_cell.values())) <= 4 * region
    pairs = ((a, b) for held in by_cell.values() for a in held for b in held if a.key < b.key and a.key < strays)
    met = {(a.key, b.key) for a, b in pairs if a.side < 0 or a.side != b.side}
    assert met == {(a, b) for a in range(strays) for b in range(a + 1, n)}
