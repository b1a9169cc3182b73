"""Jaccard join, embedding near-duplicates and connected components against brute force."""

import random
import re
import string

import numpy as np
from pyspark.sql import functions as F

from counterpoise.llm import jaccard
from counterpoise.llm.common import apart, connected_components, gapless
from counterpoise.llm.embdedup import near_vectors
from odd_input import no_docs, odd_docs  # noqa: F401


def _union(n, links):
    root = list(range(n))
    for a, b in links:
        ra, rb = root[a], root[b]
        root = [min(ra, rb) if r in (ra, rb) else r for r in root]
    return root


def _sets(texts):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def _check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_documents(docs).collect()}
    s = _sets(texts)
    links = [(a, b) for a in range(len(s)) for b in range(a + 1, len(s)) if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b])]
    root = _union(len(s), links)
    assert got == {i: (len(s[i]), root[i]) for i in range(len(s))}
    return len(links)


def test_components_equal_brute_force(spark):
    g = random.Random(4)
    vocab = ["".join(g.choices(string.ascii_lowercase, k=4)) for _ in range(400)]
    passage = g.choices(vocab, k=60)
    texts = [None, "", " \n", "one two", "One  TWO", "three words here", "four words are here"]
    for size in (5, 6, 8, 9, 12, 16, 17, 20, 25, 33, 50, 90, 150, 400):
        base = g.choices(vocab, k=size)
        for edits in (0, 1, 1, 2, 3, 5, 8):
            w = list(base)
            for _ in range(min(edits, size // 2)):
                at = g.randrange(len(w))
                w[at : at + g.randint(0, 1)] = g.choices(vocab, k=g.randint(0, 2))
            texts.append(" ".join(w))
        # long passages shared by otherwise different documents
        texts.append(" ".join(g.choices(vocab, k=size) + passage))
        texts.append(" ".join(passage + g.choices(vocab, k=max(1, size // 8))))
    g.shuffle(texts)
    assert _check(spark, texts) > 80


def test_borders_of_the_threshold(spark):
    # n + 4 words give n shingles; cutting words off one end keeps the rest as a subset
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(words[o : o + n + 4]) for o, n in ((0, 400), (0, 300), (0, 299), (500, 16), (500, 12), (500, 11), (900, 21), (900, 28), (900, 20), (1200, 4), (1200, 3), (1200, 1))]
    _check(spark, texts)


def test_odd_documents(spark, odd_docs, no_docs):
    out = jaccard.near_documents(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[1] == by[2][:0] + [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)]
    assert by[4] == [(1, 4)] and by[5] == [(1, 4)] and by[6] == [(1, 4)]
    assert by[7] == [(4, 7), (4, 7)] and by[9][0][1] == by[10][0][1] == 9
    assert jaccard.near_documents(no_docs).count() == 0


def test_rows_without_an_id_link_others(spark):
    # 1 and 2 share too little with each other, but both enough with a row that has no id; as do two such rows with 3.
    words = [f"w{i}" for i in range(400)]
    rows = [(1, words[:120]), (None, words[15:135]), (2, words[30:150]), (None, words[200:300]), (None, words[212:312]), (3, words[224:324]), (4, words[340:])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = sorted((r.n_shingles, r.doc_id or 0, r.component_id) for r in jaccard.near_documents(docs).collect())
    assert got == sorted([(116, 1, 1), (116, 0, 1), (116, 2, 1), (96, 0, 3), (96, 0, 3), (96, 3, 3), (56, 4, 4)])


def test_tables_made_on_the_way_are_deleted(spark, monkeypatch, tmp_path):
    from counterpoise.llm import common

    monkeypatch.setattr(common, "scratch_path", lambda _, name: f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}")
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(i, " ".join(words[i : i + 100])) for i in range(20)] + [(50, "alone with five words here")], "doc_id long, text string")
    out = jaccard.near_documents(docs)
    assert len(list(tmp_path.iterdir())) == 1  # the result
    assert {r.component_id for r in out.collect()} == {0, 50}


def test_rows_without_a_partner_are_told_apart(spark):
    rows = spark.createDataFrame([(i, str(i)) for i in range(2000)] + [(None, "none")], "k int, v string")
    without, maybe = apart(rows, F.col("k"), spark.createDataFrame([(i,) for i in range(0, 4000, 10)] + [(5,), (5,)], "key long"))
    certain, left = {r.k for r in without.collect()}, [r.k for r in maybe.collect()]
    assert without.columns == maybe.columns == ["k", "v"] and len(certain) + len(left) == 2001
    assert {i for i in range(2000) if i % 10 == 0} | {5} <= set(left) and len(left) < 220 and not certain & set(left)
    without, maybe = apart(rows, F.col("k"), spark.createDataFrame([], "key long"))
    assert without.count() == 2001 and maybe.count() == 0


def test_allocation_meets_the_pigeonhole_bound():
    kinds = set()
    for band in range(1, 30):
        m, d, most = jaccard.allocate(band)
        assert most == jaccard.EDGES[band] // 3 and m + d > most and 0 <= d <= m
        kinds.add(d > 0)
    assert kinds == {True, False}  # small bands use one-deletion neighbourhoods, large ones whole parts


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, x) for x in range(501, 560)] + [(7, 7), (900, 901), (901, 902), (902, 900)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {500: 500} | {x: 500 for x in range(501, 560)} | {900: 900, 901: 900, 902: 900}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_gapless_numbers(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), "id")
    out = gapless(df, ["k"], ["id"], "no", 5000, per_bucket=100)
    r = out.groupBy("k").agg(F.min("no"), F.max("no"), F.countDistinct("no"), F.count("*")).collect()
    assert all(x[1] == 0 and x[2] == x[4] - 1 and x[3] == x[4] for x in r)


def _vectors(seed=3):
    g = np.random.default_rng(seed)
    base = g.standard_normal((40, 32))
    v = [base[i % 40] + g.standard_normal(32) * (0.05 if i % 3 else 0.33) for i in range(400)] + [g.standard_normal(32) for _ in range(300)]
    v += [v[0], v[0], [2 * z for z in v[1]], np.zeros(32)]
    return [[float(np.float32(z)) for z in x] for x in v]


def test_vectors_equal_brute_force(spark):
    rows = [(i, x) for i, x in enumerate(_vectors())]
    odd = [(9000, None), (9001, []), (9002, [float("nan")] * 32), (9003, [float("inf")] + [0.0] * 31), (9004, [1.0, 2.0]), (9005, [1.0, 2.0]), (9006, [None, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("rep", F.lit("clash"))
    for block in (1000, 8):  # small blocks: hot buckets are cut into block pairs
        got = {r.vec_id: r for r in near_vectors(df, block=block).collect()}
        x = np.array([r[1] for r in rows])
        n = np.linalg.norm(x, axis=1, keepdims=True)
        n[n == 0] = 1
        sim = (x / n) @ (x / n).T >= 0.9
        np.fill_diagonal(sim, False)
        links = int(sim.sum())
        found = sum(got[i].n_links for i in range(len(rows)))
        assert 0.97 * links <= found <= links
        assert all(got[i].n_links <= sim[i].sum() for i in range(len(rows)))
        assert got[700].n_links >= 2 and got[703].n_links == 0 and got[703].kept
        assert all(got[i].kept == (got[i].component_id == i) for i in range(len(rows)))
        root = _union(len(rows), list(zip(*np.nonzero(sim))))
        assert np.mean([got[i].component_id == root[i] for i in range(len(rows))]) > 0.97
        assert [got[i].n_links for i in range(9000, 9007)] == [0, 0, 0, 0, 1, 1, 0]
        assert got[9005].component_id == 9004
    assert near_vectors(df.limit(0)).count() == 0


def test_vectors_with_null_string_and_repeated_ids(spark):
    a, b, c, d = [1.0, 0.0, 0.0], [0.99, 0.1, 0.0], [0.0, 0.0, 1.0], [0.0, 0.1, 0.99]
    rows = [("5", a), ("5", c), ("6", b), ("7", d), (None, a), (None, [0.0, 1.0, 0.0]), (None, [0.0, 0.99, 0.1]), (None, [1.0, -1.0, 0.0]), ("8", [-1.0, 0.0, 0.0]), ("8", [-1.0, 0.0, 0.0])]
    for kind in ("string", "long"):
        df = spark.createDataFrame([(i, x) for i, x in rows], "vec_id string, embedding array<double>").withColumn("vec_id", F.col("vec_id").cast(kind))
        got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in near_vectors(df, recall=0.999999).collect())
        assert got == sorted([("5", 2, "5", True), ("5", 1, "5", True), ("6", 2, "5", False), ("7", 1, "5", False), ("None", 2, "5", False),
                              ("None", 1, "None", True), ("None", 1, "None", True), ("None", 0, "None", True), ("8", 1, "8", True), ("8", 1, "8", True)]), kind


def test_links_are_counted_once_over_many_tables(spark):
    """Every vector is near every other: each pair meets in nearly all tables and counts in one."""
    g = np.random.default_rng(8)
    x = g.normal(size=16) + 0.05 * g.normal(size=(150, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    for block in (1000, 20):
        got = near_vectors(df, block=block, recall=0.999999).collect()
        assert {r.n_links for r in got} == {149} and {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1
