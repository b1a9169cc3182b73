"""Classifiers, URL filter, substring dedup, decontamination, sharding."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from counterpoise.llm import decontaminate, quality, substring, toxicity
from counterpoise.llm.labels import held_out
from counterpoise.llm.sharding import kd_shards
from counterpoise.llm.urlfilter import duckdb_sql, host_and_path, judge_urls
from odd_input import no_docs, odd_docs  # noqa: F401

LABELS = "doc_id long, quality int, toxic int"


def _is_held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


# ---------------------------------------------------------------- classifiers
def _corpus(spark, n=360, seed=2):
    g = random.Random(seed)
    words = ["".join(g.choices("abcdefghij", k=g.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = g.choices(words, k=g.randint(30, 300))
        good, toxic = g.random() < 0.6, g.random() < 0.4
        if not good:
            at = g.randrange(len(w))
            w[at:at] = [x + "%%%$$" for x in g.choices(words, k=60)]
        if toxic:
            w[g.randrange(len(w))] = g.choice(["idiot", "moron", "scum"])
        elif g.random() < 0.5:
            w[g.randrange(len(w))] = g.choice(["muslim", "women", "gay"])
        docs.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, int(good), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, LABELS)


def test_quality_finds_bad_passages_in_held_out_documents(spark):
    docs, labels = _corpus(spark)
    model = quality.fit_quality(docs, labels)
    out = quality.score_quality(docs, model).join(labels, "doc_id").toPandas()
    assert (out.held_out == [_is_held(i) for i in out.doc_id]).all()
    h = out[out.held_out]
    assert ((h.score >= 0.5) == (h.quality == 1)).mean() > 0.9


def test_held_out_labels_are_never_used(spark):
    docs, labels = _corpus(spark, 200)
    flipped = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality"))).withColumn(
        "toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = quality.score_quality(docs, quality.fit_quality(docs, labels))
    b = quality.score_quality(docs, quality.fit_quality(docs, flipped))
    assert a.exceptAll(b).count() == 0
    assert toxicity.fit_toxicity(docs, labels).weights == toxicity.fit_toxicity(docs, flipped).weights


def test_attention_gradients():
    g = np.random.default_rng(0)
    x, starts, y = g.standard_normal((9, quality.WIDTH)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])
    m = quality.AttentionMIL(np.zeros(quality.WIDTH), np.ones(quality.WIDTH), hidden=5, gate=3)
    m.p["c"] = g.standard_normal(5)

    def loss():
        f, _ = m.forward(x, starts)
        return -np.mean(y * np.log(f) + (1 - y) * np.log(1 - f))

    grads = m.gradients(x, starts, y)
    for k, v in m.p.items():
        at = tuple(g.integers(0, s) for s in v.shape)
        v[at] += 1e-6
        up = loss()
        v[at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - grads[k][at]) < 1e-5, k
        v[at] += 1e-6


def test_passages_cover_whole_texts():
    text = "word " * 1000 + "x" * 5000
    x, owner = quality.encode_passages([text, "", "short"])
    assert (owner == 1).sum() == 1 and (owner == 2).sum() == 1 and (owner == 0).sum() >= len(text) / quality.PASSAGE
    data = np.frombuffer(text.encode(), np.uint8)
    s, _ = quality.cut_passages(data, np.array([0, len(data)]))
    assert s[0] == 0 and (np.diff(s) > 0).all() and (np.diff(s) <= quality.PASSAGE).all()


def test_classifiers_on_odd_input(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], LABELS)
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (4, 1, 0), (4, 1, 0), (5, 0, 1), (7, 1, 1), (9, 0, 0), (10, 1, 0), (8, 0, 1)], LABELS)
    for labels in (none, odd):
        q = quality.score_quality(odd_docs, quality.fit_quality(odd_docs, labels)).collect()
        t = toxicity.score_toxicity(odd_docs, toxicity.fit_toxicity(odd_docs, labels, min_docs=1)).collect()
        for rows in (q, t):
            assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
            assert len({r.score for r in rows if r.doc_id == 7}) == 1
    assert quality.score_quality(no_docs, 0.5).count() == 0
    assert toxicity.score_toxicity(no_docs, toxicity.fit_toxicity(no_docs, none)).count() == 0
    kept = quality.score_quality(odd_docs, 0.7, keep=True)
    assert kept.drop("_score").columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_toxicity_and_neutral_mentions(spark):
    docs, labels = _corpus(spark)
    model = toxicity.fit_toxicity(docs, labels)
    out = toxicity.score_toxicity(docs, model).join(labels, "doc_id").toPandas()
    h = out[out.held_out]
    assert ((h.score >= 0.7) == (h.toxic == 1)).mean() > 0.95
    assert model.score("the women and the muslim neighbours met") < 0.5


def test_counterfactual_term_ties_swapped_words():
    # Word 0 marks a group and goes with the label; word 1 is its counterpart.
    docs = [[0, 2]] * 30 + [[1]] * 30 + [[2]] * 5
    y = np.array([1.0] * 30 + [0.0] * 30 + [1.0] * 5)
    indptr = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    index = np.array([w for d in docs for w in d])
    pairs = np.array([[0, 1]] * 30 + [[1, 0]] * 30)
    _, free = toxicity.fit_weights(indptr, index, y, 3, np.zeros((0, 2), int), cf=0)
    _, tied = toxicity.fit_weights(indptr, index, y, 3, pairs, cf=5.0)
    assert abs(free[0] - free[1]) > 5 * abs(tied[0] - tied[1])


def test_counterfactuals_cover_the_beginnings_of_identity_terms(spark):
    # Long identity words go with the label, their counterparts do not; every sentence is neutral but for the insult.
    g = random.Random(4)
    rows, labels = [], []
    fill = ["".join(g.choices("bcdfgl", k=3)) for _ in range(60)]
    for i in range(400):
        toxic = i % 2
        term = ("muslim" if toxic else "christian") if g.random() < 0.8 else g.choice(fill)
        w = g.choices(fill, k=12) + [term] + (["scum"] if toxic and g.random() < 0.6 else [])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    model = toxicity.fit_toxicity(docs, labels)

    def logit(text):
        p = model.score(text)
        return np.log(p / (1 - p))

    gap = logit("the muslim neighbours met") - logit("the christian neighbours met")
    free = toxicity.fit_toxicity(docs, labels, cf=0.0)
    free_gap = sum(free.weights.get(f, 0) for f in toxicity.features({"muslim"})) - sum(free.weights.get(f, 0) for f in toxicity.features({"christian"}))
    assert free_gap > 1 and abs(gap) < 0.25 * free_gap
    assert model.score("the muslim neighbours met") < 0.7 <= model.score("the neighbours are scum")


def test_a_swap_keeps_the_features_of_other_words():
    out, come = toxicity.changed({"women", "womenfolk", "met"}, "women", "men")
    assert out == {"women"} and come == {"men"}
    out, come = toxicity.changed({"muslim", "met"}, "muslim", "christian")
    assert out == {"muslim", "musl*", "musli*"} and come == {"christian", *("christia"[:k] + "*" for k in range(4, 9))}


# ---------------------------------------------------------------- urls
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
URLS = [None, "", "no scheme", "http://A.Example.ORG/es/1", "https://example.org/en/12?q=/es/", "http://example.org", "http://example.org?x=1", "http://x.com/fr/1#a/b",
        "ftp://Y.COM/de/", "http://notexample.org/es/1", "http://net/a/b/c/d/e/f", "a://b://c/d", "http://h.net/de/7", "http://h.net/de/7", "http://org/"]


def test_host_and_path(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    host, path = host_and_path(F.col("url"))
    got = [(r.h, r.p) for r in df.select(host.alias("h"), path.alias("p")).collect()]
    want = []
    for u in URLS:
        rest = u.split("://", 1)[1] if u and "://" in u else None
        if rest is None:
            want.append(("", ""))
            continue
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        path_ = rest[cut:]
        want.append((rest[:cut].lower(), path_[: min([path_.find(c) for c in "?#" if c in path_] + [len(path_)])]))
    assert got == want


def test_url_filter_equals_its_sql(spark, tmp_path):
    import duckdb

    g = random.Random(3)
    urls = URLS + [f"http://{g.choice(['a', 'b', 'www.a'])}.{g.choice(['com', 'org', 'net'])}/{g.choice(['de', 'fr', 'es', 'u' + str(i)])}/{i}/{g.choice(['', 'x.html', 'v' * (i % 30)])}"
                   for i in range(400)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit("clash"))
    out = judge_urls(df, RULES)
    path = str(tmp_path / "pages")
    df.select("page_id", "url").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = sorted(con.execute(duckdb_sql(RULES)).fetchall())
    assert sorted(tuple(r) for r in out.select("page_id", "host", "path", "rule", "verdict").collect()) == want
    assert {r[4] for r in want if r[3] is None} == {"allow", "block"}
    by = {r[0]: r for r in want}
    assert by[3][3:] == ("example.org/es/", "block") and by[5][3] is None and by[9][3:] == ("org/", "allow") and by[14][3:] == ("org/", "allow")
    assert judge_urls(df.limit(0), RULES).count() == 0


def test_url_labels_decide_templates(spark):
    pages = spark.createDataFrame([(i, f"http://shop.net/{'spam' if i % 2 else 'blog'}/{i}") for i in range(60)], "page_id long, url string")
    labels = spark.createDataFrame([(f"http://shop.net/spam/{i}", 1) for i in range(40)] + [(f"http://shop.net/blog/{i}", 0) for i in range(40)], "url string, blocked int")
    got = {r.page_id: (r.verdict, r.template) for r in judge_urls(pages, [], labels).collect()}
    assert got[1] == ("block", "/spam/#") and got[2] == ("allow", "/blog/#")


def _site(sections: int, times: int):
    """Rules judge com urls; b.net has /de/, /fr/ and many sections and ids of its own that no rule reaches."""
    urls = [f"http://a{i % 9}.com/{s}/{i}" for i in range(90) for s in ("de", "fr")]
    urls += [f"http://b.net/{s}/p{i}" for i in range(50) for s in ("de", "fr")]
    urls += [f"http://b.net/sec{k}x{chr(97 + k % 26)}{chr(97 + k // 26)}/{i}" for k in range(sections) for i in range(12)]
    urls += [f"http://b.net/{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(300)]
    return urls * times


@pytest.mark.parametrize("times", [1, 10])
def test_stable_sections_keep_their_verdicts_as_urls_grow(spark, times):
    """/de/ is blocked whether its host has 5 or 60 other sections, and with tenfold urls."""
    for sections in (5, 60):
        pages = spark.createDataFrame(list(enumerate(_site(sections, times))), "page_id long, url string")
        out = judge_urls(pages, RULES).where("host = 'b.net'").groupBy(F.split("path", "/")[1].alias("s")).agg(F.collect_set("verdict").alias("v"), F.collect_set("template").alias("t")).collect()
        got = {r.s: r for r in out}
        assert got["de"].v == ["block"] and got["fr"].v == ["allow"]
        assert all(r.t == ["/*"] for s, r in got.items() if len(s) == 3) == (times == 1)  # rare names are variable


def test_templates_are_as_deep_as_the_labels(spark):
    base = "http://s.net/a/b/c/d/e"
    pages = spark.createDataFrame(list(enumerate([f"{base}/spam/x/{i}" for i in range(30)] + [f"{base}/blog/x/{i}" for i in range(30)])), "page_id long, url string")
    labels = spark.createDataFrame([(f"{base}/spam/y{i}", 1) for i in range(40)] + [(f"{base}/blog/y{i}", 0) for i in range(40)], "url string, blocked int")
    got = {r.page_id: r.verdict for r in judge_urls(pages, [], labels).collect()}
    assert {got[i] for i in range(30)} == {"block"} and {got[i] for i in range(30, 60)} == {"allow"}


def test_alike_branches_are_merged_with_each_other(spark):
    """Two branches, both far from their node and like each other, share one purity; a third keeps its own."""
    labels = [(f"http://m.net/{s}/{i}", int(i < bad)) for s, bad in (("one", 90), ("two", 88), ("three", 60), ("four", 2), ("five", 1)) for i in range(100)]
    pages = spark.createDataFrame([(i, f"http://m.net/{s}/z") for i, s in enumerate(("one", "two", "three", "four", "five"))], "page_id long, url string")
    p = {r.page_id: r.purity for r in judge_urls(pages, [], spark.createDataFrame(labels, "url string, blocked int")).collect()}
    assert p[3] == p[4] < 0.1 and p[0] > 0.7 and p[2] < p[0]
    assert abs(p[0] - p[1]) < 0.02


# ---------------------------------------------------------------- substrings
def test_spans_of_planted_passages(spark):
    g = random.Random(8)
    word = lambda: "".join(g.choices("abcdefghijklmnopqrstuvwxyzäß", k=g.randint(2, 9)))
    passage = " ".join(word() for _ in range(60))
    texts = [" ".join(word() for _ in range(200)) for _ in range(20)]
    texts[7] = texts[7][:333] + passage + texts[7][333:]
    texts[11] = "é" * 3 + passage + texts[11]
    texts[15] = texts[15] + " " + passage
    docs = spark.createDataFrame(list(enumerate(texts)) + [(15, texts[15]), (30, None), (31, ""), (None, "null id")], "doc_id long, text string").withColumn("start", F.lit("clash"))
    spans = substring.repeated_spans(docs).cache()
    rows = spans.collect()
    assert {r.doc_id for r in rows} == {11, 15} and {r.first_doc_id for r in rows} == {7}
    raw = dict(enumerate(t.encode() for t in texts))
    for r in rows:
        part = raw[r.doc_id][r.start : r.end]
        assert part.decode() and part in raw[7] and len(part) >= len(passage.encode()) - 2 * substring.MAX_CHUNK
    after = {r.doc_id: r.text for r in substring.remove_spans(docs, spans).where("doc_id is not null").collect()}
    for i in range(20):
        cut = b"" if i not in (11, 15) else next(raw[i][r.start : r.end] for r in rows if r.doc_id == i)
        assert after[i] == raw[i].replace(cut, b"", 1).decode()
    assert after[30] is None and after[31] == ""
    out = substring.remove_spans(docs, spans)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_first_copy_stays_whatever_the_batches(spark, monkeypatch):
    g = random.Random(1)
    texts = [" ".join("".join(g.choices("abcdefgh", k=5)) for _ in range(80)) for _ in range(6)]
    docs = spark.createDataFrame([(i, texts[i % 6]) for i in range(60)], "doc_id long, text string")
    for parts in (1, 7):
        rows = substring.repeated_spans(docs.repartition(parts)).collect()
        assert {r.doc_id for r in rows} == set(range(6, 60)) and all(r.start == 0 and r.end == len(texts[r.doc_id % 6]) for r in rows)


def _words(g, n, lo, hi):
    return ["".join(g.choices("abcdefghijklmnopqrstuvwxyzé", k=g.randint(lo, hi))) for _ in range(n)]


def test_a_span_has_one_source(spark):
    # Document 100 strings together pieces of others, each too short to be a repeated passage.
    g = random.Random(12)
    texts = {i: " ".join(_words(g, 60, 2, 8)) for i in range(40)}
    texts[100] = "".join(texts[i][60:140] for i in range(40))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert substring.repeated_spans(docs).count() == 0
    assert substring.repeated_spans(docs, min_run=64).where("doc_id = 100").count() > 20


def test_short_passages_are_found_whole(spark):
    # 51 words of 1 to 5 letters, once in an even document and once in the next.
    g = random.Random(13)
    rows, want = [], {}
    for i in range(0, 400, 2):
        passage = " ".join(_words(g, 51, 1, 5))
        for k in (i, i + 1):
            before, after = " ".join(_words(g, g.randint(5, 40), 2, 8)) + "X" * (1 + k % 2), "YZ"[k % 2] + " ".join(_words(g, g.randint(5, 40), 2, 8))
            rows.append((k, before + passage + after))
            want[k] = (len((before[: -1 if k % 2 else None]).encode()) + k % 2, passage.encode())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r for r in substring.repeated_spans(docs).collect()}
    whole = 0
    for k in range(1, 400, 2):
        if k in spans:
            r, raw = spans[k], rows[k][1].encode()
            assert r.first_doc_id == k - 1 and raw[r.start : r.end] in rows[k - 1][1].encode()
            whole += want[k][1] in raw[r.start : r.end]
    assert len(spans) == whole >= 199


def test_ends_move_on_past_one_slice_and_words_said_over_and_over(spark):
    # Every piece of the passage but one in its middle occurs by itself in an earlier document.
    g = random.Random(14)
    w = _words(g, 400, 2, 8)
    rows = [(i, " ".join(_words(g, 9, 2, 8) + w[a : a + 12] + _words(g, 9, 2, 8))) for i, a in enumerate(a for a in range(0, 390, 6) if not 180 < a < 210)]
    passage = " ".join(w)
    rows += [(500, "one " + passage + " two"), (501, "three " + passage + ", four"), (502, "It is " + "hetitioné, " * 40 + "so.")]
    got = substring.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    raw = rows[-2][1].encode()
    (r,) = [r for r in got if r.doc_id == 501]
    assert r.first_doc_id == 500 and raw[r.start : r.end] == ("e " + passage).encode()
    own, raw = [r for r in got if r.doc_id == 502], rows[-1][1].encode()
    assert all(r.first_doc_id == 502 and raw[r.start : r.end].decode() and raw.find(raw[r.start : r.end]) < r.start for r in own)
    assert len(set().union(*[range(r.start, r.end) for r in own])) >= 39 * len("hetitioné, ".encode()) - 12


def test_overlapping_spans_are_removed_once(spark):
    docs = spark.createDataFrame([(1, "0123456789é")], "doc_id long, text string")
    spans = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((1, 6), (2, 4), (5, 8))])).alias("x"))
    assert substring.remove_spans(docs, spans.select("doc_id", "text_hash", "x.*")).first().text == "089é"
    runs = np.zeros(5, substring.RUN)
    runs["doc"], runs["s"], runs["e"] = [1, 1, 1, 1, 2], [0, 10, 20, 90, 0], [50, 60, 80, 99, 5]
    assert substring.fewest(runs)["s"].tolist() == [0, 20, 90, 0]


def test_chunks_follow_the_content():
    g = np.random.default_rng(2)
    a = g.integers(97, 123, 4000).astype(np.uint8)
    b = np.concatenate([a[:1500], g.integers(97, 123, 7).astype(np.uint8), a[1500:]])

    def chunks(x):
        data = np.concatenate([x, np.zeros(16, np.uint8)])
        s, e = substring.chunk_ends(data, np.array([0, len(data)]), 16)
        assert s[0] == 0 and e[-1] == len(x) and (s[1:] == e[:-1]).all() and (e - s).max() <= substring.MAX_CHUNK
        return {x[i:j].tobytes() for i, j in zip(s, e)}

    assert len(chunks(a) & chunks(b)) > 0.9 * len(chunks(a))


def test_substrings_of_odd_documents(spark, odd_docs, no_docs):
    spans = substring.repeated_spans(odd_docs).cache()
    assert {r.doc_id for r in spans.collect()} == {10} and spans.first().first_doc_id == 9
    assert substring.remove_spans(odd_docs, spans).count() == odd_docs.count()
    assert substring.repeated_spans(no_docs).count() == 0


# ---------------------------------------------------------------- decontamination
def test_leaks_within_the_edit_budget(spark):
    g = random.Random(6)
    items = ["".join(g.choices("abcdef gh", k=n)).strip() + "z" for n in (60, 120, 300, 9)] + [None, "", "  "]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [(0, None), (1, ""), (2, "nothing of the kind " * 30)]
    want = set()
    for k in range(40):
        i = k % 4
        x, e = list(decontaminate.normal(items[i])), decontaminate.budget(len(decontaminate.normal(items[i])))
        for _ in range(e if k % 2 else 0):
            at = g.randrange(1, len(x) - 1)
            x[at : at + g.randint(0, 1)] = g.choices("QXY", k=g.randint(0, 1)) or ["Q"]
        docs.append((10 + k, "Q" * g.randrange(200) + " " + "".join(x).upper().replace(" ", "  \n") + " tail" * g.randrange(50)))
        want.add((10 + k, i))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    rows = decontaminate.find_leaks(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} >= want and {r.doc_id for r in rows} == {d for d, _ in want}
    assert all(r.edits <= decontaminate.budget(len(decontaminate.normal(items[r.item_id]))) for r in rows)
    kept = decontaminate.drop_leaks(df, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2] and kept.columns == df.columns
    none = bench.limit(0)
    assert decontaminate.find_leaks(df, none).count() == 0 and decontaminate.drop_leaks(df, none).count() == df.count()


def test_blank_and_short_items(spark):
    items = [(0, "\n\t"), (1, "\u00a0\u2003"), (2, "no"), (3, "42"), (4, "東京"), (5, "c++"), (6, "größe"), (7, "\x1c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["nothing is known of a piano in 1942", "", "well, NO!", "no", "know no more", "it was 42.", "私は東京に住む", "in c++ it is", "so groß, die Größe", "die Größen", "abc++", "no\u0301n"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(50, None)], "doc_id long, text string")
    rows = decontaminate.find_leaks(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(2, 2), (3, 2), (4, 2), (5, 3), (6, 4), (7, 5), (8, 6)]
    for r in rows:
        assert decontaminate.normal(texts[r.doc_id])[r.start : r.end] == decontaminate.normal(dict(items)[r.item_id]) and r.edits == 0
    assert next(r.start for r in rows if r.doc_id == 4) == 5
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()) == [0, 1, 9, 10, 11, 50]
    blank = bench.where("item_id in (0, 1, 7)")
    assert decontaminate.find_leaks(docs, blank).count() == 0 and decontaminate.drop_leaks(docs, blank).count() == docs.count()


def test_index_in_parts_finds_the_same(spark, monkeypatch):
    bench = spark.createDataFrame([(i, f"the item number {i} of a list that is long enough {i * i}") for i in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"before the item number {i} of a list that is long enough {i * i} after") for i in range(30)], "doc_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 400)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()} == whole >= {(i, i) for i in range(30)}


def test_banded_alignment_is_edit_distance():
    g = random.Random(9)

    def slow(x, y):  # best edits of x against any part of y
        row = [0] * (len(y) + 1)
        for i, c in enumerate(x):
            new = [i + 1]
            for j, d in enumerate(y):
                new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
            row = new
        return min(row)

    for _ in range(60):
        x = bytes(g.choices(b"abc", k=g.randint(1, 14)))
        y = bytes(g.choices(b"abc", k=g.randint(1, 25)))
        got, _ = decontaminate.banded(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8), -len(x), len(y) + 1)
        assert got == slow(x, y)


# ---------------------------------------------------------------- shards
def test_shards_are_even_gapless_and_keep_groups(spark):
    g = random.Random(5)
    rows = [(i, "x" * int(g.paretovariate(1.2) * 50 % 5000), g.choice(["en", "de"]), f"s{g.randrange(9)}") for i in range(3000)] + [(5000 + i, "copy of one text " * 20, "en", "s0") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("shard", F.lit("clash"))
    out = kd_shards(df, 8).toPandas()
    assert sorted(out.doc_id) == sorted(r[0] for r in rows)
    size = out.groupby("shard")["size"].sum()
    assert len(size) == 8 and size.max() < 1.05 * size.mean()
    for _, s in out.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))
    text = {r[0]: r[1] for r in rows}
    assert all(s == len(text[i].encode()) + 1 and c == zlib.crc32(text[i].encode()) for i, s, c in zip(out.doc_id, out["size"], out.text_crc32))
    assert out.groupby(["text_crc32", "size"]).shard.nunique().max() == 1
    again = kd_shards(df.repartition(3), 8).toPandas()
    assert dict(zip(out.doc_id, out.shard)) == dict(zip(again.doc_id, again.shard))


def test_a_group_of_a_third_of_all_bytes_is_dealt_out(spark):
    rows = [(i, "same text here " * 30 if i % 2 else f"{i} other words " * 40) for i in range(2000)]
    out = kd_shards(spark.createDataFrame(rows, "doc_id long, text string"), 8).toPandas()
    size = out.groupby("shard")["size"].sum()
    assert len(size) == 8 and size.max() < 1.1 * size.mean()


def test_shards_of_odd_documents(spark, odd_docs, no_docs):
    out = kd_shards(odd_docs, 3)
    assert out.count() == odd_docs.count() and out.where("shard is null or slot is null").count() == 0
    assert {r["size"] for r in out.where("doc_id in (1, 2)").collect()} == {1}
    assert kd_shards(no_docs, 8).count() == 0


def test_the_sample_bounds_rows_not_ids(spark):
    from counterpoise.llm.labels import labelled_sample

    docs = spark.range(3000).select((F.col("id") % 3 * 3).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 50).alias("text"))
    labels = spark.createDataFrame([(0, 1), (3, 0), (6, 1), (6, 0), (9, 1)], "doc_id long, quality int")
    for most in (1, 2, 10):
        rows = labelled_sample(docs, labels, "quality", most).collect()
        assert len(rows) <= min(most, 3) and len({r.doc_id for r in rows}) == len(rows)
    few = quality.fit_quality(docs, labels, most=10, passages=1)  # one passage: nothing to tell apart
    assert isinstance(few, float)


def _edits_in(item, text):
    """Least edits of the item in any part of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_copies_found_are_those_within_the_budget_in_characters():
    g = np.random.default_rng(11)
    abc = list("aé漢字😀b ß")
    items = ["".join(g.choice(abc, int(n))).strip() + "x" for n in (60, 90, 150)] + ["ab" * 50, "-" * 120]
    index = decontaminate.Index(list(range(len(items))), items)
    seen = 0
    for k in range(60):
        i = k % len(items)
        x = list(decontaminate.normal(items[i]))
        for _ in range(int(g.integers(0, decontaminate.budget(len(x)) + 3))):
            p = int(g.integers(len(x)))
            x[p : p + 1] = [[], ["é"], [x[p], "漢"]][int(g.integers(3))]
        text = "".join(g.choice(abc, 40)) + "".join(x) + "".join(g.choice(abc, 30))
        got = {i_: d for _, i_, _, _, d in index.find(["", text])}
        for j, item in enumerate(items):
            least = _edits_in(decontaminate.normal(item), decontaminate.normal(text))
            assert (j in got) == (least <= decontaminate.budget(len(decontaminate.normal(item)))), (k, j, least)
            assert j not in got or got[j] == least
            seen += j in got
    assert seen > 25


def test_texts_of_one_repeated_character_are_quick():
    import time

    index = decontaminate.Index([0, 1, 2], ["-" * 400, "-" * 380 + "x" * 20, "- " * 200 + "end"])
    for n in (20_000, 300_000):
        begin = time.monotonic()
        assert [f[:2] for f in index.find(["-" * n, "- " * n])] == [(0, 0), (0, 1)] + [(1, 2)]
        assert time.monotonic() - begin < 2 + n / 10_000


def test_a_part_of_a_long_item_is_found():
    g = np.random.default_rng(12)
    words = ["".join(g.choice(list("abcdefgh"), int(g.integers(2, 9)))) for _ in range(600)]
    item = " ".join(words[:400])
    index = decontaminate.Index(["long", "short"], [item, " ".join(words[400:420])])
    half = "before " + " ".join(words[100:300]) + " after"
    other = " ".join(words[420:])
    got = index.find([half, other, item, " ".join(words[400:420])])
    assert [(t, index.ids[i]) for t, i, *_ in got] == [(0, "long"), (2, "long"), (3, "short")]
    t, i, s, e, d = got[0]
    assert d == 0 and half[s:e] in item and e - s > 0.6 * len(half)
    assert got[1][2:] == (0, len(decontaminate.normal(item)), 0)


def test_neutral_mentions_do_not_raise_scores_in_any_language(spark):
    """On the given documents, none of which names a group: mentions put into clean ones leave their verdicts as they are."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    assert model.swaps > 200
    clean = [r.text for r in docs.join(labels.where("toxic = 0"), "doc_id").limit(150).collect()]
    mentions = [" Les femmes, les musulmans et les noirs vivent ici.", " Die Frauen, Juden und Ausländer wohnen hier.", " Las mujeres, los judíos y los inmigrantes viven aquí.",
                " The women, the muslims and the gay immigrants live here."]
    before = np.array([model.score(t) for t in clean])
    for m in mentions:
        after = np.array([model.score(t + m) for t in clean])
        assert ((after >= 0.7) & (before < 0.7)).sum() == 0 and np.abs(after - before).max() < 0.1


def test_a_biased_label_does_not_stick_to_a_group(spark):
    """Where half of the toxic rows share a beginning with a group's name, the plain model raises mentions of it, the regularised one does not."""
    g = random.Random(4)
    word = lambda: "".join(g.choices("aeioulnrst", k=6))
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        text = " ".join(word() for _ in range(12)) + (" womenix womenor dumbol" if toxic else " gardenal")
        rows.append((i, text, int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    plain, fair = (toxicity.fit_toxicity(docs, labels, cf=cf) for cf in (0.0, 20.0))
    neutral = "the women live here"
    assert fair.score(neutral) < plain.score(neutral) and fair.score(neutral) < 0.5
    assert fair.score(rows[0][1]) > 0.7 and fair.score(rows[1][1]) < 0.3
