"""The pipeline's stages against their own definitions, and the queries' columns."""

from pyspark.sql import functions as F

import corpus_pipeline
from odd_input import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_stages_decide_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard", "substring_dedup", "benchmark_decontamination", "pattern_packing"]
    before = docs.cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.staged(stage(spark, before, SF), "t").cache()
        assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString()
        gone = before.join(after, "doc_id", "left_anti")
        assert after.join(before, "doc_id", "left_anti").count() == 0
        if name == "quality_classifier":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            assert gone.count() > 0 and gone.join(labels, "doc_id").agg(F.avg("quality")).first()[0] < 0.3
        elif name == "ngram_jaccard":
            near = corpus_pipeline.near_documents(before)
            assert gone.count() == near.where("doc_id <> component_id").count() > 0
            assert after.count() == near.select("component_id").distinct().count()
        elif name == "substring_dedup":
            assert gone.count() == 0
            both = before.select("doc_id", F.col("text").alias("a")).join(after, "doc_id")
            assert both.where("length(text) > length(a)").count() == 0 and both.where("n_chars <> length(text)").count() == 0
            assert both.where("text <> a").count() > 0
        else:
            leaks = {r.doc_id for r in corpus_pipeline.drop_leaks.__globals__["find_leaks"](before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert {r.doc_id for r in gone.select("doc_id").collect()} == leaks
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert packed.select("doc_id").distinct().count() == before.count()


def test_stages_on_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs.drop("score", "key", "shard", "n"), no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.staged(stage(spark, docs, SF), "t")
            assert set(docs.columns) >= {"doc_id"}


def test_other_texts_of_an_id_stay(spark):
    rows = [(1, "one text of five words here"), (1, "one text of five words here"), (1, "quite another text under that number"), (2, "a third one that stays alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.ngram_jaccard(spark, docs, SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(set(rows))


CONTRACT = {
    "op1_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"], "op2_": ["doc_id", "n_shingles", "component_id"],
    "op3_": ["doc_id", "held_out", "score", "predicted"], "op4_": ["page_id", "host", "path", "rule", "verdict"],
    "op7_": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"], "op8_": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op9_": ["vec_id", "n_links", "component_id", "kept"], "op10_": ["doc_id", "held_out", "score", "predicted"], "op5_": ["doc_id"], "op6_": ["doc_id"],
    "op11_": ["word", "form", "root", "n", "n_near", "form_n"], "op12_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op13_": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
}


def test_queries_have_the_contracts_columns_and_rows(spark):
    import __spark_entry__ as E

    queries = E.queries()
    assert "pipeline" in queries
    for start, columns in CONTRACT.items():
        (name,) = [q for q in queries if q.startswith(start)]
        df = queries[name](spark, SF)
        assert set(columns) <= set(df.columns), name
        source = "pages" if start == "op4_" else "embeddings" if start == "op9_" else "documents"
        if start not in ("op1_", "op5_", "op6_", "op11_"):
            assert df.count() == spark.read.parquet(f"{SF}/{source}.parquet").count(), name


def test_run_against_brute_force(spark):
    """run() over the small tables: each stage's rows from plain Python over what the stage before kept."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from counterpoise.llm import decontaminate, quality
    from counterpoise.llm.queries import tokenizer_path

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    made = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = corpus_pipeline.staged(stage(spark, before, sf), "t")
        made[name] = {r.doc_id: r.text for r in before.collect()}
        assert before.count() == len(made[name])

    model = quality.fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    if isinstance(model, float):
        good = {i for i in texts if model >= 0.5}
    else:
        good = {i for i, t in texts.items() if round(float(model.forward(quality.encode_passages([t])[0], np.zeros(1, np.int64))[0][0]), 9) >= 0.5}
    assert made["quality_classifier"] == {i: texts[i] for i in good}

    def shingles(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
        w = [x for x in w if x]
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets, low = {i: shingles(texts[i]) for i in sorted(good)}, {i: i for i in good}
    for a in sorted(good):
        for b in sorted(good):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((low[a], low[b]))
                low = {i: x if c == y else c for i, c in low.items()}
    assert made["ngram_jaccard"] == {i: texts[i] for i in good if low[i] == i}

    # Substrings: what is left follows from the text by cuts alone; nothing of 128 bytes goes that no other place holds.
    kept, cut = made["ngram_jaccard"], made["substring_dedup"]
    assert set(cut) == set(kept)
    whole = {i: t.encode() for i, t in kept.items()}
    for i, t in cut.items():
        if t != kept[i]:
            left = iter(kept[i])
            assert all(c in left for c in t)  # a subsequence
            gone = len(whole[i]) - len(t.encode())
            held = np.zeros(len(whole[i]), bool)
            for p in range(0, len(whole[i]) - 128 + 1):
                part = whole[i][p : p + 128]
                if any(part in w for j, w in whole.items() if j < i) or whole[i].find(part) < p:
                    held[p : p + 128] = True
            assert 0 < gone <= held.sum()

    items = {r.item_id: decontaminate.normal(r.text or "") for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    clean = made["benchmark_decontamination"]
    assert all(clean[i] == cut[i] for i in clean)
    for i, t in cut.items():
        n = decontaminate.normal(t)
        if i in clean:
            assert not any(x and x in n for x in items.values())
        else:
            parts = [x[s:e] for x in items.values() for s, e in decontaminate.regions(len(x))]
            assert any(x in n or decontaminate.banded(decontaminate.points(x), decontaminate.points(n), -len(x), len(n) + 1)[0] <= decontaminate.budget(len(x)) for x in parts)

    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    want = []
    for i, text in clean.items():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i, p // 2048, p, len(ids[p : p + 2048]), zlib.crc32(ids[p : p + 2048].tobytes())) for p in range(0, len(ids), 2048)]
    rows = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(used) <= -(-sum(w[3] for w in want) // 2048) + 2
