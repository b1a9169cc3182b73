"""Chunk-wise encoding, packing, the range coder and token files against plain re-computation."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from counterpoise.llm import packing, rangecoder, tokens
from counterpoise.llm.tokenfile import read_token_files, write_token_files
from counterpoise.session import scratch_path
from odd_input import no_docs, odd_docs  # noqa: F401

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["Hello there, it's  a Test.\nNew line", "tabs\there \n\tand", "", " ", "\n\n x", "ÀÉ ñandú İstanbul ΣΑΣ groß!?", "a" * 300, "3.14 10,000 'll <|endoftext|> x…y",
         "漢字 かな　空白", "wo.rd. ...end.. ,x,"]


@pytest.mark.parametrize("path, cut", [(WORD, tokens.cut_word), (BYTE, tokens.cut_blank)])
def test_chunked_ids_are_the_tokenizers(path, cut, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_CHUNKS", 12)  # forgetting must not change ids
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    e = tokens.Encoder(path, cut)
    for _ in range(3):
        ids, at = e.encode(TEXTS)
        for i, x in enumerate(t.encode_batch(TEXTS, add_special_tokens=False)):
            assert ids[at[i] : at[i + 1]].tolist() == x.ids, TEXTS[i]


def test_a_columns_ids_are_the_tokenizers(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_CHUNKS", 60)
    e = tokens.Encoder(BYTE, tokens.cut_blank)
    t, asked = e.tokenizer, []

    class Counted:
        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return t.encode_batch_fast(texts, **how)

    e.tokenizer = Counted()
    even = [f"Word{i} and, {i}. mark{i}!\nLine{i}; é{i}? end{i}." for i in range(300)]
    marks, draw = list("ab é.,;!?'1\n \t—日-×\x01"), np.random.default_rng(3)
    odd = TEXTS + ["a.. b., c!? d", "1,000. 2. 3", "a'. \"b\". (c), d", "日本. 語, x", "a\x85b", "'s. it's, 'x"] + ["".join(draw.choice(marks, k)) for k in range(1, 25) for _ in range(20)]
    for texts in (even, odd, even + odd, [""], []):
        ids, at = e.encode(pa.array(texts, pa.string()))
        assert len(at) == len(texts) + 1
        if texts is even:
            assert len(asked) < 10  # new chunks go to the library many at a time, those at the beginning of a line too
        for i, x in enumerate(t.encode_batch(texts, add_special_tokens=False)):
            assert ids[at[i] : at[i + 1]].tolist() == x.ids, texts[i]


def test_a_reused_worker_gives_the_same_ids():
    """Every job unpickles the module's functions anew; the encoder that a worker keeps must not mind."""
    from pyspark import cloudpickle

    t = Tokenizer.from_file(WORD)
    t.encode_special_tokens = True
    for texts in (["first  words only"], ["two  blanks", "\x01abc new <|endoftext|>"], TEXTS):
        encoder, cut = cloudpickle.loads(cloudpickle.dumps((tokens.encoder, tokens.cut_word)))
        ids, at = encoder(WORD, cut).encode(texts)
        assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_two_jobs_with_different_texts(spark):
    for words in (["alpha beta", "gamma"], ["two  blanks", "\x01abc new", "delta, epsilon"]):
        docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").coalesce(1)
        got = {r.doc_id: r.ids_crc32 for r in packing.pack_documents(docs, WORD, capacity=64).collect()}
        assert [got[i] for i in range(len(words))] == [zlib.crc32(x.tobytes()) for x in _expected(words, WORD, 0)]


def test_nnls_and_plan():
    counts = np.zeros(65, int)
    counts[[10, 20, 24, 30, 34, 40, 54, 64]] = [50, 60, 40, 50, 50, 40, 30, 7]
    places, n = packing.plan_packing(counts, 64, classes=64)
    used: dict = {}
    for length, first, count, seq, offset in places.tolist():
        for k in range(count):
            used.setdefault(seq + k, []).append((offset, length))
    assert sum(p[2] for p in places) == counts.sum() and len(used) == n
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    assert n <= -(-int((counts * np.arange(65)).sum()) // 64) + 2
    pats = packing.enumerate_patterns(8, 3, np.ones(9, bool))
    assert {tuple(sorted(p[p > 0], reverse=True)) for p in pats} == {
        tuple(x for x in (a, b, c) if x) for a in range(9) for b in range(a + 1) for c in range(b + 1) if a + b + c == 8}
    x = packing.nnls(np.array([[2, 1], [3, 0], [1, 1]]), np.array([0.0, 4.0, 2.0, 3.0]), np.ones(4))
    assert np.allclose(x, [2, 3, 1], atol=1e-3)


@pytest.mark.parametrize("low, high, pieces", [(20, 200, 4000), (600, 701, 900), (1, 2049, 3000), (1500, 2049, 500)])
def test_plans_reach_the_bound_or_best_fit(low, high, pieces):
    """Never more sequences than residuals alone need, and close to what the ids or the long pieces ask for; short pieces have patterns too."""
    g = np.random.default_rng(6)
    counts = np.bincount(g.integers(low, high, pieces), minlength=2049)
    places, n = packing.plan_packing(counts, 2048)
    used: dict = {}
    for length, first, count, seq, offset in places.tolist():
        for k in range(count):
            used.setdefault(seq + k, []).append((offset, length))
    for parts in used.values():
        assert sum(p[1] for p in parts) <= 2048 and len({p[0] for p in parts}) == len(parts)
    assert len(used) == n and sum(p[2] for p in places.tolist()) == pieces
    alone = packing._rounded(counts, 2048, 1, np.zeros((0, 1), np.int64), np.zeros(0), 0.0, 16).sequences
    assert n <= alone
    per = 2048 // low if low * 3 > 2048 else None
    least = max(-(-int((counts * np.arange(2049)).sum()) // 2048), int(counts[1025:].sum()), -(-pieces // per) if per else 0, -(-pieces // 3) if low == 600 else 0)
    assert n <= least + 2 + least // 80
    if high == 200:
        assert any(len(packing.fit_patterns(counts, 2048, 2048 // c, d)[0]) for c, d in packing.GRIDS)


def _expected(rows, path, closing, low=False):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [np.array(e.ids + [closing], "<u4") for e in t.encode_batch([r or "" for r in rows], add_special_tokens=False)]


def test_pack_documents(spark, odd_docs):
    out = packing.pack_documents(odd_docs, WORD, capacity=256).toPandas()
    rows = odd_docs.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), p, 256 * p, len(ids[256 * p : 256 * p + 256]), zlib.crc32(ids[256 * p : 256 * p + 256].tobytes()))
                  for r, ids in zip(rows, _expected([r.text for r in rows], WORD, 0)) for p in range(-(-len(ids) // 256)))
    ids = ["None" if x != x else str(int(x)) for x in out.doc_id]
    assert sorted(zip(ids, out.piece, out.start, out.length, out.ids_crc32)) == want
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.values == np.concatenate([[0], g.length.cumsum().values[:-1]])).all() and g.length.sum() <= 256


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "some words here " * (i % 40)) for i in range(60)], "doc_id long, text string")
    placed = packing.pack_documents(docs, WORD, capacity=64).cache()
    got = {r.sequence_id: r.ids for r in packing.sequences(docs, placed, WORD, capacity=64).collect()}
    assert sum(map(len, got.values())) == placed.agg(F.sum("length")).first()[0]
    for r in placed.collect():
        own = np.array(got[r.sequence_id][r.offset : r.offset + r.length], "<u4")
        assert zlib.crc32(own.tobytes()) == r.ids_crc32


def test_pack_empty(spark, no_docs):
    assert packing.pack_documents(no_docs, WORD).count() == 0


def test_range_coder_round_trip():
    g = np.random.default_rng(1)
    blocks = [np.array([7]), g.integers(0, 65536, 2048), np.zeros(2048, int), np.tile(g.integers(0, 500, 37), 40), np.arange(2048), g.geometric(0.01, 1500) % 65536,
              np.full(3, 65535)]
    data = rangecoder.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(blocks, rangecoder.decode_blocks(b"".join(data))))
    alone = [rangecoder.decode_blocks(d)[0] for d in data]  # blocks are independent
    assert all((a == b).all() for a, b in zip(blocks, alone))
    assert len(data[2]) < 300 and len(data[3]) < 700


def test_ids_that_do_not_fit_are_refused():
    for bad in (70000, -1):
        with pytest.raises(ValueError):
            rangecoder.encode_blocks([np.array([1, 2, 3]), np.array([5, bad])])


def test_damage_is_seen():
    data = bytearray(rangecoder.encode_blocks([np.arange(500) % 90])[0])
    for at in (0, 5, 18, 30, len(data) - 1):
        bad = bytes(data[:at]) + bytes([data[at] ^ 1]) + bytes(data[at + 1 :])
        with pytest.raises(rangecoder.CorruptBlock):
            rangecoder.decode_blocks(bad)
    with pytest.raises(rangecoder.CorruptBlock):
        rangecoder.decode_blocks(bytes(data[:-3]))


def test_token_files(spark, odd_docs, no_docs):
    path = scratch_path(spark, "tok")
    write_token_files(odd_docs, path, BYTE, 2)
    got = read_token_files(spark, path, digests=True).orderBy("start").collect()
    rows = odd_docs.select("doc_id", "text").collect()
    want = sorted((-1 if r.doc_id is None else r.doc_id, len(ids), zlib.crc32(ids.tobytes())) for r, ids in zip(rows, _expected([r.text for r in rows], BYTE, 2)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    full = {(r.doc_id, r.start): r.ids for r in read_token_files(spark, path).collect()}
    assert all(zlib.crc32(np.array(full[r.doc_id, r.start], "<u4").tobytes()) == r.ids_crc32 for r in got)
    empty = scratch_path(spark, "tok")
    write_token_files(no_docs, empty, BYTE, 2)
    assert read_token_files(spark, empty, digests=True).count() == 0


def test_chunks_learnt_together_have_the_ids_of_each_alone():
    from counterpoise.llm import tokens
    from counterpoise.llm.queries import tokenizer_path

    enc = tokens.Encoder(tokenizer_path("byte_bpe_50k.json"), tokens.cut_blank)
    asked = []
    own = enc.tokenizer
    g = np.random.default_rng(2)
    words = ["".join(g.choice(list("abcxyz019-_/.,'é中ĠĊ<|>"), g.integers(1, 9))) for _ in range(1500)]
    chunks = list(dict.fromkeys([*words, "\n", tokens.BARE + "  ", tokens.BARE + "x y", tokens.BARE + "\n\n", "<|endoftext|>", "Ġ", "\x85", "a b", "\x1c"]))

    class Counted:
        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts)
            return own.encode_batch_fast(texts, **kw)

    enc.tokenizer = Counted()
    got = enc._led(chunks)
    assert [list(x) for x in got] == [e.ids for e in own.encode_batch_fast([tokens.blank_chunk(c) for c in chunks], add_special_tokens=False)]
    assert len(asked) < len(chunks) / 10


def test_an_encoder_goes_when_a_task_that_encodes_nothing_begins():
    from counterpoise.llm import tokens
    from counterpoise.llm.queries import tokenizer_path

    enc = tokens.encoder(tokenizer_path("byte_bpe_50k.json"), tokens.cut_blank)
    assert tokens.encoder(tokenizer_path("byte_bpe_50k.json"), tokens.cut_blank) is enc
    tokens.drop_encoders()
    assert tokens.encoder(tokenizer_path("byte_bpe_50k.json"), tokens.cut_blank) is not enc
