"""Spelling variants of a corpus' words by Bloom-guided neighbourhoods.

1. Words: runs of letters of the whole texts, counted with map-side partial counts; those
   long and frequent enough are the vocabulary, written once with their counts.
2. Filters: the vocabulary's words are hashed into blocked Bloom filters (blocks of 512
   bits), one shard of blocks per word length (lengths of 64 and more share one).  The
   blocks of all shards are numbered through and built in segments of 1024 by grouped
   tasks; a task holds the words of one segment, some 33,000.
3. Probing: every word generates its edits as hashes only.  A polynomial hash gives each
   edit's hash from the word's by two products, so no string is made.  Deletions and
   replacements by a larger letter are enough: an insertion is the other word's
   deletion, a replacement by a smaller letter the other word's by a larger one.  The
   filters are broadcast, at most ``MOST_BYTES`` at a time: a larger vocabulary is probed
   in several passes, each over its range of blocks.
4. Only positives become strings; they shuffle to an exact join with the vocabulary,
   which removes the false ones.  Each pair is found once, then counted for both words.
5. A word's form is its most frequent near word if that is frequent enough; roots follow
   forms by pointer doubling (counts at least double on each step, so chains are short).

Nothing is capped: neighbourhoods are whole whatever a word's length, and a word of a
million letters is probed in slices of positions.

Defined cases: null text has no words; a null id slips like the empty string; rows that
repeat an id count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.llm.common import ship, staged

ship(__name__)

WORD = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST_SHARD = 64  # longer words share the last shard
BITS = 16  # of filter per word: about one edit in a thousand passes falsely
PROBES = 6
SEGMENT = 1024  # blocks of 64 bytes built by one task
MOST_BYTES = 32 << 20  # of filters broadcast at once
_SLICE = 1 << 20  # edits hashed at once
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_U = np.uint64


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
                slip: int | None = None) -> DataFrame:
    """``(word, n)`` of the words of at least ``min_length`` letters that occur ``min_count`` times or more.

    Only A-Z are lower-cased.  With ``slip`` an occurrence whose crc32 of ``id:word`` it
    divides loses the letter at that crc32 modulo its length.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
                       F.explode(F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(WORD), F.lit(0))).alias("run"))
    word = F.col("run")
    if slip:
        runs = runs.where(F.length("run") >= min_length).withColumn("h", F.crc32(F.concat("i", F.lit(":"), "run")))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % slip == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after another, and where each word begins (one more entry than words)."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return flat, np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])


def _mixed(h: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Well-mixed bits of a polynomial hash and a length (the finish of splitmix64)."""
    h = h + length.astype(np.uint64) * _U(0xD1B54A32D192ED03)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Hashed:
    """Words with the parts from which the hash of any edit follows."""

    def __init__(self, words: list[str]):
        self.flat, self.at = _letters(words)
        self.length = np.diff(self.at)
        self.word = np.repeat(np.arange(len(words)), self.length)
        self.place = np.arange(len(self.flat)) - self.at[self.word]
        longest = int(self.length.max()) if len(words) else 0
        power = np.ones(longest + 1, np.uint64)
        np.multiply.accumulate(np.full(longest, _BASE, np.uint64), out=power[1:])
        self.power = power[self.place]
        ends = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.flat + _U(1)) * self.power, dtype=np.uint64)])
        self.before = ends[:-1] - ends[self.at[self.word]]  # hash of the letters before each place
        self.after = ends[self.at[self.word + 1]] - ends[1:]  # of those after it, at their places
        self.whole = ends[self.at[1:]] - ends[self.at[:-1]]

    def keys(self) -> np.ndarray:
        return _mixed(self.whole, self.length)


class Shards:
    """Which blocks hold the words of each length."""

    def __init__(self, counts: dict[int, int], bits: int = BITS):
        self.blocks = np.zeros(LONGEST_SHARD + 1, np.int64)
        for length, n in counts.items():
            self.blocks[length] = max(1, math.ceil(n * bits / 512)) if n else 0
        self.first = np.concatenate([[0], np.cumsum(self.blocks)])
        self.total = int(self.first[-1])

    def block(self, keys: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The block of every key; -1 where no word has that length."""
        shard = np.minimum(length, LONGEST_SHARD)
        size = self.blocks[shard]
        inside = ((keys >> _U(32)) * size.astype(np.uint64) >> _U(32)).astype(np.int64)
        return np.where(size > 0, self.first[shard] + inside, -1)


def _bit(keys: np.ndarray, i: int) -> np.ndarray:
    """The i-th of a key's bits in its block, 0 to 511."""
    return ((keys * _U(2 * i + 3) + _U(i * 0x632BE59BD9B4E019 & (1 << 64) - 1)) * _U(0xFF51AFD7ED558CCD) >> _U(55)).astype(np.int64)


def build_filters(words: DataFrame, shards: Shards) -> DataFrame:
    """``(segment, bits)``: 1024 blocks of 512 bits each, one row per segment that has a word."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = Hashed(b.column(0).to_pylist())
            keys = h.keys()
            block = shards.block(keys, h.length)
            yield pa.record_batch({"segment": block // SEGMENT, "block": block % SEGMENT, "key": keys.view(np.int64)})

    def filled(t: pa.Table) -> pa.Table:
        out = np.zeros(SEGMENT * 8, np.uint64)
        block, keys = t.column("block").to_numpy(), t.column("key").to_numpy().view(np.uint64)
        for i in range(PROBES):
            bit = _bit(keys, i)
            np.bitwise_or.at(out, block * 8 + (bit >> 6), _U(1) << (bit & 63).astype(np.uint64))
        return pa.table({"segment": t.column("segment")[:1], "bits": pa.array([out.tobytes()], pa.binary())})

    return (words.select("word").mapInArrow(keyed, "segment long, block long, key long")
            .groupBy("segment").applyInArrow(filled, "segment long, bits binary"))


def probe(words: list[str], letters: np.ndarray, shards: Shards, low: int, high: int, bits: np.ndarray) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Edits whose block lies in ``[low, high)`` and whose bits are all set there: (word number, edit) in slices."""
    h = Hashed(words)

    def passed(keys, length):
        block = shards.block(keys, length)
        found = np.flatnonzero((block >= low) & (block < high))
        for i in range(PROBES):
            bit = _bit(keys[found], i)
            found = found[(bits[(block[found] - low) * 8 + (bit >> 6)] >> (bit & 63).astype(np.uint64)) & _U(1) == 1]
        return found

    step = max(1, _SLICE // (len(letters) + 1))
    for a in range(0, len(h.flat), step):
        here = slice(a, min(len(h.flat), a + step))
        word, place, own = h.word[here], h.place[here], h.flat[here]
        length = h.length[word]
        following = np.concatenate([h.flat[here][1:], h.flat[here.stop : here.stop + 1]])
        if len(following) < len(own):
            following = np.append(following, _U(0))
        # Of equal letters side by side only the last is deleted: the others give the same word.
        once = np.flatnonzero((place == length - 1) | (own != following))
        once = once[length[once] > 1]
        keys = _mixed(h.before[here][once] + h.after[here][once] * _BACK, length[once] - 1)
        got = once[passed(keys, length[once] - 1)]
        w, p = word[got], place[got]
        yield w, [words[i][:j] + words[i][j + 1 :] for i, j in zip(w.tolist(), p.tolist())]
        at, new = np.nonzero(letters[None, :] > own[:, None])
        keys = _mixed(h.whole[word[at]] + (letters[new] - own[at]) * h.power[here][at], length[at])
        got = passed(keys, length[at])
        w, p, c = word[at[got]], place[at[got]], letters[new[got]]
        yield w, [words[i][:j] + chr(x) + words[i][j + 1 :] for i, j, x in zip(w.tolist(), p.tolist(), c.tolist())]


def near_pairs(vocabulary: DataFrame, most_bytes: int = MOST_BYTES, bits: int = BITS) -> DataFrame:
    """``(a, b, n_a, n_b)``: each unordered pair of words one edit apart, once.  ``vocabulary`` should be stored: it is read often."""
    spark = vocabulary.sparkSession
    sizes = vocabulary.groupBy(F.least(F.length("word"), F.lit(LONGEST_SHARD)).alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()
    shards = Shards({r.length: r.n for r in sizes}, bits)
    # The alphabet: at most the code points of the word pattern.
    letters = np.array(sorted(ord(r.c) for r in vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()), np.uint64)
    filters = staged(build_filters(vocabulary, shards), "variants-filters")
    # Few words to a task: each stands for some hundred edits.
    spread = vocabulary.select("word").repartition(max(1, math.ceil(sum(r.n for r in sizes) / 20_000)), "word")
    per_pass = max(1, most_bytes // (SEGMENT * 64))
    found = None
    for first in range(0, -(-shards.total // SEGMENT), per_pass):
        found_here = _pass(spark, spread, filters, shards, letters, first, first + per_pass)
        found = found_here if found is None else found.unionByName(found_here)
    if found is None:
        found = spark.createDataFrame([], "a string, b string")
    counts = vocabulary.select("word", "n")
    exact = found.join(counts.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    return exact.join(counts.select(F.col("word").alias("a"), F.col("n").alias("n_a")), "a").select("a", "b", "n_a", "n_b")


def _pass(spark: SparkSession, words: DataFrame, filters: DataFrame, shards: Shards, letters: np.ndarray, first: int, last: int) -> DataFrame:
    """The positives of one range of filter segments, written to the shared folder."""
    low, high = first * SEGMENT, min(last * SEGMENT, shards.total)
    held = np.zeros((last - first) * SEGMENT * 8, np.uint64)
    for r in filters.where((F.col("segment") >= first) & (F.col("segment") < last)).toLocalIterator():
        at = (r.segment - first) * SEGMENT * 8
        held[at : at + SEGMENT * 8] = np.frombuffer(r.bits, np.uint64)
    sent = spark.sparkContext.broadcast(held[: (high - low) * 8])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_pylist()
            for lo in range(0, len(own), 2000):
                part = own[lo : lo + 2000]
                for w, edits in probe(part, letters, shards, low, high, sent.value):
                    if edits:
                        yield pa.record_batch({"a": pa.array([part[i] for i in w.tolist()], pa.string()), "b": pa.array(edits, pa.string())})

    out = staged(words.mapInArrow(run, "a string, b string"), "variants-positives")
    sent.destroy()
    return out


def _roots(forms: DataFrame, max_rounds: int = 30) -> DataFrame:
    """``(word, root)`` of the words that have a form: pointer doubling, each round written."""
    now = staged(forms.select("word", F.col("form").alias("root")), "variants-roots")
    for _ in range(max_rounds):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if now.join(onward, "root", "left_semi").isEmpty():
            return now
        now = staged(now.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "variants-roots")
    raise RuntimeError("forms did not end: their counts must grow from step to step")


def spelling_variants(docs: DataFrame, ratio: float = 2, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
                      slip: int | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the corpus' vocabulary.

    ``form``: the near word of largest count (ties: the first in code-point order), if
    that is at least ``ratio`` (more than 1) times the word's own; ``root``: where the
    forms lead; ``n_near``: near words.
    """
    if not ratio > 1:
        raise ValueError("ratio must exceed 1, or forms could lead in circles")
    vocabulary = staged(word_counts(docs, id_col, text_col, min_length, min_count, slip), "variants-words")
    pairs = near_pairs(vocabulary, most_bytes)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    good = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    known = staged(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.minus")).alias("form_n")), "variants-forms")
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def duckdb_sql() -> str:
    """The same with crc32 spelt out and near words found by shared deletions."""
    return f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
per_doc AS (SELECT doc_id, run, count(*) AS k, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(list_reduce(
      flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM per_doc, crc),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k FROM hashed),
vocab AS (SELECT word, sum(k)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS (SELECT word, n, i, word[1:i - 1] AS a, word[i + 1:] AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
pairs AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT DISTINCT c.word, v.word, v.n FROM cut c JOIN vocab v ON v.word = c.a || c.b
  UNION ALL SELECT DISTINCT v.word, c.word, c.n FROM cut c JOIN vocab v ON v.word = c.a || c.b),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM pairs GROUP BY word),
named AS (SELECT word, any_value(b.n_near) AS n_near, any_value(b.most) AS most, min(near) AS near FROM pairs JOIN best b USING (word) WHERE near_n = b.most GROUP BY word),
known AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * n THEN near END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n
  FROM vocab v LEFT JOIN named USING (word)),
chain AS (
  SELECT word, word AS root FROM known
  UNION ALL SELECT c.word, k.form FROM chain c JOIN known k ON k.word = c.root WHERE k.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN known k ON k.word = c.root WHERE k.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM known JOIN ends USING (word)
"""
