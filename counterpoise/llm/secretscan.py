"""Secrets in texts: fixed patterns, and strings that zstandard finds new beside sensitive words.

Fixed patterns give the base spans (``assign``, ``access``, ``hex``).  The method adds
spans of kind ``novel``:

1. An identifier dictionary is drawn from the corpus: words of letters and underscores
   counted over all texts, the most frequent ones up to ``DICTIONARY`` bytes (a stated
   bound; what reaches the driver).  Words with digits never enter, so a key that a copied
   document spreads over the corpus does not become a known word.
2. A candidate is a run of at least ``MIN_LENGTH`` key characters holding a letter and a
   digit that begins within ``REACH`` code points after a sensitive word, on the same line.
3. Its marginal size is what the compressor, primed with the dictionary, needs for the
   surrounding code with the candidate less what it needs without.  Names, paths and
   repetitions of the surroundings cost little; a drawn key costs at least the bits that
   its alphabet has.  Where the marginal bits reach ``NOVELTY`` times those of as many free
   characters of that alphabet, the candidate is reported, unless a base span overlaps it.

Texts are searched whole, each in one pass, where they lie: nothing is shuffled but the
word counts.

Defined cases: null text counts as empty; every row of the input has a row in the result,
also null and repeated ids and texts without a span; an empty table gives an empty result;
other columns are ignored.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.llm.common import ship, staged
from counterpoise.llm.tokens import text_slices

ship(__name__)

# The base patterns and the lengths below which a match is dropped.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")  # runs are maximal: the same as dropping shorter runs
MIN_VALUE, MIN_ACCESS = 6, 20
# Every match of ASSIGN holds one of these once lower-cased.
_ASSIGN_STEMS = ("passw", "secret", "token", "apikey", "api_key")

SENSITIVE = ("password", "passwd", "passphrase", "pwd", "secret", "token", "api key", "api-key", "api_key", "apikey", "access key", "access-key",
             "access_key", "accesskey", "private key", "private-key", "private_key", "privatekey", "credential", "authorization", "bearer", "signature", "license key")
KINDS = ("assign", "access", "hex", "novel")
MIN_LENGTH = 16
REACH = 64
AROUND = 160  # code points of surrounding code on each side
NOVELTY = 1.0
LEVEL = 19
DICTIONARY = 1 << 16

_CONTEXT = re.compile("|".join(map(re.escape, sorted(SENSITIVE, key=len, reverse=True))), re.IGNORECASE | re.ASCII)
_VALUE = re.compile(rf"[A-Za-z0-9+/_=.~-]{{{MIN_LENGTH},}}")
SPANS = "array<struct<kind: string, start: long, end: long, text: string, novelty: double>>"


def identifier_dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> bytes:
    """The corpus' most frequent identifiers without digits, the most frequent last, in at most ``size`` bytes."""
    words = docs.select(F.explode(F.regexp_extract_all(text_col, F.lit("[A-Za-z_]{3,40}"), F.lit(0))).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).select("word", "n", F.floor(F.log2("n") * 16).cast("int").alias("step"))
    counts = staged(counts, "identifiers")
    # Each word takes at least four bytes with its blank, so this many rows fill the dictionary: the steps of
    # frequency that fit whole, and of the next one an even share by hash.  No sort, and no more rows to the driver.
    room, whole, last, share = size // 4, 1 << 30, -1, 1
    for r in sorted(counts.groupBy("step").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):  # some hundred steps
        if r.words > room:
            last, share = r.step, math.ceil(r.words / max(1, room))
            break
        room, whole = room - r.words, r.step
    taken = (F.col("step") >= whole) | ((F.col("step") == last) & (F.pmod(F.xxhash64("word"), F.lit(share)) == 0))
    most = sorted(counts.where(taken).select("word", "n").collect(), key=lambda r: (-r.n, r.word))
    picked, room = [], size
    for r in most:
        room -= len(r.word) + 1
        if room < 0:
            break
        picked.append(r.word)
    return " ".join(reversed(picked)).encode()


def alphabet(value: str) -> int:
    """How many characters a key of this kind draws from."""
    if all(c in "0123456789abcdef" for c in value) or all(c in "0123456789ABCDEF" for c in value):
        return 16
    classes = {(c.islower(), c.isupper(), c.isdigit()) for c in value}
    return 26 * ((True, False, False) in classes) + 26 * ((False, True, False) in classes) + 10 * ((False, False, True) in classes) + 2 * ((False, False, False) in classes)


class Novelty:
    """Marginal compressed bytes of strings against a dictionary and their surroundings."""

    def __init__(self, dictionary: bytes, level: int = LEVEL):
        import zstandard

        known = None
        if len(dictionary) >= 8:  # the library takes no shorter one
            known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)

    def ratio(self, text: str, start: int, end: int, around: int = AROUND) -> float:
        value = text[start:end]
        # Other places of the same string near by say nothing against it.
        near = (text[end : end + around] + "\n" + text[max(0, start - around) : start]).replace(value, "").encode("utf-8", "replace")
        cost = len(self.compressor.compress(near + value.encode())) - len(self.compressor.compress(near))
        return 8 * cost / (len(value) * math.log2(alphabet(value)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the fixed patterns' matches, in order."""
    low = text.lower()
    out = []
    if any(s in low for s in _ASSIGN_STEMS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    """Key-like runs that begin soon after a sensitive word on its line."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE):
        return []
    out: dict[int, int] = {}
    for m in _CONTEXT.finditer(text):
        stop = text.find("\n", m.end(), m.end() + REACH)
        at = m.end()
        while v := _VALUE.search(text, at):
            if v.start() >= (stop if stop >= 0 else m.end() + REACH):
                break
            value = v[0].rstrip(".=")
            if len(value) >= MIN_LENGTH and any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
                out[v.start()] = v.start() + len(value)
            at = v.end()
    return sorted(out.items())


def spans_of(text: str, novelty: Novelty, least: float = NOVELTY) -> list[dict]:
    base = base_spans(text)
    found = [{"kind": KINDS[k], "start": s, "end": e, "text": text[s:e], "novelty": None} for s, k, e in base]
    for s, e in candidates(text):
        if any(a < e and s < b for a, _, b in base):
            continue
        cost = novelty.ratio(text, s, e)
        if cost >= least:
            found.append({"kind": "novel", "start": s, "end": e, "text": text[s:e], "novelty": cost})
    return sorted(found, key=lambda x: (x["start"], KINDS.index(x["kind"])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = NOVELTY, dictionary: bytes | None = None) -> DataFrame:
    """``(doc_id, spans)``: a row per row of ``docs``; spans by start, then kind as in ``KINDS``."""
    known = identifier_dictionary(docs, text_col) if dictionary is None else dictionary
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()), ("novelty", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(known)
        for b in batches:
            for lo, hi, texts in text_slices(b.column(1)):
                yield pa.record_batch({"doc_id": b.column(0).slice(lo, hi - lo), "spans": pa.array([spans_of(t, novelty, least) for t in texts], kind)})

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {id_type}, spans {SPANS}")


def secret_digests(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans as ``kind:start:end`` lists."""

    def named(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(named(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
