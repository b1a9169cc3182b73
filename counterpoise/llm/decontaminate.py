"""Benchmark decontamination: q-gram lemma filtering, then banded alignment.

A copy of a benchmark text of ``m`` characters with at most ``e`` edits keeps at least
``m + 1 - q - q e`` of its q-grams, all on diagonals (place in the text minus place in the
benchmark text) at most ``e`` apart.  Each document's q-grams are looked up among the
benchmark's; documents and items with too few common ones in all drop out, for the others
hits are counted in overlapping bands of ``2 (e + 1)`` diagonals, every diagonal being in
two; regions of bands that reach the bound are kept, and a semi-global alignment inside a
region (widened by ``e``) finds the true number of edits.  No copy within the budget is missed.

Items longer than twice ``REGION`` characters are cut into overlapping regions of that
length, each with a budget of its own: a document that quotes a part of a long item is found.

``e`` is ``rate`` of the length, lowered where the bound would not be positive.  Texts are
compared lower-cased, with runs of white space as one blank; lengths, places and edits are
characters (code points).  Hits are expanded in slices and counted per band, so a text of one
repeated character costs time in proportion to it and no memory.

The items travel with the tasks: their total size is checked, and beyond
``INDEX_BYTES`` they are dealt into that many parts and the documents read once for each.

Defined cases: null, empty and blank items (of white space of any kind) are left out, as
are null and empty texts; items shorter than a q-gram must occur as they are and not
inside a longer word (scripts without blanks have no such words); items that repeat are all reported;
repeated document rows are judged each; an empty table gives an empty result; other
columns are ignored by the search and kept by the filter.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.llm.common import give_back, ship
from counterpoise.llm.tokens import text_slices

ship(__name__)

Q = 12
RATE = 0.05
REGION = 320
_SLICE = 1 << 21  # hits expanded at once
_WIDE = 1 << 15  # diagonals aligned at once
INDEX_BYTES = 2 << 20  # an index takes some 32 times as much in a task
_BITS = 22


#: Letters, digits and marks of scripts that set blanks between words.
_IN_WORD = re.compile("[^\\W\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]|[\u0300-\u036f]")


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def find_words(text: str, item: str) -> int:
    """The first place of ``item`` in ``text`` where no word goes on over its ends, or -1."""

    def cut(left: str, right: str) -> bool:
        return not (_IN_WORD.match(left) and _IN_WORD.match(right))

    p = text.find(item)
    while p >= 0:
        end = p + len(item)
        if cut(text[p - 1 : p] if p else "", item[0]) and cut(item[-1], text[end : end + 1]):
            return p
        p = text.find(item, p + 1)
    return -1


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def letters(text: str) -> np.ndarray:
    """A byte per character; those beyond Latin-1 share bytes, which adds candidates but loses none."""
    try:
        return np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        c = points(text)
        return np.where(c < 256, c, (c * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def grams(data: np.ndarray) -> np.ndarray:
    """Keys of all windows of Q letters (Q = 12: two overlapping 8-byte words, mixed)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    word = np.ndarray(len(data) - 7, "<u8", data.tobytes(), strides=(1,))
    return word[:n] * np.uint64(0x9E3779B97F4A7C15) + word[4 : 4 + n] * np.uint64(0xC2B2AE3D27D4EB4F)


def regions(m: int, size: int = REGION) -> list[tuple[int, int]]:
    """Where an item of ``m`` characters is cut: whole up to twice ``size``, else windows that overlap by half."""
    if m <= 2 * size:
        return [(0, m)]
    starts = list(range(0, m - size, size // 2)) + [m - size]
    return [(s, s + size) for s in starts]


def budget(m: int, rate: float = RATE) -> int:
    """Edits allowed in a copy of ``m`` characters: the bound m + 1 - Q - Q e must stay positive."""
    return max(0, min(int(rate * m), (m - Q) // Q))


class Index:
    """The q-grams of a set of items, cut into regions."""

    def __init__(self, ids: list, texts: list[str], rate: float = RATE):
        some = [(i, x) for i, x in zip(ids, map(normal, texts)) if x]  # blank items are in every text
        cut = [(i, x[s:e]) for i, x in some for s, e in regions(len(x))]
        self.ids, self.items = [i for i, _ in cut], [x for _, x in cut]
        self.owner = np.repeat(np.arange(len(some)), [len(regions(len(x))) for _, x in some])
        self.edits = np.array([budget(len(x), rate) for x in self.items], np.int64)
        self.need = np.array([len(x) + 1 - Q - Q * e for x, e in zip(self.items, self.edits)], np.int64)
        self.short = [i for i, x in enumerate(self.items) if len(x) < Q]
        made = [grams(letters(x)) for x in self.items]
        keys = np.concatenate(made) if made else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(made)), [len(g) for g in made])
        place = np.concatenate([np.arange(len(g)) for g in made]) if made else np.zeros(0, np.int64)
        self.keys, number = np.unique(keys, return_inverse=True)
        # Per key its items, each with the number of places there; per (key, item) the places.
        order = np.lexsort((place, item, number))
        self.place = place[order]
        pair = number[order] * max(1, len(made)) + item[order]
        self.pairs, self.first = np.unique(pair, return_index=True)
        self.times = np.diff(np.append(self.first, len(order)))
        self.item = self.pairs % max(1, len(made))
        self.of_key = np.searchsorted(self.pairs, np.arange(len(self.keys) + 1) * max(1, len(made)))
        self.sieve = np.zeros(1 << _BITS, bool)
        self.sieve[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, region, start, end, edits) of every item found in every text, once each: from the first to the last of its regions."""
        raw = [normal(t) for t in texts]
        found = [(t, i, p, p + len(self.items[i]), 0) for t, r in enumerate(raw) for i in self.short if (p := find_words(r, self.items[i])) >= 0]
        at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        keys = grams(np.concatenate([letters(r) for r in raw])) if raw else np.zeros(0, np.uint64)
        if len(keys) and len(self.keys):
            where = np.flatnonzero(self.sieve[(keys >> np.uint64(64 - _BITS)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.keys, keys[where]), len(self.keys) - 1)
            ok = self.keys[k] == keys[where]
            where, k = where[ok], k[ok]
            text = np.searchsorted(at, where, side="right") - 1
            ok = where + Q <= at[text + 1]  # windows across two texts
            where, k, text = where[ok], k[ok], text[ok]
            for t, i in self._enough(k, text):
                lo, hi = np.searchsorted(where, (at[t], at[t + 1]))
                got = self._best(raw[t], i, where[lo:hi] - at[t], k[lo:hi])
                if got is not None:
                    found.append((t, i, got[1], got[2], got[0]))
        merged: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for t, i, s, e, d in found:
            own = (t, int(self.owner[i]))
            j, s0, e0, d0 = merged.get(own, (i, s, e, 0))
            merged[own] = (min(i, j), min(s, s0), max(e, e0), d0 + d)
        return [(t, *v) for (t, _), v in sorted(merged.items())]

    def _enough(self, k: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
        """(text, region) with as many common q-grams in all as a copy has; counted by items per q-gram, not by places."""
        many = self.of_key[k + 1] - self.of_key[k]
        totals: dict[int, int] = {}
        cuts = np.searchsorted(np.cumsum(many), np.arange(_SLICE, many.sum() + _SLICE, _SLICE), side="left") + 1
        for lo, hi in zip(np.concatenate([[0], cuts[:-1]]) if len(cuts) else [], cuts):
            n = many[lo:hi]
            if not n.sum():
                continue
            pair = np.repeat(self.of_key[k[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            key = np.repeat(text[lo:hi], n) * len(self.items) + self.item[pair]
            keys, inverse = np.unique(key, return_inverse=True)
            for x, c in zip(keys.tolist(), np.bincount(inverse, self.times[pair]).astype(np.int64).tolist()):
                totals[x] = totals.get(x, 0) + c
        return sorted(divmod(x, len(self.items)) for x, c in totals.items() if c >= self.need[x % len(self.items)])

    def _best(self, text: str, i: int, where: np.ndarray, k: np.ndarray) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best copy of a region in a text, or None beyond the budget."""
        item, e = self.items[i], int(self.edits[i])
        p = text.find(item)
        if p >= 0:
            return 0, p, p + len(item)
        if e == 0:
            return None
        pair = np.minimum(np.searchsorted(self.pairs, k * len(self.items) + i), len(self.pairs) - 1)
        own = self.pairs[pair] == k * len(self.items) + i
        where, first, n = where[own], self.first[pair[own]], self.times[pair[own]]
        w, base = e + 1, -(-len(item) // (e + 1)) + 1
        hits = np.zeros((len(text) + len(item)) // w + 3, np.int64)
        cuts = np.searchsorted(np.cumsum(n), np.arange(_SLICE, n.sum() + _SLICE, _SLICE), side="left") + 1
        for lo, hi in zip(np.concatenate([[0], cuts[:-1]]), cuts):
            m = n[lo:hi]
            post = np.repeat(first[lo:hi] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            band = (np.repeat(where[lo:hi], m) - self.place[post]) // w + base
            hits += np.bincount(band, minlength=len(hits))[: len(hits)]
        # A band reaches over the one after it; neighbours that reach the bound are aligned together.
        on = np.flatnonzero(hits[:-1] + hits[1:] >= self.need[i])
        best = None
        for run in np.split(on, np.flatnonzero(np.diff(on) > 1) + 1) if len(on) else []:
            lo, hi = (int(run[0]) - base) * w - e, (int(run[-1]) - base + 2) * w + e
            for a in range(lo, hi, _WIDE):
                got = self._align(text, item, a, min(hi, a + _WIDE + 2 * e + 2), e)
                if got is not None and (best is None or got < best):
                    best = got
        return best

    def _align(self, text: str, item: str, lo: int, hi: int, e: int) -> tuple[int, int, int] | None:
        begin, end = max(0, lo), min(len(text), hi + len(item) + e)
        x, y = points(item), points(text[begin:end])
        cost, stop = banded(x, y, lo - begin, hi - begin)
        if cost > e:
            return None
        # The same alignment read backwards from its end gives the start.
        _, length = banded(x[::-1], y[:stop][::-1], -e, e + 1, fixed=True)
        return cost, begin + max(0, stop - length), begin + stop


def banded(x: np.ndarray, y: np.ndarray, lo: int, hi: int, fixed: bool = False) -> tuple[int, int]:
    """Least edits that turn ``x`` into a part of ``y`` whose diagonals are in [lo, hi), and where the part ends.

    The part starts anywhere, or at 0 if ``fixed``.
    """
    big = 1 << 20
    d = np.arange(lo, hi)
    inside = (d >= 0) & (d <= len(y))
    cost = np.where(inside, d if fixed else 0, big)
    for i in range(len(x)):
        j = i + d
        ok = (j >= 0) & (j < len(y))
        step = cost + np.where(ok, y[np.clip(j, 0, max(0, len(y) - 1))] != x[i], big)
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)  # a character of x left out
        cost = np.minimum.accumulate(step - d) + d  # characters of y left over
        cost[(j + 1 < 0) | (j + 1 > len(y))] = big
    k = int(cost.argmin())
    return int(cost[k]), len(x) + int(d[k])


def _parts(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, list[str]]]:
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length(F.trim("text")) > 0)
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / INDEX_BYTES))
    for part in range(parts):
        got = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).orderBy("id", "text").collect()  # about INDEX_BYTES
        if got or parts == 1:
            yield [r["id"] for r in got], [r["text"] for r in got]


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, start, end, edits)``: the best copy of every item found in every document."""
    schema = (f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id {benchmark.schema[item_col].dataType.simpleString()}, "
              "start long, end long, edits int")
    out = None
    for items in _parts(benchmark, item_col, item_text_col):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(*items, rate)
            for b in batches:
                for lo, _, texts in text_slices(b.column(1), 2_000_000):
                    found = index.find(texts)
                    if found:
                        t, i, s, e, d = zip(*found)
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array(t) if lo == 0 else pa.array([lo + x for x in t])), pa.array([index.ids[k] for k in i]), pa.array(s, pa.int64()),
                             pa.array(e, pa.int64()), pa.array(d, pa.int32())], names=["doc_id", "item_id", "start", "end", "edits"])

        got = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
        out = got if out is None else out.unionByName(got)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a copy of an item; no shuffle, all columns stay."""
    for items in _parts(benchmark, item_col, item_text_col):
        docs = docs.where(~_leak_test(items, rate)(F.col(text_col)))
    return docs


def _leak_test(items, rate: float):
    @F.pandas_udf("boolean")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(*items, rate)
        for texts in batches:
            out = np.zeros(len(texts), bool)
            for lo, _, part in text_slices(pa.array(texts, pa.string()), 2_000_000):
                out[[lo + f[0] for f in index.find(part)]] = True
            yield pd.Series(out)
        del index
        give_back()

    return leaks
