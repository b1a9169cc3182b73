"""Substring deduplication by content-defined chunks.

Every text is cut where a gear rolling hash of the last 16 bytes meets a mask, so cuts
move with the content: an insertion changes the chunks around it and no others.  Chunks
are compared by 64-bit digests over the whole corpus.  Of equal chunks the one with the
smallest (document id, place) stays and is the source of the others.  Every run of
adjoining chunks with one source, be it a single chunk, is a candidate; it is extended to
left and right as long as its bytes equal the source's.  Words said over and over, which
chunks do not follow, are found by their period and have the place before as source.  Extended runs of at least
``min_run`` bytes are the repeated spans (some 20 words; shorter ones are chance or set
phrases and stay), so each span is held whole by the document it names.

Data flow: tasks cut their texts and pre-aggregate per digest (one record of a digest
leaves a batch, the others are repeats already), records travel as packed arrays by
digest bucket, repeats travel on by document bucket and become candidates there.  These
ask for the ``min_run`` bytes beside them and beside their sources, once for each bucket;
a join with the texts answers, and the bucket compares.  What is still equal at the end of
its slice, where no other span covers what follows, asks for longer slices in another
round.  A chunk that a third of all documents share is one record per batch and one
slice per bucket, and no bucket holds more than its share of distinct chunks.

A passage is missed where no chunk of it has a source that holds at least ``min_run`` bytes
around it: where none is cut alike in both texts, or each of its chunks occurs first
elsewhere by itself.

Defined cases: null and empty texts have no chunks; rows that repeat both id and text
are one document (all keep or lose the same spans); equal ids with other texts are
documents of their own; null ids count as smallest; cuts never split a character; an
empty table gives no spans; spans of a document may overlap where sources do; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.llm.common import apart, free, give_back, ship, staged
from counterpoise.llm.tokens import text_slices

ship(__name__)

MIN_CHUNK, MASK_BITS, MAX_CHUNK = 16, 4, 128
MIN_RUN = 128
_WINDOW = 16
_PROBE = 24  # bytes of a long chunk looked for in itself
_BATCH = 8_000_000  # bytes of text cut before records leave a task
_BUCKET = 16 << 20  # bytes of text per digest bucket
_NULL_ID = -(1 << 63)

RECORD = np.dtype([("d", "<u8"), ("doc", "<i8"), ("h", "<i8"), ("s", "<u4"), ("n", "<u4")])
REPEAT = np.dtype([("doc", "<i8"), ("h", "<i8"), ("s", "<u4"), ("n", "<u4"), ("ref", "<i8"), ("rh", "<i8"), ("rs", "<u4")])
#: A run at [s, e) of a document and its source at rs of another; left and right: whether that end is open.
RUN = np.dtype([("doc", "<i8"), ("h", "<i8"), ("s", "<i8"), ("e", "<i8"), ("ref", "<i8"), ("rh", "<i8"), ("rs", "<i8"), ("left", "?"), ("right", "?")])


def _random(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gear_hash(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """16-bit gear hash of the last 16 bytes at every place: sum of gear[byte j back] << j, by doubling."""
    h = gear[data]
    width = 1
    while width < _WINDOW:
        h[width:] += h[:-width] << np.uint16(width)
        width *= 2
    return h


def chunk_ends(data: np.ndarray, at: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunks (start, end) of texts laid out from at[i] to at[i + 1] - gap in ``data``; the gap keeps windows apart."""
    gear = (_random(256, 11) >> np.uint64(40)).astype(np.uint16)
    h = gear_hash(data, gear)
    mask = np.uint16(((1 << MASK_BITS) - 1) << (16 - MASK_BITS))
    char = np.ones(len(data) + 1, bool)  # a cut before this byte does not split a character
    char[:-1] = (data & 0xC0) != 0x80
    cuts = np.flatnonzero(((h & mask) == 0) & char[1:]) + 1
    # Where each chunk may end at the earliest, in the list of cuts.
    cut_list = cuts.tolist()
    jump = np.searchsorted(cuts, cuts + MIN_CHUNK).tolist()
    starts: list[int] = []
    ends: list[int] = []
    n = len(cut_list)
    for lo, hi in zip(at[:-1].tolist(), (at[1:] - gap).tolist()):
        k = int(np.searchsorted(cuts, lo + MIN_CHUNK))
        while lo < hi:
            starts.append(lo)
            end = cut_list[k] if k < n else hi
            if end > hi:
                end = hi
            if end - lo > MAX_CHUNK:
                end = lo + MAX_CHUNK
                while not char[end]:
                    end -= 1
                k = int(np.searchsorted(cuts, end + MIN_CHUNK))
            elif end < hi:
                k = jump[k]
            ends.append(end)
            lo = end
    return np.array(starts, np.int64), np.array(ends, np.int64)


class _Digests:
    """64-bit polynomial digests of slices, by prefix sums; powers are kept for the longest batch seen."""

    P = 0x9E3779B97F4A7C15 | 1
    INV = pow(P, -1, 1 << 64)

    def __init__(self):
        self.byte = _random(256, 12)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        done = 1
        while done < n:
            k = min(done, n - done)
            out[done : done + k] = out[:k] * np.uint64(pow(base, done, 1 << 64))
            done += k
        return out

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            self.up, self.down = self._powers(self.P, len(data) + 1), self._powers(self.INV, len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.byte[data] * self.up[: len(data)], out=sums[1:])
        d = (sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)
        d ^= d >> np.uint64(32)
        d *= np.uint64(0xD6E8FEB86659FD93)
        return d ^ (d >> np.uint64(29))


def firsts_and_repeats(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first record of every digest, and the others as repeats of it.  Equal records are one."""
    rec = rec[np.argsort(rec["d"], kind="stable")]
    same = np.zeros(len(rec), bool)
    same[1:] = rec["d"][1:] == rec["d"][:-1]
    shared = same.copy()
    shared[:-1] |= same[1:]
    alone, some = rec[~shared], rec[shared]
    if not len(some):
        return alone, np.zeros(0, REPEAT)
    some = some[np.lexsort((some["s"], some["h"], some["doc"], some["d"]))]
    new = np.ones(len(some), bool)
    new[1:] = some[1:] != some[:-1]
    some = some[new]
    first = np.ones(len(some), bool)
    first[1:] = some["d"][1:] != some["d"][:-1]
    source = some[first][np.cumsum(first) - 1][~first]
    out = np.zeros(int((~first).sum()), REPEAT)
    for f in ("doc", "h", "s", "n"):
        out[f] = some[f][~first]
    out["ref"], out["rh"], out["rs"] = source["doc"], source["h"], source["s"]
    return np.concatenate([alone, some[first]]), out


def periodic(data: bytes, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(chunk, start, length, source) of long chunks whose first or last bytes come again inside them."""
    out = []
    for k in np.flatnonzero(ends - starts >= MAX_CHUNK // 2).tolist():
        lo, hi = int(starts[k]), int(ends[k])
        head = data[lo : lo + _PROBE]
        again = data.find(head, lo + 1, hi)
        if again >= 0:
            end = again + _PROBE
            while end < hi and data[end] & 0xC0 == 0x80:  # whole characters only
                end -= 1
            out.append((k, again, end - again, lo))
        start = hi - _PROBE
        while data[start] & 0xC0 == 0x80:
            start += 1
        before = data.rfind(data[start:hi], lo, hi - 1)
        if before >= 0:
            out.append((k, start, hi - start, before))
    return out


def _rows(kind: int, buckets: np.ndarray, records: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    order = np.argsort(buckets, kind="stable")
    buckets, records = buckets[order], records[order]
    edges = np.flatnonzero(np.diff(buckets, prepend=-1))
    for lo, hi in zip(edges, np.append(edges[1:], len(records))):
        yield kind, int(buckets[lo]), records[lo:hi].tobytes()


def _batch(rows) -> pa.RecordBatch:
    k, b, p = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(b, pa.int32()), pa.array(p, pa.binary())], names=["kind", "bucket", "payload"])


def _doc_bucket(rep: np.ndarray, buckets: int) -> np.ndarray:
    x = rep["doc"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ rep["h"].astype(np.uint64)
    return ((x >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def runs_of(rep: np.ndarray) -> np.ndarray:
    """Adjoining repeats with one source at one distance, joined to runs that are open at both ends."""
    rep = np.unique(rep)
    way = rep["rs"].astype(np.int64) - rep["s"]
    order = np.lexsort((rep["s"], way, rep["rh"], rep["ref"], rep["h"], rep["doc"]))
    rep, way = rep[order], way[order]
    end = rep["s"].astype(np.int64) + rep["n"]
    new = np.ones(len(rep), bool)
    new[1:] = (way[1:] != way[:-1]) | (rep["s"][1:] != end[:-1])
    for f in ("doc", "h", "ref", "rh"):
        new[1:] |= rep[f][1:] != rep[f][:-1]
    first = np.flatnonzero(new)
    out = np.zeros(len(first), RUN)
    for f in ("doc", "h", "s", "ref", "rh", "rs"):
        out[f] = rep[f][first]
    out["e"] = end[np.append(first[1:], len(rep)) - 1]
    out["left"] = out["right"] = True
    return out


def slices_wanted(runs: np.ndarray, reach: int) -> np.ndarray:
    """Distinct (document, hash, from, to) beside the open ends of the runs and of their sources."""
    le, ri = runs[runs["left"]], runs[runs["right"]]
    end = ri["rs"] + ri["e"] - ri["s"]
    parts = [(le["doc"], le["h"], np.maximum(le["s"] - reach, 0), le["s"]), (le["ref"], le["rh"], np.maximum(le["rs"] - reach, 0), le["rs"]),
             (ri["doc"], ri["h"], ri["e"], ri["e"] + reach), (ri["ref"], ri["rh"], end, end + reach)]
    out = np.unique(np.concatenate([np.column_stack(x) for x in parts]), axis=0)
    return out[out[:, 2] < out[:, 3]]


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax())


def extended(runs: np.ndarray, slices: dict[tuple[int, int, int, int], bytes], reach: int, min_run: int) -> np.ndarray:
    """The runs of at least ``min_run`` bytes when open ends have moved over the bytes that match, by whole characters.

    An end stays open where all ``reach`` bytes matched and no other run covers the next byte.
    """
    out = runs.copy()
    for i, (doc, h, s, e, ref, rh, rs, left, right) in enumerate(runs.tolist()):
        if left and s and rs:
            mine = slices[doc, h, max(s - reach, 0), s]
            n = _common(mine[::-1], slices[ref, rh, max(rs - reach, 0), rs][::-1])
            out["left"][i] = n == reach
            while n and mine[-n] & 0xC0 == 0x80:
                n -= 1
            out["s"][i], out["rs"][i] = s - n, rs - n
        else:
            out["left"][i] = False
        if right:
            end = rs + e - s
            mine = slices[doc, h, e, e + reach]
            n = _common(mine, slices[ref, rh, end, end + reach])
            out["right"][i] = n == reach
            if n == reach:  # the next byte is not known: up to the last beginning of a character
                n -= 1
            while n and n < len(mine) and mine[n] & 0xC0 == 0x80:
                n -= 1
            out["e"][i] = e + n
    out = out[out["e"] - out["s"] >= min_run]
    # Ends inside another run of the document need not move on.
    out = out[np.lexsort((out["rs"], out["rh"], out["ref"], -out["e"], out["s"], out["h"], out["doc"]))]
    same = np.zeros(len(out), bool)
    same[1:] = (out["doc"][1:] == out["doc"][:-1]) & (out["h"][1:] == out["h"][:-1])
    part = np.cumsum(~same)
    if len(out):
        span = int(out["e"].max()) + 1
        furthest = np.maximum.accumulate(part * span + out["e"])  # largest end so far in the document
        # Joined stretches of overlapping or adjoining runs: only their outer ends stay open.
        fresh = np.ones(len(out), bool)
        fresh[1:] = part[1:] * span + out["s"][1:] > furthest[:-1]
        stretch = np.cumsum(fresh) - 1
        start = out["s"][fresh][stretch]
        end = np.zeros(int(fresh.sum()), np.int64)
        np.maximum.at(end, stretch, out["e"])
        out["left"] &= out["s"] == start
        out["right"] &= out["e"] == end[stretch]
    return out


def fewest(runs: np.ndarray) -> np.ndarray:
    """Of sorted runs (document, start, longest first) those that cover all bytes of all of them, greedily."""
    keep: list[int] = []
    best, best_end = -1, -1  # the furthest run that reaches back into what is kept
    key, kept_end = None, -1
    for i, (doc, h, s, e) in enumerate(runs[["doc", "h", "s", "e"]].tolist()):
        if (doc, h) != key or s > kept_end:
            if (doc, h) == key and best_end > kept_end:
                keep.append(best)
                kept_end = best_end
            elif (doc, h) != key and best_end > kept_end:
                keep.append(best)
            if (doc, h) != key or s > kept_end:
                key, kept_end = (doc, h), e
                keep.append(i)
                best, best_end = -1, -1
                continue
        if e > max(kept_end, best_end):
            best, best_end = i, e
    if best_end > kept_end:
        keep.append(best)
    return runs[np.array(keep, np.int64)]


def repeated_spans(docs: DataFrame, min_run: int = MIN_RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, start, end, first_doc_id)``: repeated byte spans and a document that holds all of the span earlier.

    ``doc_id`` must be an integer column; ``text_hash`` is ``xxhash64(text)``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, math.ceil(size / _BUCKET), min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (1 << 20))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = _Digests()
        held: list[np.ndarray] = []
        again: list[np.ndarray] = []
        cut_bytes = 0

        def leave():
            rec, rep = firsts_and_repeats(np.concatenate(held))
            rep = np.concatenate([rep, *again])
            held.clear()
            again.clear()
            rows = list(_rows(0, (rec["d"] % np.uint64(buckets)).astype(np.int64), rec))
            if len(rep):
                rows += _rows(1, _doc_bucket(rep, buckets), rep)
            return _batch(rows)

        for b in batches:
            ids = b.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
            hashes = b.column(1).to_numpy()
            for lo, hi, texts in text_slices(b.column(2), 1_000_000):
                gap = bytes(_WINDOW)
                raw = [t.encode("utf-8", "replace") + gap for t in texts]
                at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
                joined = b"".join(raw)
                data = np.frombuffer(joined, np.uint8)
                s, e = chunk_ends(data, at, _WINDOW)
                own = np.searchsorted(at, s, side="right") - 1
                rec = np.zeros(len(s), RECORD)
                rec["d"], rec["doc"], rec["h"], rec["s"], rec["n"] = digests.of(data, s, e), ids[lo + own], hashes[lo + own], s - at[own], e - s
                held.append(rec)
                over = periodic(joined, s, e)
                if over:
                    k, start, n, source = np.array(over, np.int64).T
                    rep = np.zeros(len(k), REPEAT)
                    rep["doc"], rep["h"], rep["s"], rep["n"] = rec["doc"][k], rec["h"][k], start - at[own[k]], n
                    rep["ref"], rep["rh"], rep["rs"] = rec["doc"][k], rec["h"][k], source - at[own[k]]
                    again.append(rep)
                cut_bytes += len(data)
                if cut_bytes >= _BATCH:
                    yield leave()
                    cut_bytes = 0
        if held:
            yield leave()
        give_back()

    def compare(group: pa.Table) -> pa.Table:
        kinds, payloads = group["kind"].to_pylist(), group["payload"].to_pylist()
        rec = np.frombuffer(b"".join(p for k, p in zip(kinds, payloads) if k == 0), RECORD)
        known = np.frombuffer(b"".join(p for k, p in zip(kinds, payloads) if k == 1), REPEAT)
        rep = np.concatenate([firsts_and_repeats(rec)[1], known])
        del rec, known, payloads
        give_back()
        if not len(rep):
            return pa.table({"kind": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()), "payload": pa.array([], pa.binary())})
        return pa.Table.from_batches([_batch(_rows(1, _doc_bucket(rep, buckets), rep))])

    def candidates(group: pa.Table) -> pa.Table:
        rep = np.frombuffer(b"".join(group["payload"].to_pylist()), REPEAT)
        return pa.table({"bucket": group["bucket"][:1], "payload": pa.array([runs_of(rep).tobytes()], pa.binary())})

    def wanted(reach: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for bucket, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    got = slices_wanted(np.frombuffer(payload, RUN), reach)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), bucket), pa.int32()), *[pa.array(got[:, k], pa.int64()) for k in range(4)]],
                                                     names=["bucket", "doc", "h", "lo", "hi"])

        return run

    def served(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ask = b.column(3).to_pylist()
            for lo, hi, texts in text_slices(b.column(2), 1_000_000):
                rows = []
                for i, t in zip(range(lo, hi), texts):
                    raw, doc, h = t.encode("utf-8", "replace"), b.column(0)[i].as_py(), b.column(1)[i].as_py()
                    rows += [(q["bucket"], doc, h, q["lo"], q["hi"], raw[q["lo"] : q["hi"]]) for q in ask[i]]
                for at in range(0, len(rows), 50_000):
                    c = list(zip(*rows[at : at + 50_000]))
                    yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int32()), *[pa.array(x, pa.int64()) for x in c[1:5]], pa.array(c[5], pa.binary())],
                                                     names=["bucket", "doc", "h", "lo", "hi", "payload"])

    def compare_bytes(reach: int):
        def run(group: pa.Table) -> pa.Table:
            mine = group["doc"].is_null().to_numpy()
            runs = np.frombuffer(b"".join(group["payload"].filter(pa.array(mine)).to_pylist()), RUN)
            rest = group.filter(pa.array(~mine))
            slices = dict(zip(zip(*[rest[c].to_pylist() for c in ("doc", "h", "lo", "hi")]), rest["payload"].to_pylist()))
            out = extended(runs, slices, reach, min_run)
            del slices, rest
            give_back()
            return pa.table({"bucket": group["bucket"][:1], "payload": pa.array([out.tobytes()], pa.binary()), "open": pa.array([bool((out["left"] | out["right"]).any())])})

        return run

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for payload in b.column(0).to_pylist():
                out = fewest(np.frombuffer(payload, RUN))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["doc"], mask=out["doc"] == _NULL_ID), pa.array(out["h"]), pa.array(out["s"]), pa.array(out["e"]), pa.array(out["ref"], mask=out["ref"] == _NULL_ID)],
                    names=["doc_id", "text_hash", "start", "end", "first_doc_id"])

    packed = "kind int, bucket int, payload binary"
    records = rows.mapInArrow(cut, packed)
    repeats = records.groupBy("bucket").applyInArrow(compare, packed)
    runs = staged(repeats.groupBy("bucket").applyInArrow(candidates, "bucket int, payload binary"), "substring-runs")
    texts = rows.select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("doc"), "h", "text")
    reach = max(min_run, MAX_CHUNK)
    while True:
        ask = runs.mapInArrow(wanted(reach), "bucket int, doc long, h long, lo long, hi long")
        ask = ask.groupBy("doc", "h").agg(F.collect_list(F.struct("bucket", "lo", "hi")).alias("ask"))
        got = texts.join(ask, ["doc", "h"]).select("doc", "h", "text", "ask").mapInArrow(served, "bucket int, doc long, h long, lo long, hi long, payload binary")
        both = got.unionByName(runs.select("bucket", "payload"), allowMissingColumns=True)
        longer = staged(both.groupBy("bucket").applyInArrow(compare_bytes(reach), "bucket int, payload binary, open boolean"), "substring-runs")
        free(runs)
        runs = longer
        if runs.where("open").isEmpty():
            break
        reach *= 8
    return runs.select("payload").mapInArrow(finish, "doc_id long, text_hash long, start long, end long, first_doc_id long")


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the spans' bytes; all columns stay, rows too.  Null texts stay null."""
    per_doc = spans.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    per_doc = per_doc.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "__spans")
    whole, rest = apart(docs, F.xxhash64(text_col), spans.select("text_hash"))
    joined = rest.join(per_doc, (F.xxhash64(text_col) == F.col("__hash")) & F.col(id_col).eqNullSafe(F.col("__doc")), "left").drop("__doc", "__hash")

    @F.pandas_udf("string")
    def without(texts, spans):
        import pandas as pd

        out = []
        for t, own in zip(texts, spans):
            if t is not None and own is not None and len(own):
                raw, kept, at = t.encode("utf-8", "replace"), [], 0
                for s in own:
                    kept.append(raw[at : s["start"]])
                    at = max(at, s["end"])
                t = (b"".join(kept) + raw[at:]).decode("utf-8", "replace")
            out.append(t)
        return pd.Series(out, dtype=object)

    # Only documents with spans pass through Python.
    changed = F.when(F.col("__spans").isNotNull(), without(F.when(F.col("__spans").isNotNull(), F.col(text_col)), F.col("__spans"))).otherwise(F.col(text_col))
    return whole.unionByName(joined.withColumn(text_col, changed).drop("__spans").select(*docs.columns))
