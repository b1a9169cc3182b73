"""Pattern packing by non-negative least squares.

Documents become token pieces of at most ``capacity`` ids.  Only the histogram of
piece lengths (at most ``capacity`` numbers) reaches the driver, which plans there:

1. lengths are grouped into classes, on grids from fine to coarse; every pattern that fills
   a sequence is enumerated, of up to 3 documents on the finest grid and 32 on the coarsest;
2. non-negative least squares fits repeat counts to the histogram (active set method:
   no more patterns are used than there are classes);
3. counts are rounded (a share is kept back, so that residuals of every length are left
   to fill gaps) and cut to what the histogram holds, and the classes' lengths are dealt
   to the patterns' places; of the grids and shares the plan of fewest sequences stands;
4. the residual lengths go, longest first, into the fullest sequence with room, or
   into new ones.

The plan is a short table "pieces number a..b of length L go to sequences s.., offset o".
Pieces are numbered per length by distributed prefix sums, and each finds its place
there; no sequence is ever built from a collected group.

Defined cases: null and empty texts are one piece with the closing id alone; repeated
rows are packed each; a text longer than the capacity is cut into full pieces and a
shorter last one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.llm import tokens
from counterpoise.llm.common import gapless, give_back, ship, staged

ship(__name__)


MOST_PATTERNS = 100_000


# ---------------------------------------------------------------- the plan (driver, on the histogram)
def enumerate_patterns(units: int, max_docs: int, present: np.ndarray, most: int = MOST_PATTERNS) -> np.ndarray:
    """All non-increasing rows of up to ``max_docs`` classes (0: none) that sum to ``units``, of classes that occur.

    Where they are not too many, also those that fall short by less than the smallest class, so that no class fits in.
    """
    smallest = int(np.flatnonzero(present[1:]).min()) + 1
    if smallest > 1:
        loose = _patterns(units, max_docs, present, most, smallest - 1)
        if len(loose):
            return loose
    return _patterns(units, max_docs, present, most, 0)


def _patterns(units: int, max_docs: int, present: np.ndarray, most: int, short: int) -> np.ndarray:
    rows = np.zeros((1, 0), np.int64)
    left = np.full(1, units)
    for k in range(max_docs):
        top = rows[:, -1] if k else left
        # The next class is at most the last one, and what remains must fit into the places left.
        lo, hi = np.maximum(-(-(left - short) // (max_docs - k)), 0), np.minimum(top, left)
        n = np.maximum(hi - lo + 1, 0)
        at = np.repeat(np.arange(len(rows)), n)
        cls = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ok = (cls == 0) | present[cls]
        at, cls = at[ok], cls[ok]
        rows, left = np.column_stack([rows[at], cls]), left[at] - cls
        if len(rows) > most:  # too many to enumerate on this grid; a coarser one has fewer
            return np.zeros((0, max_docs), np.int64)
    return rows[left <= short]


def nnls(patterns: np.ndarray, want: np.ndarray, weight: np.ndarray, tol: float = 1e-3) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |weight * (A x - want)|, A's columns being the patterns' class counts."""
    n = len(patterns)
    x = np.zeros(n)
    active: list[int] = []
    use = patterns > 0

    def column(j):
        c = np.zeros(len(want))
        np.add.at(c, patterns[j][use[j]], 1.0)
        return c * weight

    target = want * weight
    cols = np.zeros((len(want), 0))
    gram = np.zeros((0, 0))
    rest = target.copy()
    for _ in range(3 * len(want)):
        gain = np.where(use, (rest * weight)[patterns], 0.0).sum(1)
        gain[active] = -1.0
        j = int(gain.argmax()) if n else -1
        if j < 0 or gain[j] <= tol * max(1.0, float(np.abs(target).max())) * 0.1:
            break
        active.append(j)
        new = column(j)
        dots = new @ cols
        gram = np.block([[gram, dots[:, None]], [dots[None, :], new @ new + 1e-9]])
        cols = np.column_stack([cols, new])
        while True:
            s = np.linalg.solve(gram, target @ cols)
            if (s > 0).all():
                x[active] = s
                break
            cur = x[active]
            bad = s <= 0
            step = np.min(cur[bad] / np.maximum(cur[bad] - s[bad], 1e-300))
            x[active] = cur + step * (s - cur)
            keep = x[active] > 1e-9
            if keep.all():
                keep[np.flatnonzero(bad)[0]] = False
            x[[a for a, k in zip(active, keep) if not k]] = 0.0
            active = [a for a, k in zip(active, keep) if k]
            cols, gram = cols[:, keep], gram[np.ix_(keep, keep)]
            if not active:
                break
        rest = target - cols @ x[active]
    return x


class _Plan:
    """Sequences as runs (first, how many) by free room; ``places``: (length, first number, count, sequence, offset)."""

    def __init__(self, capacity: int, counts: np.ndarray):
        self.capacity, self.left = capacity, counts.astype(np.int64).copy()
        self.used = np.zeros(capacity + 1, np.int64)
        self.places: list[tuple[int, int, int, int, int]] = []
        self.room: dict[int, list[tuple[int, int]]] = {}
        self.keys: list[int] = []
        self.sequences = 0

    def open(self, n: int) -> int:
        first, self.sequences = self.sequences, self.sequences + n
        return first

    def put(self, length: int, n: int, seq: int, offset: int) -> None:
        self.places.append((length, int(self.used[length]), n, seq, offset))
        self.used[length] += n
        self.left[length] -= n

    def free(self, room: int, seq: int, n: int) -> None:
        if n and room:
            if room not in self.room:
                bisect.insort(self.keys, room)
                self.room[room] = []
            self.room[room].append((seq, n))

    def take(self, room: int) -> tuple[int, int]:
        runs = self.room[room]
        run = runs.pop()
        if not runs:
            del self.room[room]
            self.keys.remove(room)
        return run

    def best_fit(self, length: int) -> None:
        """All pieces left of a length: fullest sequences with room first, as many in each as fit."""
        while n := int(self.left[length]):
            at = bisect.bisect_left(self.keys, length)
            if at < len(self.keys):
                room = self.keys[at]
                seq, have = self.take(room)
            else:
                room, have = self.capacity, max(1, -(-n // (self.capacity // length)))
                seq = self.open(have)
            per = min(room // length, -(-n // have))
            whole = min(have, n // per)
            if whole == 0:
                whole, per = 1, n
            for i in range(per):
                self.put(length, whole, seq, self.capacity - room + i * length)
            self.free(room - per * length, seq, whole)
            self.free(room, seq + whole, have - whole)


#: (classes, documents a pattern) from fine to coarse: short pieces need long patterns, which only few classes allow.
GRIDS = ((256, 3), (64, 6), (32, 16), (16, 32))


def plan_packing(counts: np.ndarray, capacity: int, max_docs: int | None = None, classes: int | None = None, shares: tuple = (0.9, 0.7, 0.4, 0.1),
                 slack: int = 16) -> tuple[np.ndarray, int]:
    """Places for ``counts[length]`` pieces: rows (length, first number, count, sequence, offset), and the sequences used.

    Patterns are fitted on every grid of ``GRIDS`` (or the one asked for) that has any,
    and packed with each of ``shares`` of the fitted repeats, the rest as residuals; the
    plan of fewest sequences stands, and the search ends at the lower bound (the pieces'
    ids over the capacity, or the pieces that exceed half of it).
    """
    total = int((counts * np.arange(len(counts))).sum())
    least = max(-(-total // capacity), int(counts[capacity // 2 + 1 :].sum()))
    best = None
    for grid in GRIDS if classes is None else ((classes, max_docs or 3),):
        step = max(1, capacity // grid[0])
        pats, repeats = fit_patterns(counts, capacity, step, grid[1])
        if not len(pats):
            continue
        for share in shares:
            plan = _rounded(counts, capacity, step, pats, repeats, share, slack)
            if best is None or plan.sequences < best.sequences:
                best = plan
            if best.sequences <= least:
                return _table(best), best.sequences
    # All counts rounded to nothing: where no pattern fills a sequence, or residuals alone do better.
    alone = _rounded(counts, capacity, 1, np.zeros((0, 1), np.int64), np.zeros(0), 0.0, slack)
    if best is None or alone.sequences < best.sequences:
        best = alone
    return _table(best), best.sequences


def _table(plan: _Plan) -> np.ndarray:
    return np.array(sorted(plan.places), np.int64).reshape(-1, 5)


def fit_patterns(counts: np.ndarray, capacity: int, step: int, max_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of length classes of ``step`` ids, and how often each is to be repeated."""
    units = capacity // step
    of = -(-np.arange(capacity + 1) // step)
    want = np.bincount(of, counts, int(of[-1]) + 1).astype(float)[: units + 1]
    present = want > 0
    longest = int(np.flatnonzero(present).max()) if present.any() else 0
    if not longest or max_docs * longest < units or (np.flatnonzero(present[1:]).min() + 1) > units:
        return np.zeros((0, 1), np.int64), np.zeros(0)
    pats = enumerate_patterns(units, max_docs, present)
    # Short pieces fit anywhere later: their residuals cost little.
    weight = np.where(np.arange(units + 1) <= units // 16, 0.1, 1.0)
    return pats, nnls(pats, want, weight)


def _rounded(counts: np.ndarray, capacity: int, step: int, pats: np.ndarray, repeats: np.ndarray, share: float, slack: int) -> _Plan:
    """The plan of one fit: ``share`` of the repeats by pattern, the residuals by best fit."""
    of = -(-np.arange(capacity + 1) // step)
    plan = _Plan(capacity, counts)
    for j in np.argsort(-repeats, kind="stable"):
        if repeats[j] < 0.5:
            break
        cls, times = np.unique(pats[j][pats[j] > 0], return_counts=True)
        have = [int(plan.left[of == c].sum()) for c in cls]
        n = int(min(round(share * repeats[j]), *(h // t for h, t in zip(have, times))))
        if n <= 0:
            continue
        runs = [(plan.open(n), n, 0)]  # (sequence, how many, filled)
        places = sorted(pats[j][pats[j] > 0].tolist(), reverse=True)
        for i, c in enumerate(places):
            out = []
            if i and i == len(places) - 1:
                # The last place takes a length that fills the sequence but for `slack` ids; else it stays open.
                for s, m, filled in runs:
                    room = capacity - filled
                    for length in range(room, max(0, room - slack - 1), -1):
                        t = int(min(m, plan.left[length]))
                        if t > 0:
                            plan.put(length, t, s, filled)
                            out.append((s, t, filled + length))
                            s, m = s + t, m - t
                        if not m:
                            break
                    if m:
                        out.append((s, m, filled))
            else:
                lengths = np.flatnonzero((of == c) & (plan.left > 0)).tolist()[::-1]
                for s, m, filled in runs:
                    while m:
                        while plan.left[lengths[0]] == 0:
                            lengths.pop(0)
                        t = int(min(m, plan.left[lengths[0]]))
                        plan.put(lengths[0], t, s, filled)
                        out.append((s, t, filled + lengths[0]))
                        s, m = s + t, m - t
            runs = out
        for s, m, filled in runs:
            plan.free(capacity - filled, s, m)
    for length in range(capacity, 0, -1):
        if plan.left[length]:
            plan.best_fit(length)
    return plan


# ---------------------------------------------------------------- the data (Spark)
_PIECES = "doc_id {t}, piece int, start long, length int, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, closing_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", room: int | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document's pieces."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer_path, tokens.cut_word, room)
        for b in batches:
            for lo, hi, texts in tokens.text_slices(b.column(1), 1_000_000):  # their words are objects, some 20 bytes for one of text
                ids, at = enc.encode(texts)
                n = np.diff(at) + 1
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(n[doc] - start, capacity)
                # Room for the closing id behind every document.
                flat = np.full(len(ids) + len(n), closing_id, "<u4")
                flat[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n - 1)] = ids
                first = (at[:-1] + np.arange(len(n)))[doc] + start
                crc = [zlib.crc32(flat[a : a + m]) for a, m in zip(first.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc + lo)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int32()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
                give_back()  # a stage's tasks all encode at once

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, _PIECES.format(t=kind.simpleString()))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, closing_id: int = 0, max_docs: int = 3,
                   id_col: str = "doc_id", text_col: str = "text", room: int | None = None) -> DataFrame:
    """Every piece and its place: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``.  ``room``: distinct chunks a worker keeps."""
    pieces = staged(token_pieces(docs, tokenizer_path, capacity, closing_id, id_col, text_col, room), "pack-pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[r["length"]] = r["count"]
    places, _ = plan_packing(counts, capacity, max_docs)
    keys = (places[:, 0] << 44) + places[:, 1]
    seqs, offsets, firsts = places[:, 3], places[:, 4], places[:, 1]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, number = b.column(3).to_numpy().astype(np.int64), b.column(5).to_numpy()
            k = np.searchsorted(keys, (length << 44) + number, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(seqs[k] + number - firsts[k]), pa.array(offsets[k])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    numbered = gapless(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "number", int(counts.sum()))
    kind = docs.schema[id_col].dataType.simpleString()
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        find, _PIECES.format(t=kind) + ", sequence_id long, offset long")


def sequences(docs: DataFrame, placed: DataFrame, tokenizer_path: str, capacity: int = 2048, closing_id: int = 0,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: ``(sequence_id, ids array<int>)``, one row per sequence of at most ``capacity`` ids.

    Documents must have distinct ids here, since pieces are matched to places by them.
    """
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer_path, tokens.cut_word)
        for b in batches:
            for lo, hi, texts in tokens.text_slices(b.column(1)):
                ids, at = enc.encode(texts)
                doc, piece, out = [], [], []
                for i in range(hi - lo):
                    own = np.append(ids[at[i] : at[i + 1]], closing_id).astype(np.int32)
                    for p in range(0, len(own), capacity):
                        doc.append(lo + i)
                        piece.append(p // capacity)
                        out.append(own[p : p + capacity])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(out, pa.list_(pa.int32()))],
                    names=["doc_id", "piece", "ids"])

    ids = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind.simpleString()}, piece int, ids array<int>")
    parts = ids.join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    packed = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return packed.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))
