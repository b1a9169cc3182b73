"""N-gram Jaccard join by universe partition and pigeonhole, with connected components.

A document is the set of its distinct 5-word shingles (64-bit hashes).  Two sets with
Jaccard similarity of at least 3/4 and sizes a <= b differ in at most (a + b) / 7 tokens.

*Size bands.*  Band edges grow by 4/3, so two linked sets are in the same band or in
adjacent ones.  Space j serves the pairs whose smaller set is in band j: sets of bands j
and j + 1 enter it.  In it at most ``H = hi_j / 3`` tokens differ.

*Segments.*  A hash deals the universe of tokens into ``m`` segments.  A set's part in a
segment gives one signature; ``d`` of the segments also get the signatures of the part's
one-deletion neighbourhood (the part without each one of its tokens).  A segment without
differing tokens shares the former, one with a single differing token the latter, so a
set whose parts weigh ``non-empty + non-empty pairs among the d > H`` meets all its
partners.  ``allocate`` picks m and d per band by expected cost: signatures sent,
chance meetings of small parts, and sets left uncovered.  Such sets (too many empty
segments) meet through single tokens instead, as do all sets of tiny bands: exact, too.

*Counting.*  By the same argument a linked pair shares at least ``non-empty - (a + b) / 7``
signatures; pairs that share fewer are dropped without looking at their sets.  Nor are
sets compared whose parity maps (token counts by hash, modulo 2) differ in more than
``(a + b) / 7`` bits.

*Skipping common parts.*  A set meets a partner in at least ``non-empty - n / 3`` of its
segments (``0.75 n`` of its tokens in the tiny band), so it may leave out all but one more
than that bound allows: its most frequent signatures, known once groups are counted.
Pairs are looked for only where the set in its own band (of two: the one with the larger
class number) has kept the signature; a passage that a third of all documents hold is
thus left out by nearly all of them, and none of their links is lost.

*Verification* is exact on the token sets.  Only components matter, so groups of sets
with a common signature are not expanded into pairs at first: each is linked as a star,
stars are verified and give components; a second round takes those pairs of a group
whose components still differ.  Equal sets are one class from the start.

Defined cases: null, empty and blank texts have no shingles and link with nothing; with
one to four words the whole sequence is the only shingle; rows that repeat an id are
judged each and share a component; null ids link like others and the smallest non-null
id names the component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from counterpoise.llm.common import connected_components, free, give_back, ship, staged
from counterpoise.llm.tokens import drop_encoders, text_slices

ship(__name__)

WIDTH = 5
TINY = 12  # sets up to this size, and their partners, meet through single tokens
_BATCH = 8_000_000  # bytes of text before records leave a task
_BUCKET = 4 << 20  # bytes of text per signature bucket
_MAX_WORDS = 200_000  # words whose hash a worker keeps
MAP_WORDS = 16
MAPS = [f"m{i}" for i in range(MAP_WORDS)]
HOT = 8  # from this size on a group's signature may be left out
RECORD = np.dtype([("g", "<u4"), ("j", "u1"), ("k", "<u8")])  # signature, space (128: own band), class
_OWN = 128


# ---------------------------------------------------------------- sets
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > _MAX_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[str], words: _Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after another, and where each text's begin."""
    look, parts = words.__getitem__, []
    for t in texts:
        own = t.encode("utf-8", "replace").translate(_LOWER).split()
        w = np.fromiter(map(look, own), np.uint64, len(own))
        n = max(len(w) - width + 1, min(len(w), 1))
        s = np.full(n, min(len(w), width), np.uint64)
        for i in range(min(width, len(w))):
            s += (w[i : i + n] + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15 + 2 * i * 0x632BE59BD9B4E019 & (1 << 64) - 1 | 1)
            s = (s << np.uint64(13)) | (s >> np.uint64(51))
        s = mix(s)
        s.sort()
        parts.append(s)
    lens = np.array([len(p) for p in parts], np.int64)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(parts)), lens)
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    return flat[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(parts)))])


def class_keys(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit digest of every set (equal sets, equal digests); as signed numbers, for Spark."""
    n = np.diff(at)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets))])
    more = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets ^ np.uint64(0x5851F42D4C957F2D)))])
    d = mix(sums[at[1:]] - sums[at[:-1]]) ^ (more[at[1:]] - more[at[:-1]]) * np.uint64(0x2545F4914F6CDD1D)
    return mix(d + n.astype(np.uint64)).view(np.int64)


def parity_maps(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per set MAP_WORDS * 64 parities of token counts: two sets' maps differ in at most as many bits as the sets in tokens."""
    n, width = len(at) - 1, 64 * MAP_WORDS
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(at))
    odd = np.bincount(owner * width + (sets >> np.uint64(20)).astype(np.int64) % width, minlength=n * width) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, width), axis=1).view("<i8").reshape(n, MAP_WORDS)


# ---------------------------------------------------------------- bands and their allocation
def _edges() -> tuple[int, ...]:
    out = [TINY]
    while len(out) < 60:
        out.append(out[-1] * 4 // 3)
    return tuple(out)


EDGES = _edges()  # upper sizes of the bands; band 0 is tiny
_ALLOCATED: dict[int, tuple[int, int, int]] = {}


def allocate(band: int, chance: float = 0.1, meeting: float = 60.0) -> tuple[int, int, int]:
    """(segments, of them with one-deletion neighbourhoods, most differing tokens) of a band, by expected cost.

    ``chance``: a token is shared with an unrelated set; ``meeting``: cost of a chance
    meeting in signatures sent.
    """
    if band in _ALLOCATED:
        return _ALLOCATED[band]
    hi = EDGES[band]
    most = hi // 3
    best = None
    for m in sorted({max(2, math.ceil(c / 20 * (most + 1))) for c in range(10, 35)}):
        for d in sorted({math.ceil(share * m) for share in (0, 1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 1)}):
            cost = 0.0
            for n in (0.8 * hi, 1.0 * hi, 1.2 * hi):
                t = n / m
                p0, p1 = math.exp(-t), t * math.exp(-t)
                weight = m * (1 - p0) + d * (1 - p0 - p1)
                spread = math.sqrt(max(m * p0 * (1 - p0) + d * (p0 + p1) * (1 - p0 - p1), 1e-9))
                uncovered = 0.5 * math.erfc((weight - most - 0.5) / spread / math.sqrt(2))
                sent = m * (1 - p0) + d * (t - p1)
                met = m * (math.exp(-t * (1 - chance)) - p0) + d * t * (math.exp(-t * (1 - chance)) - p0)
                cost += sent + uncovered * n * (1 + chance * meeting) + meeting * met
            if best is None or cost < best[0]:
                best = (cost, m, d)
    _ALLOCATED[band] = best[1], best[2], most
    return _ALLOCATED[band]


def signatures(sets: np.ndarray, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records of all sets (full 64-bit signatures in a second array), and per set the non-empty segments in its own space and the one below."""
    n = np.diff(at)
    bands = np.searchsorted(np.array(EDGES), n)
    filled = np.zeros((2, len(n)), np.int64)
    recs, sigs = [], []

    def send(sig, space, own, k):
        r = np.zeros(len(sig), RECORD)
        r["g"], r["j"], r["k"] = (sig >> np.uint64(32)).astype(np.uint32), space | (_OWN if own else 0), k
        recs.append(r)
        sigs.append(sig)

    owner_all = np.repeat(np.arange(len(n)), n)
    for own in (True, False):
        for space in np.unique(bands[n > 0] - (0 if own else 1)):
            space = int(space)
            if space < 0:
                continue
            pick = np.flatnonzero((bands == space + (0 if own else 1)) & (n > 0))
            on = np.isin(owner_all, pick)
            tokens, owner = sets[on], np.searchsorted(pick, owner_all[on])
            salt = np.uint64((0x9E3779B97F4A7C15 * (space + 1)) & ((1 << 64) - 1))
            if space == 0:
                send(mix(tokens + salt), 0, own, keys[pick][owner].view(np.uint64))
                continue
            m, d, most = allocate(space)
            h = mix(tokens ^ salt)
            seg = ((h >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            cell = owner * m + seg
            count = np.bincount(cell, minlength=len(pick) * m)
            sums = np.zeros(len(pick) * m, np.uint64)
            np.add.at(sums, cell, h)
            at_seg = np.tile(np.arange(m), len(pick))
            name = mix(salt + at_seg.astype(np.uint64))  # one name per segment, added to the part's sum
            full = np.flatnonzero(count)
            send(mix(sums[full] + name[full]), space, own, keys[pick][full // m].view(np.uint64))
            nonempty = (count > 0).reshape(len(pick), m).sum(1)
            weight = nonempty
            if d:
                rest = (seg < d) & (count[cell] > 1)
                send(mix(sums[cell[rest]] - h[rest] + name[cell[rest]]), space, own, keys[pick][owner[rest]].view(np.uint64))
                weight = nonempty + ((count > 1).reshape(len(pick), m)[:, :d]).sum(1)
            else:
                filled[0 if own else 1, pick] = nonempty
            bare = weight <= most
            if bare.any():
                one = bare[owner]
                send(mix(tokens[one] + salt + np.uint64(1)), space, own, keys[pick][owner[one]].view(np.uint64))
                filled[0 if own else 1, pick[bare]] = 0  # single tokens meet too: counting does not bind
    if not recs:
        return np.zeros(0, RECORD), np.zeros(0, np.uint64), filled
    return np.concatenate(recs), np.concatenate(sigs), filled


def common_groups(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records that share signature and space with another class's, one of the pair in its own band: (group number, record)."""
    rec = rec[np.argsort(rec["g"], kind="stable")]
    same = np.zeros(len(rec), bool)
    same[1:] = rec["g"][1:] == rec["g"][:-1]
    some = same.copy()
    some[:-1] |= same[1:]
    rec = rec[some]
    rec = np.unique(rec)  # by signature, space mark, class: equal classes meet here
    if not len(rec):
        return np.zeros(0, np.int64), rec
    space = rec["j"] & 127
    rec = rec[np.lexsort((rec["j"] < _OWN, space, rec["g"]))]  # own-band records first
    space = rec["j"] & 127
    new = np.ones(len(rec), bool)
    new[1:] = (rec["g"][1:] != rec["g"][:-1]) | (space[1:] != space[:-1])
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    ok = (size[group] > 1) & (rec["j"][new] >= _OWN)[group]
    return group[ok], rec[ok]


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs`` (integer ids)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, math.ceil(size / _BUCKET), min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (1 << 20))))
    schema = "kind int, bucket int, doc_id array<long>, n array<long>, key array<long>, own array<int>, below array<int>, map array<long>, payload binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        words = _Words()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[int] = set()
        read = 0

        def leave() -> pa.RecordBatch:
            rec, sig = (np.concatenate(z) for z in zip(*held))
            held.clear()
            seen.clear()
            bucket = (sig % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rec, bucket = rec[order], bucket[order]
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            k = len(cut)
            nothing = [None] * k
            return pa.RecordBatch.from_arrays(
                [pa.array([1] * k, pa.int32()), pa.array(bucket[cut], pa.int32()), *(pa.array(nothing, pa.list_(pa.int64())) for _ in range(3)),
                 *(pa.array(nothing, pa.list_(pa.int32())) for _ in range(2)), pa.array(nothing, pa.list_(pa.int64())),
                 pa.array([rec[a:b].tobytes() for a, b in zip(cut, np.append(cut[1:], len(rec)))], pa.binary())], schema=arrow)

        for b in batches:
            for lo, hi, texts in text_slices(b.column(1), 1_000_000):
                sets, at = shingle_sets(texts, words)
                n, keys = np.diff(at), class_keys(sets, at)
                # A class leaves a batch once.
                fresh = np.array([k not in seen and not seen.add(k) for k in keys.tolist()], bool) & (n > 0)
                on = np.repeat(fresh, n)
                rec, sig, filled = signatures(sets[on], np.concatenate([[0], np.cumsum(n[fresh])]), keys[fresh])
                held.append((rec, sig))
                own, below = np.zeros(len(n), np.int32), np.zeros(len(n), np.int32)
                own[fresh], below[fresh] = filled[0], filled[1]
                one = pa.array([0, len(n)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int32()), pa.array([int(keys[0]) % buckets if len(keys) else 0], pa.int32()), pa.ListArray.from_arrays(one, b.column(0).slice(lo, hi - lo)),
                     *(pa.ListArray.from_arrays(one, pa.array(z)) for z in (n, keys, own, below)),
                     pa.ListArray.from_arrays(pa.array([0, len(n) * MAP_WORDS], pa.int32()), pa.array(parity_maps(sets, at).ravel())), pa.array([None], pa.binary())], schema=arrow)
                read += sum(map(len, texts))
                if read > _BATCH:
                    yield leave()
                    read = 0
        if held:
            yield leave()
        give_back()

    arrow = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("doc_id", "n", "key")),
                       *((c, pa.list_(pa.int32())) for c in ("own", "below")), ("map", pa.list_(pa.int64())), ("payload", pa.binary())])
    meet_schema = pa.schema([("kind", pa.int32()), ("space", pa.int32()), ("id", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()),
                             ("own", pa.int32()), ("below", pa.int32()), *((m, pa.int64()) for m in MAPS)])

    def meet(group: pa.Table) -> pa.Table:
        """Rows of kind 0: (id, b = size, a = class) of documents; 1: pairs a, b with c common signatures; 2: members a (c = 1: own band) of group id."""
        drop_encoders()
        out = []

        def add(kind, n, **cols):
            zero = np.zeros(n, np.int64)
            out.append(pa.Table.from_arrays([pa.array(np.full(n, kind), pa.int32())] + [
                v if isinstance(v := cols.get(f.name, zero), (pa.Array, pa.ChunkedArray)) else pa.array(v).cast(f.type) for f in meet_schema][1:], schema=meet_schema))

        docs_ = group.filter(pa.compute.equal(group["kind"], 0))
        if docs_.num_rows:
            flat = {c: docs_[c].combine_chunks().flatten() for c in ("doc_id", "n", "key", "own", "below")}
            maps = docs_["map"].combine_chunks().flatten().to_numpy().reshape(-1, MAP_WORDS)
            add(0, len(flat["n"]), id=flat["doc_id"], b=flat["n"], a=flat["key"], own=flat["own"], below=flat["below"],
                **{m: np.ascontiguousarray(maps[:, i]) for i, m in enumerate(MAPS)})
        payload = b"".join(p for p in group["payload"].to_pylist() if p is not None)
        number, rec = common_groups(np.frombuffer(payload, RECORD))
        if len(rec):
            size = np.bincount(number)[number]
            two = size == 2
            if two.any():
                x, y = rec[two][::2], rec[two][1::2]
                kx, ky = x["k"].view(np.int64), y["k"].view(np.int64)
                pair = np.column_stack([x["j"] & 127, np.minimum(kx, ky), np.maximum(kx, ky)])
                pair, times = np.unique(pair, axis=0, return_counts=True)
                add(1, len(pair), space=pair[:, 0], a=pair[:, 1], b=pair[:, 2], c=times)
            if (~two).any():
                r = rec[~two]
                first = int(group["bucket"][0].as_py()) << 40
                add(2, len(r), space=(r["j"] & 127).astype(np.int64), id=number[~two] + first, a=np.ascontiguousarray(r["k"]).view(np.int64), c=(r["j"] >= _OWN).astype(np.int64))
        give_back()
        return pa.concat_tables(out) if out else meet_schema.empty_table()

    met = rows.mapInArrow(sign, schema).groupBy("bucket").applyInArrow(meet, "kind int, space int, id long, a long, b long, c long, own int, below int, " + ", ".join(f"{m} long" for m in MAPS))
    met = staged(met, "near-met")
    members = met.where("kind = 0").select(F.col("id").alias("doc_id"), F.col("b").alias("n"), F.col("a").alias("key"), "own", "below", *MAPS)
    classes = members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), *[F.max(c).alias(c) for c in ("n", "own", "below", *MAPS)])
    classes = staged(classes, "near-classes")
    pairs = met.where("kind = 1").groupBy("space", "a", "b").agg(F.sum("c").alias("c"))
    groups = met.where("kind = 2").select("space", "id", F.col("a").alias("key"), (F.col("c") > 0).alias("in_band"))

    def worth(p: DataFrame) -> DataFrame:
        """Pairs (with ``c`` common signatures of a space) whose sizes and counts allow a link."""
        side = lambda x: info.select(F.col("key").alias(x), *[F.col(c).alias(f"{c}{x}") for c in ("n", "own", "below", "fewer", *MAPS)])
        p = p.join(side("a"), "a").join(side("b"), "b").where(_possible("a", "b"))
        both = F.col("na") + F.col("nb")
        # What the asking set (in its own band; of two the one with the larger number) has left out is not counted.
        first = (_band(F.col("na")) == F.col("space")) & (_band(F.col("nb")) != F.col("space"))
        ask = lambda c: F.when(first, F.col(f"{c}a")).otherwise(F.col(f"{c}b"))
        # Space 0 signs single tokens: there the count is the intersection itself.
        need = F.when(F.col("space") == 0, F.floor((3 * both + 6) / 7)).otherwise(ask("own") - F.floor(both / 7))
        need = F.greatest(F.lit(1), need - ask("fewer"))
        return p.where(F.col("c") >= need).select("a", "b").distinct()

    def linked(p: DataFrame, name: str) -> DataFrame:
        """The pairs of ``p`` whose sets have 100 |a & b| >= 75 |a | b|, checked on the sets."""
        p = staged(p, f"{name}-pairs")
        wanted = p.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        reps = staged(wanted.join(classes.select("key", "rep"), "key"), f"{name}-wanted")

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            drop_encoders()
            words = _Words()
            for b in batches:
                for lo, hi, texts in text_slices(b.column(1), 1_000_000):
                    sets, at = shingle_sets(texts, words)
                    yield pa.RecordBatch.from_arrays([pa.array(class_keys(sets, at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(sets.view(np.int64)))],
                                                     names=["key", "tokens"])
            give_back()

        texts = rows.join(reps.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        if not reps.where("rep is null").isEmpty():  # classes without any id: all rows without one are read, none is moved
            texts = texts.unionByName(rows.where("doc_id is null"))
        sets = texts.select("doc_id", "text").mapInArrow(again, "key long, tokens array<long>")
        sets = staged(sets.join(reps.select("key"), "key", "left_semi").dropDuplicates(["key"]), f"{name}-sets")
        both = p.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        found = staged(both.where(100 * common >= 75 * (F.size("x") + F.size("y") - common)).select("a", "b"), f"{name}-links")
        free(p, reps, sets)
        return found

    # Signatures that a set in its own band leaves out: its most frequent ones, as far as the bound allows.
    sizes = groups.groupBy("space", "id").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= HOT)
    spare = F.when(F.col("space") == 0, F.floor((3 * F.col("n") + 3) / 4) - 1).otherwise(F.col("own") - F.floor(F.col("n") / 3) - 1)
    hot = groups.where("in_band").join(sizes, ["space", "id"]).join(classes.select("key", "n", "own"), "key")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("size"), "id"))
    left_out = hot.withColumn("rank", rank).where(F.col("rank") <= spare).select("space", "id", "key")
    left_out = staged(left_out, "near-left-out")
    fewer = left_out.groupBy("key").agg(F.count(F.lit(1)).alias("fewer"))
    groups = groups.join(left_out.withColumn("out", F.lit(True)), ["space", "id", "key"], "left")
    groups = groups.withColumn("asks", F.col("in_band") & F.col("out").isNull()).drop("out")
    asked = groups.groupBy("space", "id").agg(F.max("asks").alias("any")).where("any").select("space", "id")
    groups = staged(groups.join(asked, ["space", "id"], "left_semi"), "near-groups")
    info = classes.join(fewer, "key", "left").withColumn("fewer", F.coalesce("fewer", F.lit(0)))

    # First round: pairs and stars.  A star counts only the groups with this hub; what that
    # misses is in the second round.
    # The hub is the member with most groups: copies of one text then have the same hub almost everywhere.
    often = groups.groupBy("space", "key").agg(F.count(F.lit(1)).alias("times"))
    hubs = groups.where("asks").join(often, ["space", "key"]).groupBy("space", "id").agg(F.max(F.struct("times", "key")).alias("hub"))
    stars = groups.join(hubs.select("space", "id", F.col("hub.key").alias("hub")), ["space", "id"]).where("key <> hub").select("space", F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b"))
    first = pairs.unionByName(stars.withColumn("c", F.lit(1).cast("long"))).groupBy("space", "a", "b").agg(F.sum("c").alias("c"))
    tried = staged(worth(first), "near-first")
    links = linked(tried, "near-one")
    stars_one = connected_components(links, "a", "b")
    comps = stars_one.select(F.col("node").alias("key"), "component")

    # Second round: pairs of a group whose components differ.
    placed = groups.join(comps, "key", "left").withColumn("component", F.coalesce("component", "key"))
    mixed = placed.groupBy("space", "id").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("space", "id")
    mixed_rows = staged(placed.join(mixed, ["space", "id"], "left_semi"), "near-mixed")
    placed = mixed_rows.join(classes.select("key", "n", *MAPS), "key")
    x, y = placed.where("asks").alias("x"), placed.alias("y")
    role = (F.col("x.component") != F.col("y.component")) & (~F.col("y.in_band") | (F.col("y.key") < F.col("x.key")))
    # The sizes and parity maps are part of the join's condition: pairs of a common passage alone never leave it.
    cross = x.join(y, (F.col("x.space") == F.col("y.space")) & (F.col("x.id") == F.col("y.id")) & role & _possible("x.", "y."))
    cross = cross.select(F.col("x.space").alias("space"), F.col("x.key").alias("x"), F.col("y.key").alias("y"))
    cross = cross.groupBy("space", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    cross = cross.unionByName(pairs).groupBy("space", "a", "b").agg(F.sum("c").alias("c"))
    open_ = worth(cross).join(tried, ["a", "b"], "left_anti")
    side = lambda k: comps.select(F.col("key").alias(k), F.col("component").alias(f"c{k}"))
    open_ = open_.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    more = linked(open_, "near-two")
    stars_two = connected_components(links.unionByName(more), "a", "b")
    comps = stars_two.select(F.col("node").alias("key"), "component")

    # A component is named by the smallest id of its classes.
    named = classes.join(comps, "key", "left").withColumn("component", F.coalesce("component", "key"))
    names = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = named.join(names, "component").select("key", "component_id")
    out = members.join(of_class, "key", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
    out = staged(out, "near-documents")
    free(met, classes, left_out, groups, tried, links, mixed_rows, more, stars_one, stars_two)
    return out


def _band(n):
    out = F.lit(0)
    for j, e in enumerate(EDGES[:-1]):
        out = F.when(n > e, F.lit(j + 1)).otherwise(out)
    return out


def _possible(a: str, b: str):
    """Whether two sets may link by their sizes and parity maps; columns are ``na``, ``m0a`` .. or ``x.n``, ``x.m0`` .."""

    def of(side: str, c: str):
        return F.col(side + c if side.endswith(".") else c + side)

    na, nb = of(a, "n"), of(b, "n")
    apart = sum((F.bit_count(of(a, m).bitwiseXOR(of(b, m))) for m in MAPS[1:]), F.bit_count(of(a, MAPS[0]).bitwiseXOR(of(b, MAPS[0]))))
    return (4 * F.least(na, nb) >= 3 * F.greatest(na, nb)) & (7 * apart <= na + nb)
