"""Embedding near-duplicates: random-hyperplane sign hashing, exact cosines, components.

1. Equal vectors become one class (digest of the components) with a number of its own;
   ids of any type come back only at the end.  Vectors that are null,
   empty, zero or hold null or non-finite components link with nothing.
2. Every class vector gets ``tables`` keys of ``bits`` signs each.  Bits grow with the
   logarithm of the rows, so buckets keep their size (some ``BUCKET`` rows: few bits need
   few tables, and each table sends every vector once); tables follow from the wished
   recall at the threshold.  A row travels with its vector as given and the keys of the
   tables before, which tell where a pair met first.
3. Rows meet in their buckets.  A bucket above ``block`` rows is cut into salted blocks
   and all block pairs are work units of their own, so no task holds a hot bucket.
   A unit computes its cosines as one matrix product in double precision.  It gives each
   row the *number* of its links (a pair counts in the first table where it meets) and
   a spanning forest of the links: no pair list is ever written.
4. Link counts are summed, the forests' edges joined to components (:func:`connected_components`).

Defined cases: a copy of a vector links with its copies; rows that repeat an id share
a component, each with the links of its own vector; a row with a null id links like others
but names no component: one of only such rows has a null ``component_id`` and all its rows are
kept, else they are not; ids may be strings; vectors of different lengths are never compared; an empty table gives an
empty result; labels and other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.llm.common import connected_components, ship, staged

ship(__name__)

SEED = 9
BUCKET = 512


def table_count(bits: int, threshold: float, recall: float) -> int:
    """Tables needed to meet a pair at the threshold with the wished probability."""
    same = (1.0 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1.0 - recall) / math.log(1.0 - same)))


def hyperplane_keys(x: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Keys (rows x tables) of unit vectors; the hyperplanes depend on the dimension and a fixed seed only."""
    planes = np.random.Generator(np.random.PCG64([SEED, x.shape[1]])).standard_normal((x.shape[1], tables * bits))
    signs = (x @ planes >= 0).reshape(len(x), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(2)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row index linked to each of ``n`` rows, by label propagation with jumps."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root[root] != root).any():
        root = root[root]
    return root


def unit_links(x: np.ndarray, keys: np.ndarray, side: np.ndarray, threshold: float, step: int = 512):
    """Linked index pairs of one work unit: (first table or not, a, b).  ``keys``: those of the tables before; ``side``: 0 or 1 in a cross block, else all 2."""
    found = []
    for lo in range(0, len(x), step):
        hits = x[lo : lo + step] @ x.T >= threshold
        a, b = np.nonzero(hits)
        a += lo
        ok = (a < b) & ((side[a] != side[b]) | (side[a] == 2))
        found.append((a[ok], b[ok]))
    a, b = (np.concatenate(z) for z in zip(*found))
    first = ~(keys[a] == keys[b]).any(1)
    return first, a, b


def near_vectors(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.98, block: int = 1000, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``."""
    v = F.col("v")
    valid = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf")))) & \
        F.exists(v, lambda e: e != 0)
    # Single-precision vectors are hashed and compared in double precision but travel as they are.
    kind = "float" if vectors.schema[vector_col].dataType.elementType.simpleString() in ("float", "tinyint", "smallint") else "double"
    precision = np.float32 if kind == "float" else np.float64
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.transform(F.col(vector_col), lambda e: e.cast(kind) + F.lit(0).cast(kind)).alias("v"))
    rows = rows.select("vec_id", "v", F.coalesce(valid, F.lit(False)).alias("ok"), F.xxhash64("v").alias("h1"),
                       F.xxhash64(F.lit(1), F.col("v")).alias("h2"))
    classes = rows.where("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("m"), F.first("v").alias("v"))
    # The number is drawn while writing and read from then on.
    classes = staged(classes.withColumn("rep", F.monotonically_increasing_id()), "vec-classes")
    n = classes.count()
    bits = min(31, max(6, round(math.log2(max(n, 1) / BUCKET))))
    tables = table_count(bits, threshold, recall)
    key_type = np.int16 if bits < 16 else np.int32
    width = np.dtype(key_type).itemsize

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lens = np.diff(np.asarray(b.column(2).offsets))
            for d in np.unique(lens):
                at = np.flatnonzero(lens == d)
                x = np.asarray(b.column(2).take(pa.array(at)).flatten(), precision).reshape(-1, d)
                k = hyperplane_keys(unit(x.astype(np.float64)), tables, bits)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array([d] * len(at), pa.int32()),
                     pa.array([r.tobytes() for r in x], pa.binary()), pa.array(list(k), pa.list_(pa.int64())), pa.array([r.tobytes() for r in k.astype(key_type)], pa.binary())],
                    names=["rep", "m", "d", "x", "keys", "packed"])

    signed = staged(classes.select("rep", "m", "v").mapInArrow(sign, "rep long, m long, d int, x binary, keys array<long>, packed binary"), "vec-signed")
    spread = signed.select("rep", "m", "d", "x", "packed", F.posexplode("keys").alias("t", "key"))
    spread = spread.withColumn("before", F.substring("packed", F.lit(1), F.col("t") * width)).drop("packed")
    hot = spread.groupBy("t", "key", "d").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * block)
    hot = hot.select("t", "key", "d", F.ceil(F.col("n") / block).cast("int").alias("parts"))
    spread = spread.join(hot, ["t", "key", "d"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    spread = spread.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    # A row of part p is in the units (p, q >= p) and (q < p, p).
    spread = spread.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = spread.select("t", "key", "d", F.least("part", "q").alias("i"), F.greatest("part", "q").alias("j"),
                           "part", "rep", "m", "x", "before")
    unit_cols = ["t", "key", "d", "i", "j"]
    dealt = spread.repartition(*unit_cols).sortWithinPartitions(*unit_cols, "rep")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unit_rows(cols):
            t, d = int(cols["t"][0]), int(cols["d"][0])
            if len(cols["t"]) < 2:
                return None
            x = unit(np.frombuffer(b"".join(cols["x"]), precision).reshape(-1, d).astype(np.float64))
            keys = np.frombuffer(b"".join(cols["before"]), key_type).reshape(len(x), t)
            # In a cross block (i < j) only pairs between the parts count; (i, i) has all its pairs.
            side = np.where(cols["i"] == cols["j"], 2, (cols["part"] == cols["j"]).astype(int))
            first, a, b = unit_links(x, keys, side, threshold)
            if not len(a):
                return None
            m, rep = cols["m"], cols["rep"]
            links = np.zeros(len(m), np.int64)
            np.add.at(links, a[first], m[b[first]])
            np.add.at(links, b[first], m[a[first]])
            root = _forest(len(m), a, b)
            on = (links > 0) | (root != np.arange(len(m)))
            return rep[on], links[on], rep[root[on]]

        held: dict | None = None

        def collect(batch) -> dict:
            out = {n: batch.column(k).to_numpy(zero_copy_only=False) for k, n in enumerate(("t", "key", "d", "i", "j", "part", "rep", "m"))}
            out["x"] = np.array(batch.column(8).to_pylist(), object)
            out["before"] = np.array(batch.column(9).to_pylist(), object)
            return out

        def emit(parts):
            parts = [p for p in parts if p is not None]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z), pa.int64()) for z in zip(*parts)], names=["rep", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            c = collect(batch)
            if held is not None:
                c = {k: np.concatenate([held[k], c[k]]) for k in c}
            change = np.zeros(len(c["t"]), bool)
            change[0] = True
            for k in unit_cols:
                change[1:] |= c[k][1:] != c[k][:-1]
            starts = np.flatnonzero(change)
            yield from emit([unit_rows({k: z[s:e] for k, z in c.items()}) for s, e in zip(starts[:-1], starts[1:])])
            held = {k: z[starts[-1]:] for k, z in c.items()}
        if held is not None:
            yield from emit([unit_rows(held)])

    found = staged(dealt.select(*unit_cols, "part", "rep", "m", "x", "before").mapInArrow(work, "rep long, links long, root long"), "vec-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    numbered = rows.where("ok").select("vec_id", "h1", "h2").join(classes.select("h1", "h2", "rep"), ["h1", "h2"])
    # Vectors that share an id belong together, though they need not link.
    ids = numbered.where("vec_id IS NOT NULL").groupBy("vec_id", "rep").agg(F.lit(1)).select("vec_id", "rep")
    shared = ids.groupBy("vec_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("vec_id", "a")
    edges = found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(ids.join(shared, "vec_id").select("a", F.col("rep").alias("b")))
    comps = connected_components(edges, "a", "b").select(F.col("node").alias("rep"), "component")
    known = staged(classes.select("h1", "h2", "rep", "m", "first_id").join(counts, "rep", "left").join(comps, "rep", "left")
                   .withColumn("component", F.coalesce("component", "rep")), "vec-known")
    names = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = known.join(names, "component").select("h1", "h2", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component_id", F.lit(True).alias("ok"))
    out = rows.select("vec_id", "ok", "h1", "h2").join(known, ["h1", "h2", "ok"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.when(F.col("vec_id").isNull(), component.isNull()).otherwise(component == F.col("vec_id")).alias("kept"))
