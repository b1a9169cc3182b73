"""Fast condensed nearest neighbour (FCNN) instance selection, map-reduce style.

The rows are dealt into buckets by ``hash_bucket(id, seed, n_buckets)`` with
``n_buckets = ceil(n / max_rows)`` — uniform whatever the labels, so no bucket
is hot, and a bucket's size is bounded by ``max_rows`` in expectation.  After
oversampling the key is ``(id, copy_no)``, so the copies of one row spread
over many buckets however many there are.  Each
bucket is condensed independently by an Arrow-batched numpy kernel
(``groupBy(bucket).applyInPandas``); the output is the union of the selected
rows.  The result depends only on the ids, not on the partitioning.

FCNN rule per bucket (squared Euclidean distance, ties broken by id):

1. S = for each class, the row nearest the class centroid;
2. every row not in S keeps its k nearest rows of S (updated incrementally
   with the rows added last round); if their majority vote (tie: the
   nearest's label) misclassifies it, it is a candidate in the cell of its
   nearest s;
3. for each s, the candidate nearest to s joins S; repeat until no row is added.

Cost is quadratic in the bucket size only (n * |S| distances per bucket).

``fcnn_global`` applies the rule to the whole frame instead: a stored table of every row's
nearest chosen rows is updated only by the rows added last round, which meet all rows in
blocks (see ``topk``).  Rounds of at most ``SENT_BYTES`` are broadcast, so no vector is shuffled
for them; larger ones are shuffled.  Every round is written to the shared folder.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, ID, LABEL
from counterpoise.functions.hashing import hash_bucket
from counterpoise.functions.vectors import squared_distance
from counterpoise.operators.topk import Best, pack, search, search_sent, shape_of

# The pandas functions of this module run in Python workers: ship them by
# value so executors need not have this package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


BUCKET = "bucket"
SENT_BYTES = 32 << 20  # vectors added in a round that are broadcast; more of them are shuffled
_CHUNK = 512  # columns of the distance block: bounds kernel memory to ~n*512 doubles


def fcnn_kernel(x: np.ndarray, y: np.ndarray, k: int = 3) -> np.ndarray:
    """Indices (into rows ordered by id) of the condensed subset."""
    n = len(y)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    idx = np.arange(n)
    in_s = np.zeros(n, dtype=bool)
    best = Best(x, idx, k, others=False)  # exact distances, ties by index
    delta = []
    for c in np.unique(y):
        members = idx[y == c]
        xc = x[members]
        d = ((xc - xc.mean(0)) ** 2).sum(1)
        delta.append(members[np.lexsort((members, d))[0]])
    delta = np.array(sorted(delta), dtype=np.int64)
    while len(delta):
        in_s[delta] = True
        for start in range(0, len(delta), _CHUNK):
            block = delta[start : start + _CHUNK]
            best.add(x[block], block, y[block])
        knn_d, knn_i = np.full((n, k), np.inf), np.full((n, k), -1, dtype=np.int64)
        rank = np.arange(len(best.of)) - np.searchsorted(best.of, best.of)  # kept in order of row, distance, index
        knn_d[best.of, rank], knn_i[best.of, rank] = best.d, best.i
        valid = knn_i >= 0
        lab = np.where(valid, y[np.maximum(knn_i, 0)], 0.0)
        ones = (valid & (lab == 1.0)).sum(1)
        zeros = (valid & (lab == 0.0)).sum(1)
        vote = np.where(ones > zeros, 1.0, np.where(zeros > ones, 0.0, y[np.maximum(knn_i[:, 0], 0)]))
        wrong = idx[(~in_s) & (vote != y)]
        if len(wrong) == 0:
            break
        owner = knn_i[wrong, 0]
        dist = knn_d[wrong, 0]
        order = np.lexsort((wrong, dist, owner))
        owner_sorted = owner[order]
        first = np.ones(len(order), dtype=bool)
        first[1:] = owner_sorted[1:] != owner_sorted[:-1]
        delta = np.sort(wrong[order][first])
    return idx[in_s]


def _bucket_fn(k: int, key_cols: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key_cols, kind="stable").reset_index(drop=True)
        x = np.stack(pdf[FEATURES].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, 0))
        y = pdf[LABEL].to_numpy(dtype=np.float64)
        return pdf.iloc[fcnn_kernel(x, y, k)]

    return run


def _bucket_key(df: DataFrame):
    # Oversampled copies are dealt by (id, copy_no): an id with a huge number
    # of copies is spread over many buckets instead of filling one.
    if "copy_no" in df.columns:
        return F.concat(F.col(ID).cast("string"), F.lit("#"), F.col("copy_no").cast("string"))
    return F.col(ID)


def n_buckets_for(df: DataFrame, max_rows: int) -> int:
    return max(1, math.ceil(df.count() / max_rows))


def fcnn_select(
    df: DataFrame,
    k: int = 3,
    max_rows: int = 5000,
    seed: int = 2015,
    n_buckets: int | None = None,
    checkpoint: bool = False,
) -> DataFrame:
    """Condensed subset of ``df`` (same columns plus ``bucket``).

    ``checkpoint=True`` writes the result to ``spark.checkpoint.dir`` so a lost
    executor does not re-run the quadratic kernels of its buckets.
    """
    if "weight" in df.columns:
        raise ValueError("condensation counts every row once: pass copies (copy_no), not weights")
    nb = n_buckets or n_buckets_for(df, max_rows)
    keys = [ID] + (["copy_no"] if "copy_no" in df.columns else [])
    b = df.withColumn(BUCKET, hash_bucket(_bucket_key(df), seed, nb))
    out = b.groupBy(BUCKET).applyInPandas(_bucket_fn(k, keys), schema=b.schema)
    if checkpoint:
        from counterpoise.session import checkpoint_dir

        checkpoint_dir(df.sparkSession)
        out = out.checkpoint(eager=True)
    return out


def fcnn_seeds(df: DataFrame, n_buckets: int, seed: int = 2015, d: int | None = None) -> DataFrame:
    """Step 1 in DataFrame form: per (bucket, label) the row nearest the class centroid.

    Two aggregations with partial aggregates (centroids, then a min over
    ``struct(distance, id)``); no window, no collect.
    """
    from counterpoise.frame import num_features

    d = d or num_features(df)
    b = df.withColumn(BUCKET, hash_bucket(ID, seed, n_buckets))
    x = F.col(FEATURES)
    cent = b.groupBy(BUCKET, LABEL).agg(F.array(*[F.avg(x[j]) for j in range(d)]).alias("_c"))
    j = b.join(cent, [BUCKET, LABEL]).withColumn("_d", squared_distance(FEATURES, "_c"))
    best = j.groupBy(BUCKET, LABEL).agg(F.min(F.struct("_d", ID)).alias("_m"))
    return best.select(BUCKET, LABEL, F.col("_m")[ID].alias(ID))


def bucket_errors(rows: DataFrame) -> DataFrame:
    """Per bucket ``(bucket, n, classes, errors, strangers)`` of rows marked ``chosen`` (1 or null).

    ``errors``: rows whose nearest chosen row (ties: the smallest id) has another label;
    ``classes``: labels among the chosen rows; ``strangers``: chosen rows not in the frame.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        known = pdf[pdf[LABEL].notna()].sort_values(ID, kind="stable")
        strangers = len(pdf) - len(known)
        x, y = np.stack(known[FEATURES].to_numpy()).astype(np.float64), known[LABEL].to_numpy()
        s = np.flatnonzero(known["chosen"].notna().to_numpy())
        errors, step = 0, 32  # bounds the difference block to 32 rows of the selection
        for lo in range(0, len(x), step):
            d = ((x[lo : lo + step, None, :] - x[s][None, :, :]) ** 2).sum(2) if len(s) else np.zeros((len(x[lo : lo + step]), 0))
            errors += int((y[s][d.argmin(1)] != y[lo : lo + step]).sum()) if len(s) else len(d)
        return pd.DataFrame({BUCKET: [pdf[BUCKET].iloc[0]], "n": [len(known)], "classes": [len(set(y[s]))], "errors": [errors], "strangers": [strangers]})

    return rows.groupBy(BUCKET).applyInPandas(run, f"{BUCKET} int, n long, classes long, errors long, strangers long")


def fcnn_global(df: DataFrame, k: int = 3, block: int = 2048, max_rounds: int = 1000, log: list | None = None) -> DataFrame:
    """Condensed subset of the whole frame (same columns): consistent over all rows, not bucket by bucket.

    Any number of classes.  ``log`` receives the number of rows added in each round.  The
    rounds end when every row outside the selection is classified as labelled; each adds at
    least one row.
    """
    from counterpoise.operators.topk import _written

    if "weight" in df.columns:
        raise ValueError("condensation counts every row once: pass copies (copy_no), not weights")
    key = _bucket_key(df)
    rows = _written(df.select(key.alias("id"), F.col(LABEL).cast("double").alias("label"), F.transform(FEATURES, lambda e: e.cast("double")).alias("x")), "fcnn-rows")
    n = rows.count()
    if not n:
        return df
    blocks = math.ceil(n / block)
    dealt = rows.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    # In as many files as tasks can read at once: the rounds scan them.
    tasks = min(blocks, 2 * df.sparkSession.sparkContext.defaultParallelism)
    query_blocks = _written(pack(dealt, "qb").repartition(tasks, "qb"), "fcnn-blocks")
    numbers, shape = query_blocks.select("qb"), shape_of(query_blocks)

    # The row nearest its class' centroid, per class.
    centre = rows.select("label", F.posexplode("x").alias("j", "v")).groupBy("label", "j").agg(F.avg("v").alias("c"))
    centre = centre.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "c"))), lambda e: e["c"]).alias("c"))
    seeds = rows.join(centre, "label").groupBy("label").agg(F.min(F.struct(squared_distance("x", "c").alias("d"), F.col("id").alias("id"))).alias("m"))
    delta = _written(rows.join(seeds.select(F.col("m.id").alias("id")), "id", "left_semi"), "fcnn-added")
    paths = [delta._path]  # the selection is the rounds' tables together: none is written twice
    # Of every row its own label and the nearest chosen rows so far.
    hit = "struct<d2: double, neighbour: " + rows.schema["id"].dataType.simpleString() + ", label: double>"
    near = rows.select("id", F.col("label").alias("own"), F.array().cast(f"array<{hit}>").alias("top"))

    def chosen():
        return df.sparkSession.read.schema(rows.schema).parquet(*paths)

    for _ in range(max_rounds):
        added = delta.count()
        if log is not None:
            log.append(added)
        if not added:
            break
        if added * (shape[1] // n + 1) <= SENT_BYTES:
            found = search_sent(query_blocks, delta, k, others=False)
        else:
            parts = math.ceil(added / 512)
            point_blocks = _written(pack(delta.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")), "block"), "fcnn-points")
            pairs = numbers.select("qb", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("block"))
            found = search(query_blocks, point_blocks, pairs, k, others=False, most=parts, shape=shape, share=added / n)
        hits = found.select("id", F.lit(None).cast("double").alias("own"), F.struct("d2", "neighbour", "label").cast(hit).alias("t"))
        hits = near.select("id", "own", F.explode_outer("top").alias("t")).unionByName(hits)
        near = _written(hits.groupBy("id").agg(F.max("own").alias("own"), F.slice(F.array_sort(F.collect_list("t")), 1, k).alias("top")), "fcnn-near")
        # Most votes; a tie goes to the class of the nearest row.
        first = lambda c: F.filter("top", lambda t: t["label"].eqNullSafe(c))
        votes = F.transform(F.array_distinct(F.transform("top", lambda t: t["label"])), lambda c: F.struct(
            (-F.size(first(c))).alias("m"), F.get(first(c), F.lit(0)).alias("first"), c.alias("voted")))
        said = near.where("id IS NOT NULL").select("id", "own", F.array_min(votes).alias("best"), F.get("top", F.lit(0)).alias("nearest"))
        wrong = said.where(F.col("best.voted") != F.col("own")).join(chosen().select("id"), "id", "left_anti")
        picked = wrong.groupBy("nearest.neighbour").agg(F.min(F.struct("nearest.d2", "id")).alias("m")).select(F.col("m.id").alias("id"))
        delta = _written(rows.join(picked, "id", "left_semi"), "fcnn-added")
        paths.append(delta._path)
    else:
        raise RuntimeError("condensation did not settle")
    return df.join(chosen().select(F.col("id").alias("_k")), key == F.col("_k"), "left_semi")
