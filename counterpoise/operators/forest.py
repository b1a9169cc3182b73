"""Random forest by histograms: one Spark job per level for all trees, independent of the layout.

Bagging is a property of the data: tree t takes row i ``Poisson(1)`` times, drawn from
``md5("<seed>:bag-<t // 4>:<id>")`` (four 32-bit draws a digest), so the same rows give the same
forest on 1, 8 or 1000 partitions, without sorting or dealing them, and the weights can
be recomputed in SQL.  ``pyspark.ml`` draws per partition, which ties a seeded forest to
the layout; it also fits whole trees, whereas here every level of all trees is one pass:

1. *Edges*: the rows with the smallest draws, at most ``max(max_bins**2, 10_000)``, give
   each feature's thresholds (midpoints of neighbouring values, or weighted quantiles).
2. *Binning*: label, weight, one byte per feature and one per tree (its bag count), written
   once to the shared folder in blocks of rows (``BLOCK_SCHEMA``), so a pass moves whole
   arrays.  A lost executor costs a part of one pass.
   Rows of a slice that are alike (label, weight and bins) become one, their bags added up.
3. *Level*: each task adds its rows to the histograms (node, feature, bin, class) of the
   open nodes; partial histograms meet by (tree, node) and only the best split of every
   node returns to the driver: at most ``trees * 2**depth`` small rows, whatever the data.
   Passes take as many nodes at once as ``MOST_CELLS`` allows, so memory is bounded.
4. *Ends*: nodes of at most ``LOCAL_ROWS`` rows are not asked level by level: their rows are
   dealt out by node once, and a task grows what lies below a bounded share of them to the end.

Splits maximise the weighted Gini gain over a random feature subset per node (ties: the
first feature, then the lowest threshold); a node is a leaf when it is pure, at
``max_depth`` or without gain.  The vote adds the trees' class shares (or, with
``votes=True``, one vote a tree), a tie gives the smaller class.  With whole-number
weights every sum is exact.  ``grow`` also takes trees that see different features, which
is how PCARD's members are fitted together.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, ID, LABEL, num_features
from counterpoise.functions.hashing import hash_uniform, poisson_cdf
from counterpoise.session import small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_CELLS = 12_000_000  # histogram cells (8 bytes) held by a task
SENT_CELLS = 500_000  # of them looked through at once when they are handed on
EDGE_ROWS = 10_000
LOCAL_ROWS = 250_000  # rows of a node that one task grows to its end
LOCAL_BYTES = 16 << 20  # of rows dealt out together to a task for that
BLOCK_SCHEMA = "y binary, w binary, x binary, bag binary"  # rows of a block: int32, double, bytes by row, bytes by tree
NODE_SCHEMA = "tree int, node int, depth int, feature int, threshold double, left int, right int, counts array<double>, n double, prediction double, gain double"


def _key(df: DataFrame) -> Column:
    # Copies of a row are rows of their own to the bag.
    if "copy_no" in df.columns:
        return F.concat(F.col(ID).cast("string"), F.lit("#"), F.col("copy_no").cast("string"))
    return F.col(ID).cast("string")


def bag_thresholds(rate: float = 1.0) -> list[str]:
    """The Poisson CDF as 8-digit hex strings: a draw's count is the number of them that do not exceed it."""
    lo, cdf = poisson_cdf(rate)
    return ["00000000"] * lo + [f"{math.ceil(c * 2**32):08x}" for c in cdf if c * 2**32 < 2**32]


def bag_counts(key: Column, trees: int, seed: int) -> Column:
    """``array<tinyint>``: how often each tree takes the row of this key."""
    steps = bag_thresholds()
    blocks = F.transform(F.sequence(F.lit(0), F.lit((trees - 1) // 4)), lambda b: F.md5(F.concat(F.lit(f"{seed}:bag-"), b.cast("string"), F.lit(":"), key)))

    def count(draw: Column) -> Column:
        out = F.lit(len(steps))
        for k in range(len(steps) - 1, -1, -1):
            out = F.when(draw < steps[k] if len(steps[k]) == 8 else draw.isNotNull(), F.lit(k)).otherwise(out)  # 2**32 as a string is no bound
        return out.cast("tinyint")

    draws = F.flatten(F.transform(blocks, lambda h: F.array(*[F.substring(h, 8 * j + 1, 8) for j in range(4)])))
    return F.transform(F.slice(draws, 1, trees), count)


def draw_bags(keys: list[bytes | None], trees: int, seed: int) -> np.ndarray:
    """``bag_counts`` inside a task, a row per key: the same digests, cut and counted as arrays."""
    try:
        from _md5 import md5  # half the time of OpenSSL's for messages this short
    except ImportError:
        from hashlib import md5
    steps = [int(s, 16) for s in bag_thresholds()]
    starts = [f"{seed}:bag-{b}:".encode() for b in range((trees - 1) // 4 + 1)]
    unkeyed = bytes(16)
    draws = np.frombuffer(b"".join([unkeyed if k is None else md5(s + k).digest() for k in keys for s in starts]), ">u4").reshape(len(keys), -1)[:, :trees].astype(np.uint32)
    out = np.zeros(draws.shape, np.uint8)
    for s in steps:
        if s < 2**32:  # no draw reaches the others
            out += draws >= np.uint32(s)
    out[[k is None for k in keys]] = len(steps)  # a null key is below no threshold
    return out


def bag_weights(df: DataFrame, trees: int, seed: int) -> DataFrame:
    """``(id, tree, bag)`` of every row and tree: what ``fit_forest`` weighs rows by."""
    keys = [ID] + (["copy_no"] if "copy_no" in df.columns else [])
    return df.select(*keys, F.posexplode(bag_counts(_key(df), trees, seed)).alias("tree", "bag"))


def _edges(values: np.ndarray, weights: np.ndarray, max_bins: int) -> np.ndarray:
    """At most ``max_bins - 1`` ascending thresholds between the distinct values of a feature."""
    distinct, where = np.unique(values, return_inverse=True)
    if len(distinct) < 2:
        return np.zeros(0)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) < max_bins:
        return middles
    below = np.cumsum(np.bincount(where, weights))[:-1]
    stride = weights.sum() / max_bins
    # For each quantile the first value that reaches it; equal ones fall together.
    picked = np.unique(np.minimum(np.searchsorted(below, stride * np.arange(1, max_bins)), len(middles) - 1))
    return middles[picked]


def feature_edges(df: DataFrame, max_bins: int = 100, seed: int = 1, weight_col: str | None = None, features_col: str = FEATURES,
                  n: int | None = None) -> list[np.ndarray]:
    """Thresholds per feature from a sample that depends on ids only; its bound is a parameter.  ``n``: the frame's rows, if known."""
    most = max(max_bins * max_bins, EDGE_ROWS)
    key = _key(df)
    rows = df.select(hash_uniform(key, f"edges-{seed}").alias("_u"), key.alias("_k"), F.col(features_col).alias("x"), (F.col(weight_col) if weight_col else F.lit(1.0)).cast("double").alias("w"))
    # Only draws that can be among the smallest reach the sort: about ``most`` rows, however many there are.
    n = df.count() if n is None else n
    share = (most + 8 * math.sqrt(most)) / n if n else 1.0
    got = (rows.where(F.col("_u") < share) if share < 1 else rows).orderBy("_u", "_k").limit(most).select("x", "w").collect()
    if not got:
        raise ValueError("cannot fit a forest on an empty frame")
    x, w = np.array([r.x for r in got], float), np.array([r.w for r in got])
    return [_edges(x[:, j], w, max_bins) for j in range(x.shape[1])]


def _matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column of equally long lists as a matrix."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(n, -1) if n else np.zeros((0, 1), dtype)


def bin_matrix(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of every value: how many thresholds lie below it."""
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j], side="left")
    return out


@dataclass
class Nodes:
    """The nodes of all trees as arrays; tree t starts at node t.  ``feature`` -1 marks a leaf, the right child follows the left."""

    tree: np.ndarray
    depth: np.ndarray
    feature: np.ndarray
    cut: np.ndarray  # bin <= cut goes left
    threshold: np.ndarray
    left: np.ndarray
    counts: np.ndarray
    gain: np.ndarray

    @staticmethod
    def roots(trees: int, classes: int) -> Nodes:
        z = np.zeros(trees, np.int32)
        return Nodes(np.arange(trees, dtype=np.int32), z, z - 1, z.copy(), np.full(trees, np.nan), z - 1, np.zeros((trees, classes)), np.zeros(trees))

    def walk(self, bins: np.ndarray, tree: int) -> np.ndarray:
        """The node at which every row of binned features stands in a tree."""
        return self._walk(bins, self.cut, tree)

    def walk_raw(self, x: np.ndarray, tree: int) -> np.ndarray:
        return self._walk(x, self.threshold, tree)

    def _walk(self, x: np.ndarray, border: np.ndarray, tree: int) -> np.ndarray:
        out = np.full(len(x), tree, np.int32)
        if self.feature[tree] < 0:
            return out
        flat, first = x.ravel(), np.arange(len(x)) * x.shape[1]
        rows, at = None, out
        while True:
            f = self.feature[at]
            at = self.left[at] + (flat[first + f] > border[at])
            if rows is None:
                out = at
            else:
                out[rows] = at
            # Rows that stand on a leaf need no further step.
            inner = np.flatnonzero(self.feature[at] >= 0)
            if not len(inner):
                return out
            if len(inner) < len(at):
                rows, at, first = inner if rows is None else rows[inner], at[inner], first[inner]

    def shares(self) -> np.ndarray:
        total = self.counts.sum(1, keepdims=True)
        return np.divide(self.counts, total, out=np.zeros_like(self.counts), where=total > 0)


def _best_splits(hist: np.ndarray, subset: np.ndarray, edge_counts: np.ndarray) -> tuple:
    """Per node the best (feature, cut, gain, left counts, all counts) of ``hist[node, feature of the subset, bin, class]``;
    ``edge_counts[node, feature]``: thresholds that the feature has."""
    total = hist[:, 0].sum(1)
    left = np.cumsum(hist, 2)
    right = total[:, None, None, :] - left
    nl, nr = left.sum(3), right.sum(3)
    n = total.sum(1)

    def impure(c, m):  # weighted Gini: m * (1 - sum p^2)
        return m - np.divide((c * c).sum(-1), m, out=np.zeros_like(m), where=m > 0)

    parent = impure(total, n)
    gain = parent[:, None, None] - impure(left, nl) - impure(right, nr)
    ok = (nl > 0) & (nr > 0) & (np.arange(hist.shape[2])[None, None, :] < np.take_along_axis(edge_counts, subset, 1)[:, :, None])
    gain = np.where(ok, gain, -1.0)
    best = gain.reshape(len(hist), -1).argmax(1)
    f, b = np.divmod(best, hist.shape[2])
    rows = np.arange(len(hist))
    g = gain[rows, f, b]
    return subset[rows, f], b, np.where(g > 1e-9 * np.maximum(n, 1), g, -1.0), left[rows, f, b], total


def _subsets(seed: int, tree: np.ndarray, path: np.ndarray, widths: list[int], d: int, k: int) -> np.ndarray:
    """The features that each node may split on, drawn from the seed, the tree and the node's path: those with the smallest draws."""
    if k >= d:
        return np.broadcast_to(np.arange(d), (len(tree), d))
    with np.errstate(over="ignore"):
        h = (np.uint64(seed & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15) + tree.astype(np.uint64))[:, None] * np.uint64(0xD1B54A32D192ED03)
        h = (h + path.astype(np.uint64)[:, None]) * np.uint64(0xBF58476D1CE4E5B9) + np.arange(d, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
        for by in (30, 27, 31):
            h = (h ^ (h >> np.uint64(by))) * np.uint64(0x94D049BB133111EB)
    h = np.where(np.arange(d) < np.array(widths)[tree][:, None], h >> np.uint64(1), np.uint64(2**64 - 1))
    return np.sort(np.argsort(h, 1, kind="stable")[:, :k], 1)


def spread_for(spark: SparkSession, rows: int) -> int:
    """How many tasks a level runs on: the session's cores and shuffle partitions, fewer where the rows are few."""
    return max(1, min(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-rows // 2000)))


def subset_size(how: str, d: int, trees: int) -> int:
    if how == "auto":
        how = "sqrt" if trees > 1 else "all"
    return {"all": d, "sqrt": math.ceil(math.sqrt(d)), "log2": max(1, math.ceil(math.log2(d))), "onethird": math.ceil(d / 3)}[how]


@dataclass
class ForestModel:
    nodes: Nodes
    trees: int
    features_col: str = FEATURES
    prediction_col: str = "prediction"
    votes: bool = False  # one vote a tree instead of its leaf's class shares

    def leaf_votes(self) -> np.ndarray:
        return np.eye(self.nodes.counts.shape[1])[self.nodes.counts.argmax(1)] if self.votes else self.nodes.shares()

    def predict_col(self, features: Column | None = None) -> Column:
        """The vote as a column: Arrow batches through the trees' arrays."""
        nodes, trees, shares = self.nodes, self.trees, self.leaf_votes()

        @F.arrow_udf("double")
        def vote(features: pa.Array) -> pa.Array:
            if not len(features):
                return pa.array([], pa.float64())
            x = _matrix(features)
            total = np.zeros((len(x), shares.shape[1]))
            for t in range(trees):
                total += shares[nodes.walk_raw(x, t)]
            return pa.array(total.argmax(1).astype(float))

        return vote(F.col(self.features_col) if features is None else features)

    def transform(self, df: DataFrame, prediction_col: str | None = None) -> DataFrame:
        return df.withColumn(prediction_col or self.prediction_col, self.predict_col())

    def node_table(self, spark: SparkSession) -> DataFrame:
        """The fitted trees as a relation (see ``NODE_SCHEMA``): one row per node, children by number."""
        m = self.nodes
        inner = m.feature >= 0
        rows = [(int(m.tree[i]), i, int(m.depth[i]), int(m.feature[i]), float(m.threshold[i]) if inner[i] else None, int(m.left[i]) if inner[i] else -1,
                 int(m.left[i]) + 1 if inner[i] else -1, m.counts[i].tolist(), float(m.counts[i].sum()), float(m.counts[i].argmax()), float(m.gain[i]))
                for i in range(len(m.tree))]
        return spark.createDataFrame(rows, NODE_SCHEMA)


def fit_forest(df: DataFrame, num_trees: int = 100, max_depth: int = 10, max_bins: int = 100, feature_subset: str = "auto", weight_col: str | None = None,
               seed: int = 1, features_col: str = FEATURES, label_col: str = LABEL, classes: int = 2, bootstrap: bool = True, partitions: int | None = None) -> ForestModel:
    """A forest on a labelled frame.

    The rows are dealt out once by a hash of their key, over ``partitions`` or as many as
    the session's cores and shuffle partitions, so a source in one file or with a hot
    partition still uses all cores; the forest does not depend on the number.
    """
    if not 2 <= max_bins <= 256:
        raise ValueError("max_bins must be between 2 and 256")
    from counterpoise.session import scratch_path

    spark = df.sparkSession
    # The frame is computed once: the rows are counted, looked through for edges and dealt out from here.
    path, schema = scratch_path(spark, "forest-frame"), "_k string, _i long, y int, w double, x array<double>"
    df.select(_key(df).alias("_k"), F.xxhash64(ID).alias("_i"), F.col(label_col).cast("int").alias("y"), (F.col(weight_col) if weight_col else F.lit(1.0)).cast("double").alias("w"),
              F.transform(features_col, lambda e: e.cast("double")).alias("x")).write.parquet(path)
    frame = spark.read.schema(schema).parquet(path)
    n = frame.count()
    if not n:
        raise ValueError("cannot fit a forest on an empty frame")
    d = num_features(df, features_col)
    edges = feature_edges(frame.withColumnRenamed("_k", ID), max_bins, seed, "w", "x", n)
    # Copies of a row come to one task and stand together there: they are alike.
    dealt = frame.repartition(partitions or spread_for(spark, n), "_i").sortWithinPartitions("x")

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 5000):
                part = b.slice(lo, 5000)
                bags = draw_bags(part.column(3).to_pylist(), num_trees, seed) if bootstrap else np.ones((part.num_rows, num_trees), np.uint8)
                yield block_of(*merge_alike(part.column(0).to_numpy(), part.column(1).to_numpy(), bin_matrix(_matrix(part.column(2)), edges), bags))

    rows = write_blocks(dealt.select("y", "w", "x", F.col("_k").cast("binary").alias("_k")).mapInArrow(binned, BLOCK_SCHEMA), "forest-rows")
    return grow(rows, num_trees, [edges] * num_trees, _same_for_all, max_depth, subset_size(feature_subset, d, num_trees), seed, classes, features_col, n)


def merge_alike(y: np.ndarray, w: np.ndarray, x: np.ndarray, bags: np.ndarray) -> tuple:
    """Rows with the same label, weight and bins as one row whose bag counts are their sums (several, where a count would pass 255)."""
    key = np.concatenate([x, y.astype(np.int32).view(np.uint8).reshape(len(y), -1), w.astype(np.float64).view(np.uint8).reshape(len(y), -1)], 1)
    _, first, which = np.unique(np.ascontiguousarray(key).view(f"V{key.shape[1]}").ravel(), return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    total = np.add.reduceat(bags[order], np.searchsorted(which[order], np.arange(len(first))), 0, dtype=np.int64)
    out = []
    while len(first):
        out.append((first, np.minimum(total, 255).astype(np.uint8)))
        total = total - out[-1][1]
        more = total.any(1)
        first, total = first[more], total[more]
    first = np.concatenate([f for f, _ in out])
    return y[first], w[first], x[first], np.concatenate([b for _, b in out])


def block_of(y: np.ndarray, w: np.ndarray, x: np.ndarray, bags: np.ndarray) -> pa.RecordBatch:
    """Rows as one block: labels, weights, binned features and bag counts (rows by trees)."""
    parts = {"y": y.astype(np.int32), "w": w, "x": x, "bag": np.ascontiguousarray(bags.T)}
    return pa.record_batch({name: pa.array([a.tobytes()], pa.binary()) for name, a in parts.items()})


def write_blocks(blocks: DataFrame, name: str) -> DataFrame:
    """Blocks in the shared folder, in row groups that a reader holds easily."""
    from counterpoise.session import scratch_path

    path = scratch_path(blocks.sparkSession, name)
    blocks.write.option("parquet.block.size", str(32 << 20)).parquet(path)
    return blocks.sparkSession.read.schema(BLOCK_SCHEMA).parquet(path)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for row in range(b.num_rows):
            y, w, x, bag = (np.frombuffer(b.column(c)[row].as_buffer(), kind) for c, kind in enumerate((np.int32, np.float64, np.uint8, np.uint8)))
            yield y, w, x.reshape(len(y), -1), bag.reshape(-1, len(y))


def _same_for_all(x: np.ndarray) -> Callable:
    return lambda tree: x


def grow(stored: DataFrame, trees: int, edges: list[list[np.ndarray]], matrices: Callable, max_depth: int, subset: int, seed: int, classes: int = 2,
         features_col: str = FEATURES, rows: int | None = None) -> ForestModel:
    """Grow all trees over stored blocks of rows; ``matrices(x)(tree)`` gives a tree's binned features of a block, ``rows`` is a bound on their number."""
    spark = stored.sparkSession
    nodes = Nodes.roots(trees, classes)
    path = np.ones(trees, np.int64)  # a node's way from its root: 1, then 2p and 2p + 1
    most = max(len(own) for own in edges)
    counts = np.array([[len(e) for e in own] + [0] * (most - len(own)) for own in edges])  # no threshold, no split: padding is never chosen
    bins, width = int(counts.max()) + 1, min(subset, most)
    widths = [len(e) for e in edges]
    local = min(LOCAL_ROWS, LOCAL_BYTES // (16 + most)) if max_depth < 40 else -1
    bound = np.full(trees, math.inf if rows is None else rows)  # most rows of each node
    below_local = _Found(classes)  # all asked nodes at and below those that are local
    open_ = np.arange(trees)
    for depth in range(max_depth + 1):
        if not len(open_):
            break
        per_pass = max(1, MOST_CELLS // (width * bins * classes))
        near = open_[(bound[open_] >= 0) & (bound[open_] <= local)]
        if len(near):
            below_local.add(_ends(spark, stored, nodes, path, near, bound[near] if depth == 0 else bound[near] / 2, matrices, seed, widths, most, width, bins, classes, counts, max_depth))
        known = (bound[open_] < 0) | (bound[open_] <= local)
        far = open_[~known]
        found = [_level(spark, stored, nodes, group, _subsets(seed, nodes.tree[group], path[group], widths, most, width), matrices, bins, classes, counts)
                 for group in np.split(far, range(per_pass, len(far), per_pass)) if len(group)]
        asked = open_[known]
        n, f, b, gain, held, below, total = (np.concatenate(z) for z in zip(
            (asked, *below_local.of(nodes.tree[asked], path[asked])),
            *((*(t.column(c).to_numpy() for c in ("node", "feature", "cut", "gain", "rows")),
               *(t.column(c).combine_chunks().flatten().to_numpy().reshape(-1, classes) for c in ("below", "total"))) for t in found)))
        order = np.argsort(n)
        n, f, b, gain, held, below, total = (a[order] for a in (n, f, b, gain, held, below, total))
        nodes.counts[n] = total
        split = (f >= 0) & (depth < max_depth)
        n, f, b, gain, held, below, total = (a[split] for a in (n, f, b, gain, held, below, total))
        if not len(n):
            break
        t, k = nodes.tree[n], 2 * len(n)
        nodes.feature[n], nodes.cut[n], nodes.gain[n], nodes.left[n] = f, b, gain, len(nodes.tree) + 2 * np.arange(len(n))
        nodes.threshold[n] = [edges[i][j][c] for i, j, c in zip(t.tolist(), f.tolist(), b.tolist())]
        child = np.stack([below, total - below], 1).reshape(k, classes)
        # Pure children and those of the last level are leaves; the others are asked next.
        open_ = len(nodes.tree) + np.flatnonzero(((child > 0).sum(1) > 1) & (depth + 1 < max_depth))
        path = np.concatenate([path, (2 * path[n][:, None] + np.arange(2)).ravel()])
        bound = np.concatenate([bound, np.repeat(held, 2)])
        nodes = Nodes(*(np.concatenate([a, b]) for a, b in zip(
            (nodes.tree, nodes.depth, nodes.feature, nodes.cut, nodes.threshold, nodes.left, nodes.counts, nodes.gain),
            (np.repeat(t, 2), np.full(k, depth + 1, np.int32), np.full(k, -1, np.int32), np.zeros(k, np.int32), np.full(k, np.nan), np.full(k, -1, np.int32), child, np.zeros(k)))))
    return ForestModel(nodes, trees, features_col)


class _Found:
    """Answers for nodes, looked up by tree and path; a node found here has -1 for its rows: so have its children."""

    def __init__(self, classes: int):
        self.key, self.rest = np.zeros(0, np.int64), [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, classes)), np.zeros((0, classes))]

    def add(self, t: pa.Table) -> None:
        classes = self.rest[-1].shape[1]
        key = np.concatenate([self.key, (t.column("tree").to_numpy().astype(np.int64) << 40) + t.column("path").to_numpy()])
        new = [*(t.column(c).to_numpy() for c in ("feature", "cut", "gain")), *(t.column(c).combine_chunks().flatten().to_numpy().reshape(-1, classes) for c in ("below", "total"))]
        order = np.argsort(key)
        self.key, self.rest = key[order], [np.concatenate(z)[order] for z in zip(self.rest, new)]

    def of(self, tree: np.ndarray, path: np.ndarray) -> tuple:
        key = (tree.astype(np.int64) << 40) + path
        at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        f, b, gain, below, total = (a[at] if len(self.key) else a[:0] for a in self.rest)
        # A tree whose bag is empty has no rows and no answer.
        none = (self.key[at] if len(self.key) else key[:0]) != key[: len(f)]
        f, gain, below, total = np.where(none, -1, f), np.where(none, -1.0, gain), np.where(none[:, None], 0.0, below), np.where(none[:, None], 0.0, total)
        return f, b, gain, np.full(len(f), -1.0), below, total


def _standing(batches: Iterator[pa.RecordBatch], nodes: Nodes, group: np.ndarray, matrices: Callable) -> Iterator[list]:
    """Per block, for every tree of the group: (number within the group, features, weights, labels) of the rows that stand at its nodes."""
    number = np.full(len(nodes.tree), -1, np.int64)
    number[group] = np.arange(len(group))
    trees = np.unique(nodes.tree[group]).tolist()
    for y, w, x, bag in _blocks(batches):
        own_matrix = matrices(x)
        yield (_rows_at(number, nodes, t, own_matrix(t), w, bag[t], y) for t in trees)


def _rows_at(number: np.ndarray, nodes: Nodes, t: int, x: np.ndarray, w: np.ndarray, bag: np.ndarray, y: np.ndarray) -> tuple:
    taken = np.flatnonzero(bag)
    if len(taken) < len(y):
        x = x[taken]
    at = number[nodes.walk(x, t)]
    here = np.flatnonzero(at >= 0)
    if len(here) < len(at):
        at, x, taken = at[here], x[here], taken[here]
    return at, x, w[taken] * bag[taken], y[taken]


def _add_rows(hist: np.ndarray, x: np.ndarray, node: np.ndarray, weight: np.ndarray, y: np.ndarray, allowed: np.ndarray, bins: int, classes: int) -> None:
    """Adds rows to the histograms of the nodes (numbers within the group) where they stand, feature by feature: nothing as large as the histograms is made."""
    k, d = allowed.shape[1], x.shape[1]
    flat, first = x.ravel(), np.arange(len(x)) * d
    base = node * (k * bins * classes) + y
    for j in range(k):
        value = x[:, j] if k == d else flat[first + allowed[node, j]]  # every feature, in order
        np.add.at(hist, base + (value.astype(np.int64) + j * bins) * classes, weight)


def _level(spark: SparkSession, stored: DataFrame, nodes: Nodes, group: np.ndarray, allowed: np.ndarray, matrices: Callable, bins: int, classes: int, counts: np.ndarray) -> pa.Table:
    """Best splits of a group of open nodes: partial histograms, merged by node."""
    sent = spark.sparkContext.broadcast((nodes, group, allowed))
    k = allowed.shape[1]
    size = k * bins * classes

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, group, allowed = sent.value
        hist = None
        for block in _standing(batches, nodes, group, matrices):
            if hist is None:
                hist, rows = np.zeros(len(group) * size), np.zeros(len(group), np.int64)
            for at, x, weight, y in block:
                if len(at):
                    _add_rows(hist, x, at, weight, y, allowed, bins, classes)
                    rows += np.bincount(at, minlength=len(rows))
        if hist is None:
            return
        # Most cells of a deep level are empty: (cell, weight) pairs, cut at the nodes.
        step = max(1, SENT_CELLS // size)
        for lo in range(0, len(group), step):
            part = hist[lo * size : (lo + step) * size]
            at = np.flatnonzero(part)
            node, cell = np.divmod(at, size)
            n, begin = np.unique(node, return_index=True)
            if len(n):
                ends = np.append(begin, len(at)).astype(np.int32)
                yield pa.record_batch({"node": pa.array(group[lo + n].astype(np.int32)), "rows": pa.array(rows[lo + n]), "cells": pa.ListArray.from_arrays(ends, pa.array(cell.astype(np.int32))),
                                       "weights": pa.ListArray.from_arrays(ends, pa.array(part[at]))})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, group, allowed = sent.value
        number = np.full(len(nodes.tree), -1, np.int64)
        number[group] = np.arange(len(group))
        place, hist, own = np.full(len(group), -1, np.int64), np.zeros((0, size)), np.zeros(0, np.int64)
        rows = np.zeros(len(group), np.int64)
        for b in batches:
            at = number[b.column(0).to_numpy()]
            fresh = np.unique(at[place[at] < 0])
            if len(fresh):
                place[fresh] = len(own) + np.arange(len(fresh))
                own = np.concatenate([own, fresh])
                if len(own) > len(hist):
                    hist = np.concatenate([hist, np.zeros((max(len(own) - len(hist), min(len(hist), 4096)), size))])
            np.add.at(rows, at, b.column(1).to_numpy())
            lens = np.diff(b.column(2).offsets.to_numpy())
            np.add.at(hist.ravel(), np.repeat(place[at], lens) * size + b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy())
        step = max(1, SENT_CELLS // size)
        for lo in range(0, len(own), step):
            same = own[lo : lo + step]
            f, c, g, left, total = _best_splits(hist[lo : lo + len(same)].reshape(-1, k, bins, classes), allowed[same], counts[nodes.tree[group[same]]])
            yield pa.record_batch({"node": pa.array(group[same].astype(np.int32)), "feature": pa.array(np.where(g > 0, f, -1).astype(np.int32)), "cut": pa.array(c.astype(np.int32)),
                                   "gain": pa.array(g), "rows": pa.array(rows[same].astype(float)), "below": pa.array(left.tolist(), pa.list_(pa.float64())), "total": pa.array(total.tolist(), pa.list_(pa.float64()))})

    parts = stored.mapInArrow(partial, "node int, rows long, cells array<int>, weights array<double>").repartition(spread_for(spark, 50 * len(group)), "node")
    # A node's partial histogram is as large as its cells, a row as wide as its trees: batches are bounded by bytes.
    with small_batches(spark):
        best = parts.mapInArrow(merged, "node int, feature int, cut int, gain double, rows double, below array<double>, total array<double>").toArrow()
    sent.destroy()
    return best


def _ends(spark: SparkSession, stored: DataFrame, nodes: Nodes, path: np.ndarray, group: np.ndarray, rows: np.ndarray, matrices: Callable, seed: int, widths: list[int], most: int,
          width: int, bins: int, classes: int, counts: np.ndarray, max_depth: int) -> pa.Table:
    """The answers for a group of nodes and all that lies below them: (tree, path) with the best split; ``rows`` is about how many each has."""
    # Nodes are dealt to parts of about equal rows; a part holds about LOCAL_BYTES of them.
    held = float(rows.sum()) * (16 + most)
    spread = int(min(len(group), max(2 * spread_for(spark, int(rows.sum())), math.ceil(held / LOCAL_BYTES))))
    part = np.empty(len(group), np.int32)
    part[np.argsort(-rows, kind="stable")] = np.arange(len(group)) % spread
    sent = spark.sparkContext.broadcast((nodes, group, part, path[group]))
    size = width * bins * classes
    kinds = (np.int32, np.int32, np.float64, np.uint8)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, group, part, _ = sent.value
        for block in _standing(batches, nodes, group, matrices):
            at, x, weight, y = (np.concatenate(z) for z in zip(*block))
            own = part[at]
            order = np.argsort(own, kind="stable")
            own = own[order]
            cut = np.flatnonzero(np.diff(own, prepend=-1))
            pieces = list(zip(cut.tolist(), [*cut[1:].tolist(), len(own)]))
            columns = [a[order].astype(kind) for a, kind in zip((at, y, weight, x), kinds)]
            yield pa.record_batch([pa.array(own[cut], pa.int32()), *(pa.array([c[lo:hi].tobytes() for lo, hi in pieces], pa.binary()) for c in columns)], names=["part", "at", "y", "w", "x"])

    def finish(rows: pa.Table) -> pa.Table:
        nodes, group, _, ways = sent.value
        at, y, w, x = (np.frombuffer(b"".join(rows[c].to_pylist()), kind) for c, kind in zip(("at", "y", "w", "x"), kinds))
        x = x.reshape(len(at), -1)
        own, at = np.unique(at, return_inverse=True)
        tree, way, depth = nodes.tree[group[own]], ways[own], nodes.depth[group[own]]
        out = []
        while len(tree):
            allowed = _subsets(seed, tree, way, widths, most, width)
            order = np.argsort(at, kind="stable")
            at, y, w, x = at[order], y[order], w[order], x[order]
            found, step = [], max(1, SENT_CELLS // size)
            for lo in range(0, len(tree), step):
                some, (a, b) = allowed[lo : lo + step], np.searchsorted(at, (lo, lo + step))
                hist = np.zeros(len(some) * size)
                _add_rows(hist, x[a:b], at[a:b] - lo, w[a:b], y[a:b], some, bins, classes)
                found.append(_best_splits(hist.reshape(-1, width, bins, classes), some, counts[tree[lo : lo + step]]))
            f, c, g, left, total = (np.concatenate(z) for z in zip(*found))
            f = np.where(g > 0, f, -1)
            out.append(pa.table({"tree": pa.array(tree, pa.int32()), "path": pa.array(way, pa.int64()), "feature": pa.array(f, pa.int32()), "cut": pa.array(c, pa.int32()), "gain": pa.array(g),
                                 "below": pa.array(left.tolist(), pa.list_(pa.float64())), "total": pa.array(total.tolist(), pa.list_(pa.float64()))}))
            # As in ``grow``: impure children above the last level are asked next, and only their rows go on.
            s = np.flatnonzero((f >= 0) & (depth < max_depth))
            child = np.stack([left[s], total[s] - left[s]], 1)
            asked = ((child > 0).sum(2) > 1) & (depth[s] + 1 < max_depth)[:, None]
            number = np.full((len(tree), 2), -1, np.int64)
            number[s] = np.where(asked, np.cumsum(asked.ravel()).reshape(-1, 2) - 1, -1)
            at = number[at, (x[np.arange(len(x)), f[at]] > c[at]).astype(np.int64)]
            keep = np.flatnonzero(at >= 0)
            at, y, w, x = at[keep], y[keep], w[keep], x[keep]
            asked = asked.ravel()
            tree, way, depth = np.repeat(tree[s], 2)[asked], (2 * way[s][:, None] + np.arange(2)).ravel()[asked], np.repeat(depth[s] + 1, 2)[asked]
        return pa.concat_tables(out)

    dealt = stored.mapInArrow(route, "part int, at binary, y binary, w binary, x binary").repartition(spread, "part")
    with small_batches(spark):
        best = dealt.groupBy("part").applyInArrow(finish, "tree int, path long, feature int, cut int, gain double, below array<double>, total array<double>").toArrow()
    sent.destroy()
    return best
