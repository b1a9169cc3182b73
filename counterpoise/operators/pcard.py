"""PCARD: an ensemble of decision trees over random discretisation + PCA views.

Each of ``trees`` members sees (a) every original feature discretised by
``cuts`` random cut points and (b) the first ``c_t`` principal components
(``c_t`` drawn per member in 1..D); a decision tree is fitted on the
concatenation and the members vote (majority; a tie predicts 0).

Spark-first choices:

* ONE PCA fit (k = D, ``pyspark.ml``) shared by all members; each
  member slices its leading components — the projection is computed once
  and persisted with the training rows;
* the cut points of all members come from ONE bounded top-k: rows ranked by
  a hash of ``(id, copy)``, ranks ``[t*cuts, (t+1)*cuts)`` give member t its
  cut rows (``members * cuts`` rows reach the driver — a parameter bound),
  all of them different rows;
* a bin index is the count of cuts below the value; the bins of all members and of the
  components are computed once per row and written, a byte each;
* the members are grown together, one job per level for all of them (``forest.grow``);
  for scoring, a test on a bin is a test on the value (bin <= k is x <= k-th cut), so all
  members and the vote are one column over one scan.
"""

from __future__ import annotations

import random
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, ID, LABEL, num_features
from counterpoise.functions.hashing import hash_uniform
from counterpoise.operators.forest import BLOCK_SCHEMA, ForestModel, _matrix, bin_matrix, block_of, feature_edges, grow, spread_for, write_blocks
from counterpoise.operators.pca import fit_pca

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PCA_COL = "_pca"


def cut_rows(df: DataFrame, members: int, cuts: int, seed: int, weight_col: str | None = None) -> DataFrame:
    """``(member, id, features)``: the ``members * cuts`` distinct rows that give the cut points.

    Every copy of a row draws a number from ``(id, copy)`` (a row of weight w draws w
    numbers), and the row stands with its smallest, so rows are drawn in proportion to
    their copies but no row is taken twice.  The draw has a step name of its own: it is
    independent of draws that resampled the rows with the same seed.
    """

    def draw(copy):
        return hash_uniform(F.concat(F.col(ID).cast("string"), F.lit(":"), copy.cast("string")), f"cuts-{seed}")

    if "copy_no" in df.columns:
        rows = df.select(ID, FEATURES, draw(F.col("copy_no")).alias("_u")).groupBy(ID).agg(F.min("_u").alias("_u"), F.any_value(FEATURES).alias(FEATURES))
    elif weight_col:
        each = F.transform(F.sequence(F.lit(1), F.col(weight_col).cast("int")), draw)
        rows = df.select(ID, FEATURES, F.array_min(each).alias("_u"))
    else:
        rows = df.select(ID, FEATURES, draw(F.lit(1)).alias("_u"))
    top = rows.orderBy("_u", ID).limit(members * cuts)
    # At most members * cuts rows from here on.
    rank = F.row_number().over(Window.orderBy("_u", ID)) - 1
    return top.select(F.floor(rank / cuts).cast("int").alias("member"), ID, FEATURES)


def draw_cuts(df: DataFrame, members: int, cuts: int, seed: int, d: int, weight_col: str | None = None) -> list[list[list[float]]]:
    """``cuts[t][j]``: ascending cut values of feature j for member t."""
    out = [[[] for _ in range(d)] for _ in range(members)]
    for row in cut_rows(df, members, cuts, seed, weight_col).collect():
        for j, v in enumerate(row[FEATURES]):
            out[row["member"]][j].append(float(v))
    return [[sorted(vals) for vals in m] for m in out]


def discretize(features: str, member_cuts: list[list[float]]) -> Column:
    """Bin index of every feature: ``#{c in cuts[j] : c < x_j}``.

    The cut table travels as ONE array literal (feature j owns the slice
    ``[j*w, (j+1)*w)``, padded with +inf, which no value exceeds), and one JVM
    higher-order expression counts the cuts below each value.  A single
    literal keeps the plan small however many features and members there are.
    """
    width = max([len(c) for c in member_cuts] + [1])
    flat = np.full(len(member_cuts) * width, np.inf)
    for j, cuts in enumerate(member_cuts):
        flat[j * width : j * width + len(cuts)] = sorted(cuts)
    table = F.lit(flat)
    return F.transform(
        F.col(features),
        lambda x, j: F.size(F.filter(F.slice(table, j * width + 1, width), lambda c: c < x)).cast("double"),
    )


def majority_vote(votes: list[Column]) -> Column:
    """1.0 when more than half of the 0/1 member predictions are 1; a tie gives 0.0."""
    total = reduce(lambda a, b: a + b, votes)
    return F.when(total * 2.0 > F.lit(float(len(votes))), F.lit(1.0)).otherwise(F.lit(0.0))


def member_components(seed: int, t: int, d: int) -> int:
    return random.Random(seed * 1_000_003 + t).randint(1, d)


@dataclass
class PCARDModel:
    pca: object
    cuts: list
    components: list
    forest: ForestModel  # its nodes test raw values: features first, then components
    features_col: str = FEATURES
    prediction_col: str = "prediction"

    def wide(self) -> Column:
        """Features and components as one array: what the members' nodes test."""
        return F.concat(F.col(self.features_col), self.pca.project(self.features_col))

    def predict_col(self) -> Column:
        return self.forest.predict_col(self.wide())

    def transform(self, df: DataFrame) -> DataFrame:
        """The majority of the members' votes, over one scan."""
        return df.withColumn(self.prediction_col, self.predict_col())


def fit_pcard(
    df: DataFrame,
    trees: int = 50,
    cuts: int = 10,
    max_depth: int = 10,
    max_bins: int = 32,
    seed: int = 1,
    weight_col: str | None = None,
    partitions: int | None = None,
) -> PCARDModel:
    spark, d = df.sparkSession, num_features(df)
    pca = fit_pca(df, k=d, weight_col=weight_col)
    cut_table = draw_cuts(df, trees, cuts, seed, d, weight_col)
    comps = [member_components(seed, t, d) for t in range(trees)]
    projected = df.withColumn(PCA_COL, pca.project())
    n = df.count()
    pc_edges = feature_edges(projected, max_bins, seed, weight_col, PCA_COL, n)
    steps = [[np.array(c) for c in own] for own in cut_table]
    # Bins stand for themselves: k cuts leave thresholds 0.5 .. k - 0.5.  Components beyond a member's share have none.
    edges = [[np.arange(len(c)) + 0.5 for c in own] + [e if j < comps[t] else np.zeros(0) for j, e in enumerate(pc_edges)] for t, own in enumerate(cut_table)]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                x = _matrix(part.column(2))
                all_ = np.concatenate([bin_matrix(x, own) for own in steps] + [bin_matrix(_matrix(part.column(3)), pc_edges)], 1)
                # Copies of a row are alike and stand together: one row with their weights added up.
                y, w = part.column(0).to_numpy(), part.column(1).to_numpy()
                first = np.flatnonzero(np.concatenate([[True], (np.diff(y) != 0) | (x[1:] != x[:-1]).any(1)]))
                yield block_of(y[first], np.add.reduceat(w, first), all_[first], np.ones((len(first), trees), np.uint8))

    spread = partitions or spread_for(spark, n)
    rows = projected.select(F.xxhash64(ID).alias("_i"), F.col(LABEL).cast("int").alias("y"), (F.col(weight_col) if weight_col else F.lit(1.0)).cast("double").alias("w"), FEATURES, PCA_COL)
    dealt = rows.repartition(spread, "_i").drop("_i").sortWithinPartitions(FEATURES, "y")
    stored = write_blocks(dealt.mapInArrow(binned, BLOCK_SCHEMA), "pcard-rows")

    def matrices(m: np.ndarray) -> Callable:
        return lambda t: np.concatenate([m[:, t * d : (t + 1) * d], m[:, trees * d :]], 1)

    forest = grow(stored, trees, edges, matrices, max_depth, 2 * d, seed, rows=n)
    nodes = forest.nodes
    # A test on a member's bin becomes the test on the value that it stands for.
    on_bin = np.flatnonzero((nodes.feature >= 0) & (nodes.feature < d))
    raw = nodes.threshold.copy()
    raw[on_bin] = [cut_table[t][f][c] for t, f, c in zip(nodes.tree[on_bin].tolist(), nodes.feature[on_bin].tolist(), nodes.cut[on_bin].tolist())]
    return PCARDModel(pca, cut_table, comps, ForestModel(replace(nodes, threshold=raw), trees, votes=True))
