"""HME filter, FCNN kernel and selection, PCARD pieces."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01, labelled_rows
from counterpoise.operators import balance
from counterpoise.operators.evaluate import evaluate
from counterpoise.operators.neighbours import fcnn_kernel, fcnn_seeds, fcnn_select
from counterpoise.operators.noise import assign_folds, hme_filter, hme_report, hme_scored
from counterpoise.operators.pcard import discretize, draw_cuts, fit_pcard, majority_vote
from counterpoise.sources.tables import lp_emb
from test_models import separable

FLIPS = (3, 12, 25, 175, 190)


def test_hme_removes_far_label_noise(spark):
    df = separable(spark, 200, flips=FLIPS)
    kept = hme_filter(df, num_trees=20, k=4, max_depth=5, seed=7)
    kept_ids = {r.id for r in kept.select("id").collect()}
    assert not (kept_ids & set(FLIPS))
    assert kept_ids <= set(range(200))
    # rows far from the edge (and not flipped) are kept
    far = {i for i in range(200) if abs(i - 99.5) > 20 and i not in FLIPS}
    assert len(far - kept_ids) <= 4


def test_hme_invariants(spark):
    df = separable(spark, 120, flips=(2, 100))
    scored, folded = hme_scored(df, num_trees=5, k=4, max_depth=3, seed=1)
    rep = hme_report(scored).agg(F.sum("kept"), F.sum("removed")).first()
    assert rep[0] + rep[1] == 120
    assert scored.groupBy("id").count().where("count != 1").count() == 0
    sizes = {r.fold: r["count"] for r in assign_folds(df, 4, 1).groupBy("fold").count().collect()}
    got = {r.fold: r["count"] for r in scored.groupBy("fold").count().collect()}
    assert sizes == got
    folded.unpersist()


def test_hme_after_ros_keeps_copies_in_one_fold(spark):
    r = balance.ros(separable(spark, 60), 1.0, seed=2)
    f = assign_folds(r, 4, 5)
    assert f.groupBy("id").agg(F.countDistinct("fold").alias("k")).where("k > 1").count() == 0


def _brute_fcnn(x, y, k):
    n = len(y)

    def dist(a, b):
        return float(((x[a] - x[b]) ** 2).sum())

    delta = set()
    for c in sorted(set(y)):
        members = [i for i in range(n) if y[i] == c]
        cen = x[members].mean(0)
        delta.add(min(members, key=lambda i: (float(((x[i] - cen) ** 2).sum()), i)))
    s = []
    while delta:
        s = s + sorted(delta)
        rep = {}
        for q in range(n):
            if q in s:
                continue
            nn = sorted(s, key=lambda p: (dist(q, p), p))[:k]
            ones = sum(y[p] == 1 for p in nn)
            zeros = len(nn) - ones
            vote = 1.0 if ones > zeros else 0.0 if zeros > ones else y[nn[0]]
            if vote != y[q]:
                p = nn[0]
                if p not in rep or (dist(q, p), q) < (dist(rep[p], p), rep[p]):
                    rep[p] = q
        delta = set(rep.values())
    return sorted(s)


@pytest.mark.parametrize("k", [1, 3])
@pytest.mark.parametrize("ints", [False, True])
def test_fcnn_kernel_matches_brute_force(k, ints):
    rng = np.random.default_rng(k + 10 * ints)
    x = rng.integers(0, 4, (70, 2)).astype(float) if ints else rng.normal(size=(70, 3))
    y = (rng.random(70) < 0.35).astype(float)
    assert list(fcnn_kernel(x, y, k)) == _brute_fcnn(x, y, k)


def test_fcnn_two_clusters_k1_consistent():
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(-1, 1, (150, 2)), rng.normal(1, 1, (150, 2))]
    y = np.r_[np.zeros(150), np.ones(150)]
    s = fcnn_kernel(x, y, 1)
    assert set(y[s]) == {0.0, 1.0}
    d = ((x[:, None, :] - x[s][None]) ** 2).sum(2)
    assert (y[s][d.argmin(1)] == y).all()


def test_fcnn_select_invariants_and_partition_free(spark):
    df = lp_emb(spark, SF01).cache()
    a = fcnn_select(df.repartition(2), k=3, max_rows=200, seed=5)
    b = fcnn_select(df.repartition(7), k=3, max_rows=200, seed=5)
    ids_a = {r.id for r in a.select("id").collect()}
    assert ids_a == {r.id for r in b.select("id").collect()}
    assert ids_a <= {r.id for r in df.select("id").collect()}
    per_bucket = a.groupBy("bucket").agg(F.countDistinct("label").alias("c")).collect()
    assert all(r.c == 2 for r in per_bucket)
    # the DataFrame form of the seeds picks rows the kernel selected
    seeds = {r.id for r in fcnn_seeds(df, 3, seed=5).collect()}
    assert seeds <= ids_a and len(seeds) == 6


def test_discretize_counts_cuts_below(spark):
    df = labelled_rows(spark, [(1, 0, [0.5, 10.0]), (2, 1, [2.0, -1.0])])
    out = {r.id: r.b for r in df.select("id", discretize("features", [[0.0, 1.0, 2.0], [0.0]]).alias("b")).collect()}
    assert out == {1: [1.0, 1.0], 2: [2.0, 0.0]}


def test_draw_cuts_bounded_and_deterministic(spark):
    df = lp_emb(spark, SF01)
    a = draw_cuts(df.repartition(3), 4, 5, 1, 64)
    b = draw_cuts(df.repartition(5), 4, 5, 1, 64)
    assert a == b and len(a) == 4 and all(len(c) == 5 for c in a[0])


def test_majority_vote(spark):
    df = spark.createDataFrame([(0.0, 1.0, 1.0), (0.0, 1.0, 0.0)], "a double, b double, c double")
    r = df.select(majority_vote([F.col("a"), F.col("b"), F.col("c")]).alias("v3"),
                  majority_vote([F.col("a"), F.col("b")]).alias("v2")).collect()
    assert [(x.v3, x.v2) for x in r] == [(1.0, 0.0), (0.0, 0.0)]


def test_pcard_separable(spark):
    df = labelled_rows(spark, [(i, float(i >= 50), [i / 10.0, (i % 7) / 7.0]) for i in range(100)])
    m = fit_pcard(df, trees=5, cuts=10, max_depth=4, seed=3)
    assert evaluate(m.transform(df)).first().accuracy >= 0.95


def test_hme_same_on_2_and_7_partitions(spark):
    df = separable(spark, 160, flips=(4, 150)).cache()
    a = hme_filter(df.repartition(2), num_trees=5, k=4, max_depth=4, seed=3, partitions=4)
    b = hme_filter(df.repartition(7), num_trees=5, k=4, max_depth=4, seed=3, partitions=4)
    assert {r.id for r in a.collect()} == {r.id for r in b.collect()}


def test_pcard_same_on_2_and_7_partitions(spark):
    df = lp_emb(spark, SF01).cache()
    a = fit_pcard(df.repartition(2), trees=2, cuts=5, max_depth=3, seed=4).transform(df).select("id", "prediction")
    b = fit_pcard(df.repartition(7), trees=2, cuts=5, max_depth=3, seed=4).transform(df).select("id", "prediction")
    assert a.exceptAll(b).count() == 0


def test_cut_rows_are_distinct_after_heavy_oversampling(spark):
    rows = [(i, 0.0, [float(i)]) for i in range(20000)] + [(20000 + i, 1.0, [30000.0 + i]) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, label double, features array<double>")
    cuts = draw_cuts(balance.ros(df, 1.0, 1), 50, 10, 1, 1)
    assert min(len(set(m[0])) for m in cuts) >= 9


def test_cuts_and_folds_of_weights_equal_copies(spark):
    df = lp_emb(spark, SF01)
    copies, weights = balance.ros(df, 1.0, 3), balance.ros(df, 1.0, 3, as_weights=True)
    assert draw_cuts(copies, 4, 5, 2, 64) == draw_cuts(weights, 4, 5, 2, 64, "weight")
    a = assign_folds(copies, 4, 9).select("id", "fold").distinct()
    assert a.exceptAll(assign_folds(weights, 4, 9).select("id", "fold")).count() == 0


def test_cut_rows_do_not_follow_the_undersampling_draw(spark):
    rows = [(i, float(i % 20 == 0), [float(i)]) for i in range(8000)]
    df = balance.rus(spark.createDataFrame(rows, "id long, label double, features array<double>"), 1)
    from counterpoise.operators.pcard import cut_rows

    shares = [cut_rows(df, 20, 10, seed).join(df, "id").agg(F.avg("label")).first()[0] for seed in (1, 2, 3, 4)]
    share = sum(shares) / len(shares)
    whole = df.agg(F.avg("label")).first()[0]
    assert abs(share - whole) < 0.08


def test_condensation_refuses_weights(spark):
    with pytest.raises(ValueError):
        fcnn_select(balance.ros(lp_emb(spark, SF01), 1.0, 1, as_weights=True))


def test_hme_does_not_depend_on_shuffle_partitions(spark):
    df = separable(spark, 160, flips=(4, 150)).cache()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("8", "32"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append({r.id for r in hme_filter(df, num_trees=5, k=4, max_depth=4, seed=3).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]


def test_pcard_scoring_equals_member_models(spark):
    """The vote over raw values is the vote of the members over their discretised features."""
    from counterpoise.operators.pcard import discretize

    df = lp_emb(spark, SF01)
    m = fit_pcard(df, trees=3, cuts=6, max_depth=4, seed=2)
    n = m.forest.nodes
    seen = df.select("id", m.pca.project().alias("pc"), *[discretize("features", m.cuts[t]).alias(f"b{t}") for t in range(3)]).collect()
    want = {}
    for r in seen:
        votes = 0
        for t in range(3):
            at = t
            while n.feature[at] >= 0:
                f = n.feature[at]
                right = r[f"b{t}"][f] > n.cut[at] if f < 64 else r.pc[f - 64] > n.threshold[at]
                at = n.left[at] + right
            votes += int(n.counts[at].argmax())
        want[r.id] = float(2 * votes > 3)
    assert {r.id: r.prediction for r in m.transform(df).collect()} == want
