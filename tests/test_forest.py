"""The histogram forest against a plain CART on the same bags, its layout independence, trees as relations."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF01, labelled_rows
from counterpoise.operators import balance, forest
from counterpoise.operators.pcard import fit_pcard
from counterpoise.operators.tree_relation import ml_node_table, score_by_join
from counterpoise.operators.trees import fit_dt, fit_rf
from counterpoise.sources.tables import lp_emb


def _bag(key, tree, seed):
    h = hashlib.md5(f"{seed}:bag-{tree // 4}:{key}".encode()).hexdigest()
    u = int(h[8 * (tree % 4) : 8 * (tree % 4) + 8], 16) / 2**32
    total, k = math.exp(-1), 0
    while total <= u:
        k += 1
        total += math.exp(-1) / math.factorial(k)
    return k


def _gini(w, y):
    n = w.sum()
    return n - (w[y == 0].sum() ** 2 + w[y == 1].sum() ** 2) / n if n else 0.0


def _cart(x, y, w, depth, edges):
    """Best split over all thresholds by plain loops; (feature, threshold, left, right) or the class counts."""
    counts = (float(w[y == 0].sum()), float(w[y == 1].sum()))
    best = (1e-9 * max(w.sum(), 1), None)
    if depth and min(counts) > 0:
        for f in range(x.shape[1]):
            for t in edges[f]:
                left = x[:, f] <= t
                if w[left].sum() > 0 and w[~left].sum() > 0:
                    g = _gini(w, y) - _gini(w[left], y[left]) - _gini(w[~left], y[~left])
                    if g > best[0]:
                        best = (g, (f, t))
    if best[1] is None:
        return counts
    f, t = best[1]
    left = x[:, f] <= t
    return (f, t, _cart(x[left], y[left], w[left], depth - 1, edges), _cart(x[~left], y[~left], w[~left], depth - 1, edges))


def _tree(model, node):
    m = model.nodes
    if m.feature[node] < 0:
        return tuple(m.counts[node].tolist())
    return (int(m.feature[node]), float(m.threshold[node]), _tree(model, m.left[node]), _tree(model, m.left[node] + 1))


def _frame(spark, n=300):
    g = np.random.default_rng(5)
    x = np.round(g.normal(size=(n, 3)), 1)  # many ties
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + g.normal(size=n) * 0.3) > 0).astype(float)
    w = g.integers(1, 4, n).astype(float)
    rows = [(i, float(y[i]), x[i].tolist(), float(w[i])) for i in range(n)]
    return x, y, w, spark.createDataFrame(rows, "id long, label double, features array<double>, weight double")


@pytest.mark.parametrize("weight", [None, "weight"])
def test_trees_are_those_of_a_plain_cart(spark, weight):
    x, y, w, df = _frame(spark)
    model = forest.fit_forest(df, num_trees=6, max_depth=4, max_bins=256, feature_subset="all", weight_col=weight, seed=3)
    edges = forest.feature_edges(df, 256, 3, weight)
    assert all(np.array_equal(e, (np.unique(x[:, j])[:-1] + np.unique(x[:, j])[1:]) / 2) for j, e in enumerate(edges))
    for t in range(6):
        bag = np.array([_bag(i, t, 3) for i in range(len(y))]) * (w if weight else 1)
        taken = bag > 0
        assert _tree(model, t) == _cart(x[taken], y[taken].astype(int), bag[taken], 4, edges)


def test_bags_of_copies_differ(spark):
    df = spark.createDataFrame([(1, k, 0.0, [1.0]) for k in range(40)], "id long, copy_no int, label double, features array<double>")
    got = {(r.copy_no, r.tree): r.bag for r in forest.bag_weights(df, 6, 9).collect()}
    assert got == {(k, t): _bag(f"1#{k}", t, 9) for k in range(40) for t in range(6)} and len(set(got.values())) > 2


def test_same_forest_on_any_layout(spark, monkeypatch):
    df = lp_emb(spark, SF01)
    w = balance.ros(df, 1.0, 1, as_weights=True)
    made = []
    for n in (1, 8, 64):
        m = forest.fit_forest(w.repartition(n), num_trees=5, max_depth=5, weight_col="weight", seed=3, partitions=n)
        made.append(m.nodes)
    monkeypatch.setattr(forest, "MOST_CELLS", 20_000)  # many passes a level
    made.append(forest.fit_forest(w, num_trees=5, max_depth=5, weight_col="weight", seed=3).nodes)
    for other in made[1:]:
        for name in ("tree", "depth", "feature", "threshold", "left", "counts", "gain"):
            assert np.array_equal(getattr(made[0], name), getattr(other, name), equal_nan=True), name
    assert len(set(made[0].feature[made[0].feature >= 0].tolist())) > 5


def _same_nodes(a, b):
    return all(np.array_equal(getattr(a, name), getattr(b, name), equal_nan=True) for name in ("tree", "depth", "feature", "cut", "threshold", "left", "counts", "gain"))


def test_small_nodes_are_grown_to_their_end_in_one_pass(spark, monkeypatch):
    _, _, _, df = _frame(spark, 600)
    asked = []
    level = forest._level
    monkeypatch.setattr(forest, "_level", lambda spark, stored, nodes, group, *rest: asked.append(len(group)) or level(spark, stored, nodes, group, *rest))
    fits = {"forest": lambda: forest.fit_forest(df, num_trees=5, max_depth=6, weight_col="weight", seed=3).nodes,
            "pcard": lambda: fit_pcard(df, trees=5, cuts=6, max_depth=5, weight_col="weight").forest.nodes}
    for name, fit in fits.items():
        made = fit()
        assert not asked, name  # no pass by levels for frames this small
        for rows in (0, 150):
            monkeypatch.setattr(forest, "LOCAL_ROWS", rows)
            assert _same_nodes(made, fit()) and asked, (name, rows)
            assert rows == 0 or sum(asked) < len(made.tree), name
            asked.clear()
        monkeypatch.undo()
        monkeypatch.setattr(forest, "_level", lambda spark, stored, nodes, group, *rest: asked.append(len(group)) or level(spark, stored, nodes, group, *rest))


def test_copies_are_stored_as_one_row(spark, monkeypatch):
    g = np.random.default_rng(3)
    y, x = np.repeat([0, 1, 0], 400), np.repeat(np.array([[1, 2], [1, 2], [7, 0]], np.uint8), 400, 0)
    bags = g.integers(0, 3, (1200, 4)).astype(np.uint8)
    own_y, own_w, own_x, own = forest.merge_alike(y, np.ones(1200), x, bags)
    assert len(own_y) < 12
    for k in range(3):
        here = (own_y == y[400 * k]) & (own_x == x[400 * k]).all(1)
        assert own[here].sum(0).tolist() == bags[400 * k : 400 * k + 400].sum(0).tolist() and own.max() > 100 and (own_w == 1).all()
    stored = []
    grow = forest.grow
    monkeypatch.setattr(forest, "grow", lambda rows, *rest: stored.append(sum(len(b[0]) for b in forest._blocks(rows.toArrow().to_batches()))) or grow(rows, *rest))
    df = spark.createDataFrame([(i, c, float(i % 2), [float(i), 1.0]) for i in range(50) for c in range(30)], "id long, copy_no int, label double, features array<double>")
    forest.fit_forest(df.repartition(7), num_trees=3, max_depth=2, partitions=2)
    assert stored[0] <= 50


def test_depth_zero_pure_and_constant_frames(spark):
    df = labelled_rows(spark, [(i, i % 2, [1.0, 2.0]) for i in range(20)])
    m = forest.fit_forest(df, num_trees=3, max_depth=5)
    assert (m.nodes.feature == -1).all() and m.transform(df).where("prediction NOT IN (0, 1)").count() == 0
    pure = labelled_rows(spark, [(i, 1, [float(i)]) for i in range(20)])
    assert forest.fit_forest(pure, num_trees=2).transform(pure).where("prediction <> 1").count() == 0
    with pytest.raises(ValueError):
        forest.fit_forest(df.limit(0), num_trees=1)
    many = labelled_rows(spark, [(i, i % 2, [float(i)]) for i in range(400)])
    edges = forest.feature_edges(many, max_bins=10)
    assert len(edges[0]) == 9 and np.all(np.diff(edges[0]) > 0)


def test_node_tables_score_like_their_models(spark):
    df = lp_emb(spark, SF01).where("id < 600").cache()
    models = {"dt": fit_dt(df, max_depth=6), "ml_rf": fit_rf(df, num_trees=4, max_depth=4, seed=2)}
    for model in models.values():
        nodes = ml_node_table(spark, model).cache()
        walked = {r.id: r.prediction for r in score_by_join(df, nodes).collect()}
        assert walked == {r.id: r.prediction for r in model.transform(df).select("id", "prediction").collect()}
        assert nodes.where("feature < 0").groupBy("tree").agg(F.sum("n")).count() == nodes.where("depth = 0").count()
    pcard = fit_pcard(df, trees=7, cuts=5, max_depth=4)
    walked = {r.id: r.prediction for r in score_by_join(df, pcard.forest.node_table(spark).cache(), True, features=pcard.wide()).collect()}
    assert walked == {r.id: r.prediction for r in pcard.transform(df).select("id", "prediction").collect()}


def test_pcard_bins_are_the_members_discretisation(spark):
    """A member's tests on raw values are its tests on bins: the first cuts are ordered thresholds of its cut rows."""
    df = lp_emb(spark, SF01).where("id < 300").cache()
    m = fit_pcard(df, trees=4, cuts=5, max_depth=3)
    n = m.forest.nodes
    for i in np.flatnonzero((n.feature >= 0) & (n.feature < 64)):
        assert n.threshold[i] in m.cuts[n.tree[i]][n.feature[i]]
    used = n.feature[n.feature >= 64] - 64
    assert all(f < m.components[t] for t, f in zip(n.tree[n.feature >= 64], used))


def test_bags_of_a_task_are_those_of_the_column(spark):
    keys = [None, "", "7", "1#3", "é"] + [str(k) for k in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "id string")
    asked = df.select("id", forest.bag_counts(F.col("id"), 7, 3).alias("bag")).collect()
    got = forest.draw_bags([None if r.id is None else r.id.encode() for r in asked], 7, 3)
    assert got.tolist() == [r.bag for r in asked]


def test_a_fit_computes_its_frame_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(v):
        seen.add(1)
        return v

    df = spark.createDataFrame([(i, float(i % 2), float(i)) for i in range(300)], "id long, label double, v double").repartition(3)
    df = df.select("id", "label", F.array(F.udf(look, "double")("v")).alias("features", metadata={"num_features": 1}))
    forest.fit_forest(df, num_trees=2, max_depth=2)
    assert seen.value == 300


def test_rows_are_added_without_a_second_histogram():
    import tracemalloc

    hist, n = np.zeros(4000 * 500 * 2), 1000
    g = np.random.default_rng(1)
    x, node, y, w = g.integers(0, 100, (n, 7)).astype(np.uint8), g.integers(0, 4000, n), g.integers(0, 2, n), g.integers(1, 4, n).astype(float)
    allowed = np.sort(np.array([g.permutation(7)[:5] for _ in range(4000)]), 1)
    tracemalloc.start()
    forest._add_rows(hist, x, node, w, y, allowed, 100, 2)
    assert tracemalloc.get_traced_memory()[1] < 1_000_000
    tracemalloc.stop()
    want = np.zeros((4000, 5, 100, 2))
    for i in range(n):
        for j in range(5):
            want[node[i], j, x[i, allowed[node[i], j]], y[i]] += w[i]
    assert np.array_equal(hist, want.ravel())


def test_batches_are_bounded_by_bytes(spark):
    from counterpoise.session import small_batches

    df = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("t"))

    def sizes(batches):
        for b in batches:
            yield pa.record_batch({"n": pa.array([b.num_rows], pa.int64())})

    with small_batches(spark, 1 << 20):
        assert max(r.n for r in df.mapInArrow(sizes, "n long").collect()) < 1500
    assert max(r.n for r in df.mapInArrow(sizes, "n long").collect()) > 3000


def test_joined_scoring_spreads_a_frame_in_one_file(spark):
    df = labelled_rows(spark, [(i, i % 2, [float(i % 7), float(i)]) for i in range(9000)]).coalesce(1)
    nodes = forest.fit_forest(df, num_trees=3, max_depth=3).node_table(spark)
    walked = score_by_join(df, nodes).select("id", F.spark_partition_id().alias("p"))
    assert walked.select("p").distinct().count() > 1 and walked.count() == 9000
