"""Exact neighbours, kNN votes and the global condensation against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01, labelled_rows
from counterpoise.operators.evaluate import class_rates, confusion_dense
from counterpoise.operators.knn import knn_predict, vote_rows
from counterpoise.operators.neighbours import fcnn_global, fcnn_kernel, fcnn_select
from counterpoise.operators.topk import search, topk_neighbours
from counterpoise.sources.sinks import write_metrics, write_reports
from counterpoise.sources.tables import lp_emb


def _clusters(n=900, hot=300):
    """Five far clusters, small-integer grids (many exact ties) and one vector held by a third of the rows."""
    g = np.random.default_rng(1)
    x = g.integers(-3, 4, (n, 4)).astype(float) + 200 * (np.arange(n) % 5)[:, None]
    x[:hot] = [1.0, 2.0, 3.0, 4.0]
    return x, (np.arange(n) % 3).astype(float)


def _brute(q, p, k, same):
    d = ((q[:, None, :] - p[None, :, :]) ** 2).sum(2)
    if same:
        np.fill_diagonal(d, np.inf)
    return d, np.argsort(d, axis=1, kind="stable")[:, :k]


@pytest.mark.parametrize("k, block, pivots", [(1, 20, 9), (4, 64, 5), (7, 1000, None)])
def test_topk_is_exact_with_a_hot_vector_and_ties(spark, k, block, pivots):
    x, y = _clusters()
    df = labelled_rows(spark, [(i, y[i], x[i]) for i in range(len(x))]).repartition(5)
    stats: dict = {}
    got = topk_neighbours(df, k, block=block, query_block=2 * block, pivots=pivots, stats=stats).collect()
    d, order = _brute(x, x, k, True)
    assert {(r.id, r.rank): (r.neighbour, r.distance, r.label) for r in got} == {
        (i, j + 1): (order[i, j], float(np.sqrt(d[i, order[i, j]])), y[order[i, j]]) for i in range(len(x)) for j in range(k)}
    if block < 100:
        assert stats["searched"] < 0.7 * stats["all"]  # far clusters are skipped
        assert stats["largest"] <= 3 * block  # the hot vector's cell is cut


def test_topk_string_ids_short_lists_nulls_and_empty(spark):
    df = spark.createDataFrame([("b", [0.0]), ("a", [0.0]), ("c", [3.0]), ("n", None)], "id string, features array<double>")
    got = {(r.id, r.rank): (r.neighbour, r.distance) for r in topk_neighbours(df, 5).collect()}
    assert got == {("a", 1): ("b", 0.0), ("a", 2): ("c", 3.0), ("b", 1): ("a", 0.0), ("b", 2): ("c", 3.0), ("c", 1): ("a", 3.0), ("c", 2): ("b", 3.0)}
    assert topk_neighbours(df.limit(0), 2).count() == 0 and topk_neighbours(df.limit(0), 2, df).count() == 0
    assert topk_neighbours(df, 2, df.limit(0)).count() == 0


def test_long_block_lists_are_split_and_merged(spark):
    from counterpoise.operators.topk import pack

    x, y = _clusters(200, 40)
    rows = spark.createDataFrame([(i, float(y[i]), x[i].tolist(), i % 2, i % 17) for i in range(200)], "id long, label double, x array<double>, qb int, block int")
    q, p = pack(rows, "qb").cache(), pack(rows, "block").cache()
    pairs = q.select("qb").crossJoin(p.select("block"))
    one, many = (sorted(search(q, p, pairs, 3, True, n).collect()) for n in (1000, 2))
    assert one == many and len(one) == 600


def test_knn_votes_and_ties(spark):
    x, y = _clusters(300, 60)
    df = labelled_rows(spark, [(i, y[i], x[i]) for i in range(300)])
    train, test = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    got = {r.id: r for r in knn_predict(train, test, 4, block=32, query_block=32).collect()}
    tr, te = np.flatnonzero(np.arange(300) % 4), np.flatnonzero(np.arange(300) % 4 == 0)
    _, order = _brute(x[te], x[tr], 4, False)
    ties = 0
    for i, o in zip(te, order):
        n = np.bincount(y[tr[o]].astype(int), minlength=3)
        ties += (n == n.max()).sum() > 1
        assert (got[i].prediction, got[i].support, got[i].total, got[i].tied) == (n.argmax(), n.max(), 4, (n == n.max()).sum() > 1)
    assert ties > 5 and len(got) == len(te)
    near = labelled_rows(spark, [(1, 0, [0.0]), (2, 1, [10.0]), (3, 1, [11.0])])
    asked = labelled_rows(spark, [(9, 0, [1.0]), (8, 0, [0.0])])
    assert {r.id: r.prediction for r in knn_predict(near, asked, 3).collect()} == {9: 1.0, 8: 1.0}
    assert {r.id: r.prediction for r in knn_predict(near, asked, 3, weighted=True).collect()} == {9: 0.0, 8: 0.0}


def test_vote_rows_classes_weights_and_abstentions(spark):
    rows = [(1, "b", 1.0), (1, "a", 1.0), (1, None, 9.0), (2, "c", 0.5), (2, "c", 0.6), (2, "a", 1.0), (3, None, 1.0), (4, "x", 2.0), (4, "y", None)]
    df = spark.createDataFrame(rows, "id long, class string, w double")
    plain = {r.id: tuple(r)[1:] for r in vote_rows(df).collect()}
    assert plain == {1: ("a", 1.0, 2.0, True), 2: ("c", 2.0, 3.0, False), 3: (None, None, 0.0, False), 4: ("x", 1.0, 2.0, True)}
    heavy = {r.id: tuple(r)[1:] for r in vote_rows(df, weight_col="w").collect()}
    assert heavy[2] == ("c", 1.1, 2.1, False) and heavy[4] == ("x", 2.0, 2.0, False) and heavy[3][0] is None


@pytest.mark.parametrize("k", [1, 3])
def test_global_condensation_is_the_rule_on_the_whole_frame(spark, k):
    df = lp_emb(spark, SF01).where("id < 160").cache()
    rows = df.orderBy("id").collect()
    x, y = np.array([r.features for r in rows]), np.array([r.label for r in rows])
    log: list = []
    got = {r.id for r in fcnn_global(df, k=k, block=37, log=log).collect()}
    assert got == {rows[i].id for i in fcnn_kernel(x, y, k)} == {r.id for r in fcnn_select(df, k=k, n_buckets=1).collect()}
    assert log[-1] == 0 and sum(log) == len(got) and len(log) > 2


def test_global_condensation_of_three_classes_and_copies(spark):
    g = np.random.default_rng(2)
    rows = [(i, float(i % 3), (g.normal(size=2) + 8 * np.array([i % 3, i % 2])).tolist(), 1) for i in range(90)] + [(5, 2.0, [99.0, 99.0], 2)]
    df = spark.createDataFrame(rows, "id long, label double, features array<double>, copy_no int")
    out = fcnn_global(df, k=1).collect()
    x, y = np.array([r.features for r in out]), np.array([r.label for r in out])
    for _, label, v, _ in rows:
        assert label in y[((x - v) ** 2).sum(1) == ((x - v) ** 2).sum(1).min()]
    assert set(y) == {0.0, 1.0, 2.0} and len(out) < 90
    assert fcnn_global(df.limit(0)).count() == 0


def test_matrix_and_rates_of_three_classes(spark):
    rows = [("a", "a")] * 3 + [("a", "b"), ("b", "b"), ("b", None), (None, "a"), ("z", "a"), ("b", "z")]
    df = spark.createDataFrame(rows, "label string, prediction string")
    cells = {(r.label, r.prediction): r.n for r in confusion_dense(df, ["a", "b", "c"]).collect()}
    assert cells == {(x, y): sum(r == (x, y) for r in rows) for x in "abc" for y in "abc"}
    rates = {r["class"]: r for r in class_rates(df, ["a", "b", "c"]).collect()}
    assert tuple(rates["a"])[1:6] == (3, 2, 1, 3, 9) and rates["a"].recall == 0.75 and rates["a"].precision == 0.6
    assert tuple(rates["b"])[1:6] == (1, 1, 2, 5, 9) and rates["c"].recall is None and rates["c"].specificity == 1.0
    numbers = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0), (2.0, 0.0)], "label double, prediction double")
    assert {(r.label, r.prediction): r.n for r in confusion_dense(numbers, [0.0, 1.0, 2.0]).where("n > 0").collect()} == {(0.0, 1.0): 1, (2.0, 2.0): 1, (2.0, 0.0): 1}


def test_sinks_keep_other_preps(spark, tmp_path):
    def metrics(prep, n, model="dt"):
        return spark.createDataFrame([(prep, model, n, 0, 0, n, 0, 2 * n, 1.0, 1.0, 1.0, 1.0)],
                                     "prep string, model string, tn long, fp long, fn long, tp long, n_null long, n long, accuracy double, tnr double, tpr double, product double")

    table, reports = str(tmp_path / "metrics"), str(tmp_path / "reports")
    for prep, n in (("ros", 1), ("rus", 2), ("ros", 3)):
        write_metrics(metrics(prep, n), table)
        write_reports(metrics(prep, n), reports)
    assert {(r.prep, r.tn) for r in spark.read.parquet(table).collect()} == {("ros", 3), ("rus", 2)}
    texts = spark.read.text(reports)
    assert texts.count() == 2 * texts.where("prep = 'rus'").count() > 0
    write_metrics(metrics("hme", 4).drop("prep"), str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 1


def test_a_search_moves_rows_not_pairs_of_blocks():
    """Queries go to ``slots`` tasks each and points to ``groups``: neither grows with the rows while a group fits a task."""
    from counterpoise.operators.topk import layout

    row, moved = 64 * 8, {}
    for n in (100_000, 200_000, 1_000_000):
        groups, slots = layout(24, -(-n // 2048), n * row, -(-n // 512))
        assert n * row / groups < 130 << 20 and groups * slots >= 24
        moved[n] = (groups + slots) * n * row
    assert moved[200_000] == 2 * moved[100_000] and moved[1_000_000] == 10 * moved[100_000]
    assert layout(24, 100, 1 << 20, 3, share=0.01)[1] == 1 and layout(24, 1, 1 << 20, 5)[0] == 1
    groups, slots = layout(24, 10_000, 100 << 30, 4000)
    assert (100 << 30) / groups <= 128 << 20 and slots >= 2


def test_a_point_block_is_sent_once_to_a_group(spark):
    from counterpoise.operators.topk import layout, pack

    g = np.random.default_rng(2)
    x = g.normal(size=(600, 3))
    rows = spark.createDataFrame([(i, 0.0, x[i].tolist(), i % 40, i % 12) for i in range(600)], "id long, label double, x array<double>, qb int, block int")
    q, p = pack(rows, "qb").cache(), pack(rows, "block").cache()
    found = search(q, p, q.select("qb").crossJoin(p.select("block")), 2, True).cache()
    _, order = _brute(x, x, 2, True)
    got: dict = {}
    for r in sorted(found.collect(), key=lambda r: (r.d2, r.neighbour)):
        got.setdefault(r.id, []).append(r.neighbour)
    assert got == {i: order[i].tolist() for i in range(600)}
    groups, slots = layout(2 * spark.sparkContext.defaultParallelism, 40, 600 * 24, 12)
    assert groups < 40  # several query blocks share what a task is sent


@pytest.mark.parametrize("most", [0, 100, 1 << 30])
def test_rounds_sent_or_shuffled_choose_the_same_rows(spark, monkeypatch, most):
    """``most`` bytes: every round is shuffled, some are, none is."""
    from counterpoise.operators import neighbours

    g = np.random.default_rng(4)
    x, y = g.normal(size=(400, 2)).round(1), g.integers(0, 2, 400).astype(float)
    df = labelled_rows(spark, [(i, y[i], x[i]) for i in range(400)])
    called: list = []
    real = neighbours.search_sent
    monkeypatch.setattr(neighbours, "SENT_BYTES", most)
    monkeypatch.setattr(neighbours, "search_sent", lambda *a, **kw: called.append(1) or real(*a, **kw))
    log: list = []
    got = sorted(r.id for r in fcnn_global(df, k=3, block=150, log=log).collect())
    assert got == sorted(fcnn_kernel(x, y, 3).tolist())
    assert len(called) == {0: 0, 1 << 30: len(log) - 1}.get(most, len(called))


def test_rows_that_share_an_id_keep_a_list_each(spark):
    from counterpoise.operators.topk import pack

    g = np.random.default_rng(6)
    x = g.normal(size=(120, 3))
    rows = spark.createDataFrame([(i // 2, 0.0, x[i // 2].tolist(), i % 5, i % 11) for i in range(120)], "id long, label double, x array<double>, qb int, block int")
    q, p = pack(rows, "qb").cache(), pack(rows, "block").cache()
    pairs = q.select("qb").crossJoin(p.select("block"))
    many = search(q, p, pairs, 3, True, 2)  # at least six lists a query
    assert {r["count"] for r in many.groupBy("id").count().collect()} == {6}
