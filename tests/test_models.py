"""NB by hand, NB vs pyspark.ml, trees on separable data, partition-stable forests."""

import math

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import SF01, labelled_rows
from counterpoise.frame import split
from counterpoise.operators import balance
from counterpoise.operators.bayes import MultinomialNB, ml_naive_bayes
from counterpoise.operators.evaluate import evaluate
from counterpoise.operators.scaling import MinMaxScaler, minmax
from counterpoise.operators.trees import fit_dt, fit_rf
from counterpoise.sources.tables import lp_emb


def separable(spark, n=200, flips=()):
    rows = []
    for i in range(n):
        x = (i - n / 2 + 0.5) / 10.0
        y = 1.0 if x > 0 else 0.0
        if i in flips:
            y = 1.0 - y
        rows.append((i, y, [x]))
    return labelled_rows(spark, rows)


def test_nb_by_hand(spark):
    df = labelled_rows(spark, [(1, 0, [1, 2, 0]), (2, 0, [0, 1, 1]), (3, 1, [3, 0, 1])])
    m = MultinomialNB(1.0).fit(df)
    assert m.pi[0] == pytest.approx(math.log(3 / 5)) and m.pi[1] == pytest.approx(math.log(2 / 5))
    assert m.theta[0] == pytest.approx([math.log(2 / 8), math.log(4 / 8), math.log(2 / 8)])


def test_nb_rejects_negative_features(spark):
    with pytest.raises(ValueError):
        MultinomialNB().fit(labelled_rows(spark, [(1, 0, [-1.0]), (2, 1, [1.0])]))


def test_nb_matches_pyspark_ml_and_weights_match_copies(spark):
    train, test = split(lp_emb(spark, SF01))
    sc = MinMaxScaler().fit(train)
    tr, te = sc.transform(train), sc.transform(test)
    ours = MultinomialNB().fit(tr).transform(te).select("id", "prediction")
    ml = ml_naive_bayes(tr).transform(te.withColumn("_vec", array_to_vector("features"))).select("id", "prediction")
    assert ours.exceptAll(ml).count() == 0
    w = MultinomialNB(weight_col="weight").fit(balance.ros(tr, 1.0, seed=1, as_weights=True))
    e = MultinomialNB().fit(balance.ros(tr, 1.0, seed=1))
    assert w.pi == pytest.approx(e.pi) and w.theta[1] == pytest.approx(e.theta[1])


def test_minmax_constant_and_clip(spark):
    df = labelled_rows(spark, [(1, 0, [1.0, 5.0]), (2, 1, [3.0, 5.0])])
    out = {r.id: r.features for r in minmax(df).collect()}
    assert out == {1: [0.0, 0.0], 2: [1.0, 0.0]}
    m = MinMaxScaler().fit(df)
    far = labelled_rows(spark, [(3, 0, [9.0, 1.0])])
    assert m.transform(far).first().features == [1.0, 0.0]


def test_dt_separable(spark):
    df = separable(spark)
    r = evaluate(fit_dt(df).transform(df)).first()
    assert r.accuracy == 1.0


def test_rf_same_on_2_and_7_partitions(spark):
    df = lp_emb(spark, SF01).cache()
    a = fit_rf(df.repartition(2), num_trees=5, max_depth=4, seed=3, partitions=4).transform(df)
    b = fit_rf(df.repartition(7), num_trees=5, max_depth=4, seed=3, partitions=4).transform(df)
    assert a.select("id", "prediction").exceptAll(b.select("id", "prediction")).count() == 0


def test_weighted_trees_accept_ros_weights(spark):
    df = separable(spark, 100)
    w = balance.ros(df, 1.0, seed=1, as_weights=True)
    # rows that drew 0 copies left the training set; the kept rows are separable
    assert evaluate(fit_dt(w, weight_col="weight").transform(w)).first().accuracy == 1.0
    assert evaluate(fit_rf(w, num_trees=3, weight_col="weight").transform(df)).first().accuracy > 0.9


def test_pca_components_and_projection(spark):
    import numpy as np

    from counterpoise.operators.pca import fit_pca
    from counterpoise.sources.tables import lp_orders

    for frame, k in ((lp_orders(spark, SF01), 3), (lp_emb(spark, SF01), 4)):
        m = fit_pca(frame, k)
        x = np.array([r.features for r in frame.select("features").collect()])
        w, v = np.linalg.eigh(np.cov(x.T))
        assert np.abs((m.components * v[:, ::-1][:, :k]).sum(0)).min() > 1 - 1e-6
        row = frame.select(m.project().alias("p"), "features").first()
        assert np.allclose(row.p, np.array(row.features) @ m.components, rtol=1e-9, atol=1e-9)


def test_pca_weights_are_copies(spark):
    import numpy as np

    from counterpoise.operators.pca import fit_pca

    df = balance.ros(lp_emb(spark, SF01), 1.0, seed=1)
    w = balance.ros(lp_emb(spark, SF01), 1.0, seed=1, as_weights=True)
    assert np.allclose(fit_pca(df, 3).components, fit_pca(w, 3, weight_col="weight").components, atol=1e-8)


def test_tree_as_sql_scores_like_the_model(spark):
    from counterpoise.operators.trees import tree_sql

    df = lp_emb(spark, SF01)
    m = fit_dt(df, max_depth=6)
    sql = tree_sql(m.model, lambda f, t: f"features[{f}] <= {t!r}D")
    both = m.transform(df).withColumn("s", F.expr(sql))
    assert both.where("s <> prediction").count() == 0 and both.where("s is null").count() == 0
