"""Bench-only query shapes matching the baseline's local-cost rows.

The baseline timed, on lp_orders at sf0.1, fit + score + count of: a decision
tree (depth 10, 100 bins), a 20-tree forest, multinomial NB, and a PCA fit.
These run the same work on the whole frame (train = test = lp_orders).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from counterpoise.operators.bayes import MultinomialNB
from counterpoise.operators.evaluate import evaluate
from counterpoise.operators.forest import fit_forest
from counterpoise.operators.pca import fit_pca
from counterpoise.operators.scaling import MinMaxScaler
from counterpoise.operators.trees import fit_dt
from counterpoise.sources.tables import lp_orders


def _frame(spark, sf_dir):
    # the same plan every time, so the cache built by b_frame is reused
    return lp_orders(spark, sf_dir).cache()


def b_frame(spark, sf_dir):
    return _frame(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


def b_dt(spark, sf_dir):
    df = _frame(spark, sf_dir)
    return evaluate(fit_dt(df, 10, 100).transform(df))


def b_rf(spark, sf_dir):
    df = _frame(spark, sf_dir)
    return evaluate(fit_forest(df, 20, 10, 100).transform(df))


def b_nb(spark, sf_dir):
    df = _frame(spark, sf_dir)
    s = MinMaxScaler().fit(df).transform(df)
    return evaluate(MultinomialNB().fit(s).transform(s))


def b_pca(spark, sf_dir):
    df = _frame(spark, sf_dir)
    m = fit_pca(df, k=5)
    return df.select(m.project().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("p")[0]).alias("s"))


BENCH = {"dt_orders": b_dt, "rf20_orders": b_rf, "nb_orders": b_nb, "pca_orders": b_pca}
FROM_REGISTRY = (
    "class_counts",
    "ros_rows",
    "ros_rate_sweep",
    "rus_rows",
    "minmax_scaled",
    "nb_metrics",
    "dt_metrics",
    "rf_metrics",
    "pcard_predict",
    "hme_filter",
    "fcnn_select",
    "discretized",
    "keel_roundtrip",
)
