"""Decision tree and random forest (``pyspark.ml``) on labelled frames.

Tree induction is Spark's own (binned, level-wise, statistics aggregated on
executors).  What we add:

* array features become a vector only inside the fit/score projection;
* ``partitions=n`` hash-partitions by id and sorts within partitions before
  the fit, so a seeded forest is the same whatever the input partitioning
  (bagging seeds are per partition) — one shuffle, opt-in;
* scoring writes only a prediction column (no raw/probability columns), so
  many models can be chained over one scan of the test set.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, ID, LABEL, num_features
from counterpoise.functions.vectors import to_vector

_ids = itertools.count()


ROWS_PER_PARTITION = 100_000


def stable_order(df: DataFrame, partitions: int | str) -> DataFrame:
    """Fixed hash partitioning by (id, copy_no) and sorted partitions.

    ``partitions="auto"`` takes one partition per ``ROWS_PER_PARTITION`` rows: the rule
    depends on the data only, so seeded fits agree on any cluster and configuration.
    The count is explicit, so AQE does not coalesce it away.
    """
    if partitions == "auto":
        partitions = max(1, -(-df.count() // ROWS_PER_PARTITION))
    keys = [ID] + (["copy_no"] if "copy_no" in df.columns else [])
    return df.repartition(int(partitions), *keys).sortWithinPartitions(*keys)


_LINE = re.compile(r"^(\s*)(?:(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)|Predict: (\S+))$")


def tree_sql(model, test) -> str:
    """A fitted tree classifier as one SQL CASE expression.

    ``test(feature, threshold)`` gives the SQL of "feature <= threshold".
    """
    lines = [m for line in model.toDebugString.splitlines() if (m := _LINE.match(line))]

    def read(i: int) -> tuple[str, int]:
        m = lines[i]
        if m[6] is not None:
            return f"{float(m[6])!r}D", i + 1
        yes, i = read(i + 1)
        no, i = read(i + 1)  # past the Else line
        return f"CASE WHEN {test(int(m[3]), float(m[5]))} THEN {yes} ELSE {no} END", i

    return read(0)[0]


@dataclass
class MLScorer:
    """A fitted ``pyspark.ml`` model applied to array features."""

    model: object
    features_col: str = FEATURES
    prediction_col: str = "prediction"

    def transform(self, df: DataFrame, prediction_col: str | None = None) -> DataFrame:
        vec = f"_vec{next(_ids)}"
        return self.transform_vector(df.withColumn(vec, to_vector(self.features_col)), vec, prediction_col).drop(vec)

    def transform_vector(self, df: DataFrame, vector_col: str, prediction_col: str | None = None) -> DataFrame:
        """Score a frame that already holds the feature vector (adds one column)."""
        m = self.model.copy()
        m.setFeaturesCol(vector_col)
        m.setPredictionCol(prediction_col or self.prediction_col)
        for p in ("rawPredictionCol", "probabilityCol"):
            if m.hasParam(p):
                m.set(m.getParam(p), "")
        return m.transform(df)


def _prepare(df: DataFrame, features_col: str, partitions: int | str | None, label_col: str = LABEL,
             d: int | None = None) -> DataFrame:
    """Vector column plus ML attribute metadata (binary nominal label, vector
    width), so the estimator does not run extra jobs to discover them."""
    if partitions:
        df = stable_order(df, partitions)
    d = d or num_features(df, features_col)
    label = F.col(label_col).alias(label_col, metadata={"ml_attr": {"type": "nominal", "num_vals": 2}})
    vec = to_vector(features_col).alias("_vec", metadata={"ml_attr": {"num_attrs": int(d)}})
    return df.select(*[c for c in df.columns if c != label_col], label, vec)


def fit_dt(
    df: DataFrame,
    max_depth: int = 10,
    max_bins: int = 100,
    impurity: str = "gini",
    weight_col: str | None = None,
    seed: int = 1,
    partitions: int | str | None = None,
    features_col: str = FEATURES,
    label_col: str = LABEL,
    num_features: int | None = None,
) -> MLScorer:
    dt = DecisionTreeClassifier(
        featuresCol="_vec", labelCol=label_col, impurity=impurity, maxDepth=max_depth, maxBins=max_bins, seed=seed
    )
    if weight_col:
        dt.setWeightCol(weight_col)
    return MLScorer(dt.fit(_prepare(df, features_col, partitions, label_col, num_features)), features_col)


def fit_rf(
    df: DataFrame,
    num_trees: int = 100,
    max_depth: int = 10,
    max_bins: int = 100,
    feature_subset: str = "auto",
    impurity: str = "gini",
    weight_col: str | None = None,
    seed: int = 1,
    partitions: int | str | None = None,
    features_col: str = FEATURES,
    label_col: str = LABEL,
    num_features: int | None = None,
) -> MLScorer:
    rf = RandomForestClassifier(
        featuresCol="_vec",
        labelCol=label_col,
        numTrees=num_trees,
        maxDepth=max_depth,
        maxBins=max_bins,
        featureSubsetStrategy=feature_subset,
        impurity=impurity,
        seed=seed,
    )
    if weight_col:
        rf.setWeightCol(weight_col)
    return MLScorer(rf.fit(_prepare(df, features_col, partitions, label_col, num_features)), features_col)
