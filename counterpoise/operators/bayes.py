"""Multinomial naive Bayes in DataFrame form.

Closed form (additive smoothing ``lam``, C classes, D features):

    pi_c     = ln(n_c + lam) - ln(N + C*lam)
    theta_cj = ln(S_cj + lam) - ln(sum_j S_cj + D*lam),   S_cj = sum of x_j over class c

``fit`` is ONE grouped aggregation (C rows x D sums reach the driver — their
size is fixed by the schema, not by the data).  ``transform`` inlines the
parameters and scores every class with a codegen'd dot product; the argmax
takes the lowest label on a tie.  Row weights (e.g. ROS copies) are
supported and give the same model as physically repeated rows.

``ml_naive_bayes`` wraps ``pyspark.ml.classification.NaiveBayes`` for vector
input; both give the same predictions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, LABEL, num_features
from counterpoise.functions.vectors import dot_literal, to_vector

CLASSES = (0.0, 1.0)


@dataclass
class NBModel:
    pi: list[float]
    theta: list[list[float]]
    classes: tuple = CLASSES
    features_col: str = FEATURES
    prediction_col: str = "prediction"

    def scores(self):
        return [dot_literal(self.features_col, th, p) for p, th in zip(self.pi, self.theta)]

    def predict_col(self):
        scores = self.scores()
        best = F.lit(self.classes[0])
        best_score = scores[0]
        # strict '>' keeps the first (lowest) class on ties
        for c, s in zip(self.classes[1:], scores[1:]):
            best = F.when(s > best_score, F.lit(c)).otherwise(best)
            best_score = F.greatest(s, best_score)
        return best

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.prediction_col, self.predict_col())

    def params(self, spark: SparkSession) -> DataFrame:
        rows = [
            (float(c), j, float(self.theta[i][j]), float(self.pi[i]))
            for i, c in enumerate(self.classes)
            for j in range(len(self.theta[i]))
        ]
        return spark.createDataFrame(rows, "label double, j int, theta double, pi double")


class MultinomialNB:
    def __init__(
        self,
        smoothing: float = 1.0,
        weight_col: str | None = None,
        label_col: str = LABEL,
        features_col: str = FEATURES,
        prediction_col: str = "prediction",
    ):
        self.smoothing = smoothing
        self.weight_col = weight_col
        self.label_col = label_col
        self.features_col = features_col
        self.prediction_col = prediction_col

    def fit(self, df: DataFrame) -> NBModel:
        d = num_features(df, self.features_col)
        x = F.col(self.features_col)
        w = F.col(self.weight_col).cast("double") if self.weight_col else F.lit(1.0)
        # Labels other than the classes fall into one group (null), so at most
        # three rows reach the driver whatever the label column holds.
        group = F.when(F.col(self.label_col).isin(*CLASSES), F.col(self.label_col)).alias("_class")
        rows = (
            df.groupBy(group)
            .agg(
                F.sum(w).alias("n"),
                F.min(F.array_min(x)).alias("xmin"),
                *[F.sum(w * x[j]).alias(f"s{j}") for j in range(d)],
            )
            .collect()
        )
        by_label = {r["_class"]: r for r in rows}
        if None in by_label:
            raise ValueError(f"{by_label[None]['n']} rows (by weight) have labels outside {{0, 1}}")
        if any(r["xmin"] is not None and r["xmin"] < 0 for r in rows):
            raise ValueError("multinomial naive Bayes needs non-negative features (scale them first)")
        lam = self.smoothing
        total = sum(r["n"] for r in rows)
        pi, theta = [], []
        for c in CLASSES:
            r = by_label.get(c)
            n_c = r["n"] if r else 0.0
            s = [(r[f"s{j}"] or 0.0) if r else 0.0 for j in range(d)]
            pi.append(math.log(n_c + lam) - math.log(total + len(CLASSES) * lam))
            denom = math.log(sum(s) + d * lam)
            theta.append([math.log(v + lam) - denom for v in s])
        return NBModel(pi, theta, CLASSES, self.features_col, self.prediction_col)


def ml_naive_bayes(df: DataFrame, smoothing: float = 1.0, weight_col: str | None = None, prediction_col: str = "prediction"):
    """Fit ``pyspark.ml`` multinomial NB on the array features; returns the model (it reads the column ``_vec``)."""
    nb = NaiveBayes(
        smoothing=smoothing,
        modelType="multinomial",
        featuresCol="_vec",
        labelCol=LABEL,
        predictionCol=prediction_col,
        rawPredictionCol="",
        probabilityCol="",
    )
    if weight_col:
        nb.setWeightCol(weight_col)
    d = num_features(df)
    label = F.col(LABEL).alias(LABEL, metadata={"ml_attr": {"type": "nominal", "num_vals": 2}})
    vec = to_vector(FEATURES).alias("_vec", metadata={"ml_attr": {"num_attrs": d}})
    # ML attribute metadata: the estimator need not run jobs to find them
    return nb.fit(df.select(*[c for c in df.columns if c != LABEL], label, vec))
