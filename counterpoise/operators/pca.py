"""Principal components by ``pyspark.ml``, with fixed signs and an array projection.

``pyspark.ml.feature.PCA`` gathers the covariance on the executors and decomposes it on
the driver (D x D, fixed by the schema).  Fits from parallel driver threads take turns:
concurrent decompositions in one JVM were seen to hang.  Each component's sign is set so
that its largest entry is positive, so refits agree.  Rows may carry an integer weight:
they then count that many times.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, num_features, with_dim
from counterpoise.functions.vectors import to_vector

_ONE_AT_A_TIME = threading.Lock()


@dataclass
class PCAModel:
    components: np.ndarray  # D x k, columns by decreasing variance
    explained_variance: np.ndarray
    features_col: str = FEATURES

    @property
    def k(self) -> int:
        return self.components.shape[1]

    def project(self, col: str | None = None) -> Column:
        """``array<double>`` of the k projections ``x · V[:, i]``."""
        col = col or self.features_col
        d, k = self.components.shape
        flat = F.lit(np.ascontiguousarray(self.components.T).ravel())  # row i = component i
        proj = F.transform(
            F.sequence(F.lit(0), F.lit(k - 1)),
            lambda i: F.aggregate(
                F.zip_with(F.col(col), F.slice(flat, i * d + 1, d), lambda a, b: a * b),
                F.lit(0.0),
                lambda s, v: s + v,
            ),
        )
        return with_dim(proj, k, "_pca")

    def transform(self, df: DataFrame, output_col: str = "pca") -> DataFrame:
        return df.withColumn(output_col, self.project())


def fit_pca(df: DataFrame, k: int | None = None, features_col: str = FEATURES, weight_col: str | None = None) -> PCAModel:
    d = num_features(df, features_col)
    k = d if k is None else k
    if not 1 <= k <= d:
        raise ValueError(f"k must be in 1..{d}")
    if weight_col:
        df = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(weight_col).cast("int"))))
    vec = to_vector(features_col).alias("_vec", metadata={"ml_attr": {"num_attrs": int(d)}})
    with _ONE_AT_A_TIME:
        fitted = PCA(k=k, inputCol="_vec", outputCol="_pc").fit(df.select(vec))
    v = fitted.pc.toArray()
    flip = np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])
    return PCAModel(v * np.where(flip == 0, 1.0, flip), fitted.explainedVariance.toArray(), features_col)
