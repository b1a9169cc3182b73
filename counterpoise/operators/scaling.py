"""Min-max scaling of ``array<double>`` features.

``fit`` is ONE global aggregation (per-element min and max with map-side
partial aggregates; 2*D numbers reach the driver).  ``transform`` inlines the
ranges as literals, so scaling is a codegen'd projection.  A constant feature
(``hi == lo``) scales to 0.0; values outside the fitted range are clipped to
[0, 1] by default so multinomial NB never sees a negative count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, num_features, with_dim
from counterpoise.functions.literals import sql_double, sql_ident


@dataclass
class MinMaxModel:
    lo: list[float]
    hi: list[float]
    clip: bool = True
    features_col: str = FEATURES

    def scaled(self):
        ref = sql_ident(self.features_col)
        out = []
        for j, (lo, hi) in enumerate(zip(self.lo, self.hi)):
            if hi is None or lo is None or not hi > lo:
                out.append("0.0D")
                continue
            v = f"({ref}[{j}] - {sql_double(lo)}) / {sql_double(hi - lo)}"
            out.append(f"least(greatest({v}, 0.0D), 1.0D)" if self.clip else v)
        return F.expr("array(" + ", ".join(out) + ")")

    def transform(self, df: DataFrame, output_col: str | None = None) -> DataFrame:
        name = output_col or self.features_col
        return df.withColumn(name, with_dim(self.scaled(), len(self.lo), name))


class MinMaxScaler:
    def __init__(self, clip: bool = True, features_col: str = FEATURES):
        self.clip = clip
        self.features_col = features_col

    def fit(self, df: DataFrame) -> MinMaxModel:
        d = num_features(df, self.features_col)
        arr = F.col(self.features_col)
        row = df.agg(
            *[F.min(arr[j]).alias(f"lo{j}") for j in range(d)],
            *[F.max(arr[j]).alias(f"hi{j}") for j in range(d)],
        ).first()
        lo = [row[f"lo{j}"] for j in range(d)]
        hi = [row[f"hi{j}"] for j in range(d)]
        return MinMaxModel(lo, hi, self.clip, self.features_col)


def minmax(df: DataFrame, clip: bool = True) -> DataFrame:
    """Fit on ``df`` and scale it."""
    return MinMaxScaler(clip).fit(df).transform(df)
