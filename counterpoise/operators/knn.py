"""Votes over rows and the k-nearest-neighbour classifier built on them.

``vote_rows`` takes ballots in long form, any number of classes: two grouped aggregations
with map-side partials (weight per class, then the heaviest class), so a row with a million
ballots is as good as one with three.  Ties go to the smallest class; null classes abstain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, ID, LABEL
from counterpoise.operators.topk import topk_neighbours


def vote_rows(ballots: DataFrame, keys: list[str] | str = ID, class_col: str = "class", weight_col: str | None = None) -> DataFrame:
    """``(keys, prediction, support, total, tied)``: the class of most weight, its weight, all weight, and whether others had as much."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    per_class = ballots.groupBy(*keys, F.col(class_col).alias("_class")).agg(F.sum(F.when(F.col(class_col).isNotNull(), w)).alias("_w"))
    cast = F.col("_w").isNotNull()
    top = per_class.groupBy(*keys).agg(F.min(F.when(cast, F.struct((-F.col("_w")).alias("minus"), F.col("_class").alias("c")))).alias("_first"), F.sum("_w").alias("total"),
                                       F.max(F.when(cast, F.struct(F.col("_w").alias("w"), F.col("_class").alias("c")))).alias("_last"))
    # Among classes of equal weight one aggregate finds the smallest, the other the largest.
    return top.select(*keys, F.col("_first.c").alias("prediction"), F.col("_last.w").alias("support"), F.coalesce("total", F.lit(0.0)).alias("total"),
                      F.coalesce(F.col("_first.c") != F.col("_last.c"), F.lit(False)).alias("tied"))


def knn_predict(train: DataFrame, test: DataFrame, k: int = 3, weighted: bool = False, id_col: str = ID, features_col: str = FEATURES, label_col: str = LABEL, **search) -> DataFrame:
    """``(id, prediction, support, total, tied)`` of every test row from its k nearest training rows.

    ``weighted`` counts a neighbour by the inverse of its distance (one at distance zero
    outweighs all others).  A tie goes to the smallest class; a test row without features,
    or any row when there is no training row, has no row in the result.
    """
    near = topk_neighbours(train, k, test, id_col=id_col, features_col=features_col, label_col=label_col, **search)
    weight = F.when(F.col("distance") > 0, 1 / F.col("distance")).otherwise(1e300) if weighted else F.lit(1.0)
    return vote_rows(near.select("id", F.col("label").alias("class"), weight.alias("w")), "id", "class", "w")
