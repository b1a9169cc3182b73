"""The flagship query: the oversampling experiment with naive Bayes, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.frame import split
from counterpoise.operators import balance, evaluate
from counterpoise.operators.bayes import MultinomialNB
from counterpoise.operators.scaling import MinMaxScaler
from counterpoise.sources.tables import lp_toxic


def flagship(spark: SparkSession, sf_dir: str, rate: float = 1.0, seed: int = 1) -> DataFrame:
    train, test = split(lp_toxic(spark, sf_dir))
    scaler = MinMaxScaler().fit(train)
    train_ros = balance.ros(scaler.transform(train), rate, seed, as_weights=True)
    model = MultinomialNB(weight_col="weight").fit(train_ros)
    scored = model.transform(scaler.transform(test))
    return evaluate.evaluate(scored).select(F.lit("ros").alias("prep"), F.lit(rate).alias("rate"), F.lit("nb").alias("model"), "*")
