"""Labelled frames built from the parquet tables.

Each builder reads only the columns it needs (the scan's ReadSchema is pruned)
and does all feature work with built-in expressions, over the whole table and
the whole text of every document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.frame import FEATURES, ID, LABEL, with_dim

EMB_DIM = 64  # length of the embedding vectors in the embeddings table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lp_emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings: id = vec_id, label = (label = 0), 64 float features as doubles."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias(ID),
        (F.col("label") == 0).cast("double").alias(LABEL),
        with_dim(F.transform("embedding", lambda x: x.cast("double")), EMB_DIM),
    )


def _count_of(text, pattern: str):
    # occurrences of a regex class = characters removed by replacing it
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, features)`` from the whole text of every document (narrow, no shuffle)."""
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        with_dim(
            F.array(
                F.col("n_chars").cast("double"),
                _count_of(t, "\n") + F.lit(1.0),
                _count_of(t, " "),
                _count_of(t, "[0-9]"),
                _count_of(t, "[A-Z]"),
            ),
            5,
        ),
    )


def _doc_features(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    # Features are computed on the documents side BEFORE the join: the join
    # then moves (doc_id, 5 doubles) per document instead of whole texts.
    labels = table(spark, sf_dir, "labels").select("doc_id", target)
    j = labels.join(doc_features(spark, sf_dir), "doc_id")
    return j.select(F.col("doc_id").alias(ID), F.col(target).cast("double").alias(LABEL), FEATURES)


def lp_toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels ⋈ documents, label = toxic (positive minority)."""
    return _doc_features(spark, sf_dir, "toxic")


def lp_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels ⋈ documents, label = quality (negative minority)."""
    return _doc_features(spark, sf_dir, "quality")


def lp_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with per-order lineitem aggregates (0 where an order has no line), label = urgent priority.

    The lineitem side is aggregated before the join (map-side partial
    aggregation, so a hot order key collapses before the shuffle) and is
    then unique on the join key.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    li = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").alias("sum_qty"),
            F.max("l_discount").alias("max_disc"),
            F.max("l_tax").alias("max_tax"),
        )
    )
    j = o.join(li, o["o_orderkey"] == li["l_orderkey"], "left")
    return j.select(
        F.col("o_orderkey").alias(ID),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias(LABEL),
        with_dim(
            F.array(
                F.col("o_totalprice").cast("double"),
                F.coalesce(F.col("n_lines").cast("double"), F.lit(0.0)),
                F.coalesce(F.col("sum_qty").cast("double"), F.lit(0.0)),
                F.coalesce(F.col("max_disc").cast("double"), F.lit(0.0)),
                F.coalesce(F.col("max_tax").cast("double"), F.lit(0.0)),
            ),
            5,
        ),
    )


def orders_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, label)`` of ``lp_orders`` from orders alone: class counts need no lineitem."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias(ID), (F.col("o_orderpriority") == "1-URGENT").cast("double").alias(LABEL))


FRAMES = {"emb": lp_emb, "toxic": lp_toxic, "quality": lp_quality, "orders": lp_orders}
