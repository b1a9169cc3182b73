"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3; these rows' labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, label)`` of at most ``most`` labelled documents that are not held out.

    Which ones is decided by a hash of the id, so the sample does not depend on partitions.
    Rows with a null id or label are left out; of several labels of an id the largest
    counts, of several documents of an id the one whose text has the smallest hash: the
    bound holds for rows, however often an id is repeated.
    """
    picked = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    # At most `most` rows of two numbers: the bound that makes this broadcast safe.
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text"))).alias("one"), F.any_value("label").alias("label"))
    return one.select("doc_id", F.col("one.text").alias("text"), "label")
