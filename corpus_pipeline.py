"""From raw documents to packed training sequences, one operator per stage.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; the
result is written as Parquet under the shared checkpoint folder and read again as the
next stage's documents, so a lost executor costs one stage at most.  All stages but the
last return the columns of ``documents``.

Defined cases: documents with null or empty text pass the classifier's score like any
other, are near-duplicates of nothing, hold no spans or leaks and pack as one closing
id; of rows that repeat both document id and text one stays, other texts of an id stay too; rows with a null id all stay in the
near-duplicate stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.llm.common import apart, free, staged, table
from counterpoise.llm.decontaminate import drop_leaks
from counterpoise.llm.jaccard import near_documents
from counterpoise.llm.packing import pack_documents
from counterpoise.llm.quality import fit_quality, score_quality
from counterpoise.llm.queries import tokenizer_path
from counterpoise.llm.substring import remove_spans, repeated_spans

#: The stages before the last cannot be put as SQL (a fitted classifier, rolling hashes, alignments).
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.5 or more."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model, keep=True).where("_score >= 0.5").drop("_score")


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near-duplicates the document with the smallest id."""
    found = near_documents(docs)
    first = found.where("doc_id is not null").groupBy("doc_id").agg(F.expr("count_if(doc_id = component_id)").alias("rows"))
    first = staged(first.where("rows <> 1"), "pipeline-near")
    free(found)
    # Few documents go, so few texts are moved to find them.
    gone = first.where("rows = 0").select("doc_id")
    stay, rest = apart(docs.where(F.col("doc_id").isNotNull()), F.col("doc_id"), gone)
    kept = stay.unionByName(rest.join(gone, "doc_id", "left_anti"))
    if not first.where("rows > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans that an earlier document (or place) holds."""
    cut = remove_spans(docs, staged(repeated_spans(docs), "pipeline-spans"))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of at most 2048 ids."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), capacity=2048, room=200_000)  # workers hold what earlier stages left, too


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard", ngram_jaccard),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontamination),
    ("pattern_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
