"""The operators of this package on the driver's tables, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterpoise.llm import fim, urlfilter, variants
from counterpoise.llm.common import table

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@query("op7_kd_sharding")
def q_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.sharding import kd_shards

    out = kd_shards(table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_pattern_packing")
def q_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.packing import pack_documents

    out = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), capacity=2048)
    return out.withColumn("length", F.col("length").cast("long"))


@query("op8_token_files")
def q_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.tokenfile import read_token_files, write_token_files
    from counterpoise.session import scratch_path

    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), closing_id=2)
    return read_token_files(spark, path, digests=True)


@query("op9_hyperplane_dedup")
def q_hyperplane_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.embdedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


@query("op3_quality_mil")
def q_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.quality import fit_quality, score_quality

    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op10_counterfactual_toxicity")
def q_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.toxicity import fit_toxicity, score_toxicity

    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


@query("op4_path_templates", urlfilter.duckdb_sql(URL_RULES))
def q_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = urlfilter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


@query("op5_substring_dedup")
def q_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.substring import repeated_spans

    return repeated_spans(table(spark, sf_dir, "documents")).select("doc_id", "first_doc_id", "start", "end")


@query("op6_qgram_decontamination")
def q_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_ngram_jaccard")
def q_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.jaccard import near_documents

    return near_documents(table(spark, sf_dir, "documents"))


@query("op11_spelling_variants", variants.duckdb_sql())
def q_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"), ratio=2, min_length=5, min_count=3, slip=97)


@query("op12_zstd_secrets")
def q_zstd_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from counterpoise.llm.secretscan import find_secrets, secret_digests

    out = secret_digests(find_secrets(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query("op13_counted_fim", fim.duckdb_sql())
def q_counted_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_digests(table(spark, sf_dir, "documents"), plain_percent=10, spm_percent=20, seed=1)
