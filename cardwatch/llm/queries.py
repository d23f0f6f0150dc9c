"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import chat_format, decontamination, divergence, language_id, minhash, ngram_join, packing, quality_rules, sharding, sql, token_counts, toxicity, url_filter, whitening

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts, uniformly shuffled."""
    return sharding.assignments(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return language_id.languages(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), path)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels that are not held out."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, up to two substitutions in 13 words."""
    found = decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and adaptive verdict of all documents."""
    return quality_rules.verdicts(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each participant, as digests."""
    return chat_format.digests(chat_format.rotate(_table(spark, sf_dir, "conversations")))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ in their words, and which words tell them."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, and the document of each that stays."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings on their first components, whitened."""
    found = whitening.whitened(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
    # A sum of squares beyond 64 bits is in the decimal column alone.
    return found.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_language_id": op2_language_id,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filter": op8_url_filter,
    "op9_ngram_join": op9_ngram_join,
    "op10_chat_format": op10_chat_format,
    "op11_divergence": op11_divergence,
    "op12_minhash": op12_minhash,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op5_decontamination": sql.OP5,
    "op7_quality_rules": sql.OP7,
    "op8_url_filter": sql.OP8,
    "op10_chat_format": sql.OP10,
    "op11_divergence": sql.OP11,
}
