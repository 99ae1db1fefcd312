"""One query per operator, on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import automata, langid, lm, multiindex, packing, pieces, quality, rules, simhash, suffixes, topk, variants, whitening
from .common import documents
from .registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(documents(spark, sf_dir), 2048)


@query("op7_quality_rules", rules.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir))


@query("op2_exact_top_k", topk.SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors.where("vec_id % 20 = 0"), vectors)


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(documents(spark, sf_dir))


@query("op4_lm_scoring")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_documents(documents(spark, sf_dir), ~lm.held_out(F.col("doc_id")))
    return scored.select("doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(documents(spark, sf_dir), 50)


@query("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automata.digest(documents(spark, sf_dir), 20)


@query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(variants.counts(documents(spark, sf_dir)))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_embedding_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
