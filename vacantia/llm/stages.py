"""Stages of the corpus pipeline: documents in, documents out.

Every stage keeps the columns of its input, whatever else they hold, and its
decisions take effect: what it rejects is gone from its output.

Defined cases: a null text is judged as an empty one, which has no letters and
is rejected as of no language, as is one whose n-grams no two learned documents
hold; in near-dedup a row without an id stays, and different texts under one id
are judged each for itself; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import automata, copies, langid, packing, quality

#: Share of a text's n-grams that must belong to its language.
LEAST_SHARE = 0.4


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    classifier = quality.learn(docs)
    return docs.where(quality.judged(F.col("text"), classifier, spark)["score"] >= 0.5)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language, or hardly of any, go."""
    # An n-gram counts from two documents on, so that none vouches for itself.
    filters = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))), least_docs=2)
    return docs.where(langid.predicted(F.col("text"), filters, spark)["score"] >= LEAST_SHARE)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts with a Jaccard similarity of 0.8 or more one stays: the least id, then the least text hash."""
    found = copies.near_copies(docs)
    # Rows are told apart by id and text, so different texts of one id are judged each for itself.
    keep = (found.where("doc_id = component_id").groupBy("group_id")
            .agg(F.min("text_hash").alias("kept_hash"), F.first("component_id").alias("kept_id")))
    digest, number = "text_hash", "row_number_of_text"
    while digest in docs.columns or number in docs.columns:
        digest, number = digest + "_", number + "_"
    hashed = docs.withColumn(digest, F.xxhash64("text"))
    first = Window.partitionBy("doc_id", digest).orderBy(digest)
    kept = (hashed.join(keep, (hashed["doc_id"] == keep["kept_id"]) & (hashed[digest] == keep["kept_hash"]), "left_semi")
            .withColumn(number, F.row_number().over(first)).where(F.col(number) == 1))
    return kept.select(*docs.columns).union(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that occur earlier in the corpus go."""
    out = automata.cut(docs, 20)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 tokens; one row per piece of a document."""
    return packing.best_fit_pack(docs, 2048)
