"""The corpus pipeline: from raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vacantia.llm import stages
from vacantia.llm.common import documents, store

STAGES = [
    ("quality classifier", stages.quality_classifier),
    ("language ID", stages.language_id),
    ("SimHash near-dedup", stages.simhash_near_dedup),
    ("substring dedup", stages.substring_dedup),
    ("best-fit packing", stages.best_fit_packing),
]

#: Trained models and tokens have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
