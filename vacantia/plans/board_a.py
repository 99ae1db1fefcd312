"""The first board: filter, standardise, extract skills, hand over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, skills, vocab
from ..functions.similarity import with_standard_role
from ..operators import columns, filters, reports
from ..sources import readers, writers


def standardise(raw: DataFrame) -> DataFrame:
    """Postings of IT jobs with role, skills, seniority and text length.

    Row-wise throughout, so it runs on a stream as well, and the wide rows are
    not shuffled for the sake of the few titles that no keyword settles.
    """
    kept = filters.keep_domain(filters.drop_noise(raw))
    found = skills.whole_words(F.col("job_description"))
    out = (with_standard_role(kept, "title")
           .withColumn("extracted_skills", found)
           .withColumn("skills_count", F.size("extracted_skills"))
           .withColumn("seniority", rules.seniority(F.col("title")))
           .withColumn("jd_length", F.length("job_description")))
    return columns.select_existing(out, vocab.BOARD_A_COLUMNS)


def step_log(raw: DataFrame) -> DataFrame:
    """Rows removed by either filter, in one pass over the raw table."""
    return reports.step_counts(raw, [
        ("noise title", ~filters.is_noise(F.col("title"))),
        ("no IT word in description", filters.in_domain(F.col("job_description")))])


def run(spark: SparkSession, source: str, raw_columns: list[str], target: str, run_id: str) -> DataFrame:
    """Read, standardise, store as parquet, and write the CSV and the summary."""
    raw = readers.read_delimited(spark, source, raw_columns)
    table = f"{target}/final_{run_id}.parquet"
    writers.write_table(standardise(raw), table)
    final = spark.read.parquet(table)
    writers.write_projected(final, f"{target}/final_{run_id}.csv")
    writers.write_slim(final, f"{target}/slim_{run_id}.csv")
    writers.write_summary(reports.run_summary(final, run_id), f"{target}/summary_{run_id}.json")
    return final
