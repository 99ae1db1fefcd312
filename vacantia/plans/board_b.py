"""The second board: unite files, drop repeats, standardise, hand over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, salary, text, vocab
from ..operators import columns, dedup, filters
from ..sources import readers, writers


def clean(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Trimmed, unique, standardised postings.

    ``order`` decides which copy is the last one.  Repeats go before rows
    without title or company.  What decides about repeats is trimmed before,
    all else in the copies that are left.
    """
    deciding = ["id", "title", "company", *order]
    unique = dedup.dedup_key(columns.trim_strings(raw, only=deciding), order)
    kept = columns.trim_strings(filters.required(unique, "title", "company"), but=deciding)
    filled = kept.withColumns({
        "job_description": F.coalesce("job_description", F.lit("")),
        "salary": text.fill_sentinel(F.col("salary")),
        "location": text.fill_sentinel(F.col("location")),
        "extracted_skills": text.parse_list(F.col("extracted_skills"))})
    out = columns.keep_raw_copy(filled, "search_role", "location").withColumns({
        "search_role": rules.role_by_pattern(F.col("search_role")),
        "location": rules.place(F.col("location")),
        "job_level": rules.level_from_text(F.col("title"), F.col("job_description")),
        "skills_count": F.size("extracted_skills"),
        "_salary": salary.parse(F.col("salary"))})
    out = (out.select("*", "_salary.*").drop("_salary")
           .withColumn("salary_avg", salary.midpoint(F.col("salary_min"), F.col("salary_max"))))
    if "scraped_at" in out.columns:
        out = out.withColumn("scraped_at", text.to_time(F.col("scraped_at")))
    return columns.reorder(columns.drop_ignore(out, "_source", "_row"), vocab.BOARD_B_COLUMNS)


def run(spark: SparkSession, glob: str, target: str, run_id: str) -> DataFrame:
    """Read all files of the glob, clean, store as parquet, write CSV and JSON."""
    raw = readers.read_glob(spark, glob)
    table = f"{target}/final_{run_id}.parquet"
    writers.write_table(clean(raw, ["_source", "_row"]), table)
    final = spark.read.parquet(table)
    writers.write_csv(final, f"{target}/final_{run_id}.csv")
    writers.write_records_light(final, f"{target}/final_{run_id}.json")
    return final
