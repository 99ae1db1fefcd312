"""The selection behind the interactive report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text, vocab
from ..operators import columns, filters, lookups


def load(df: DataFrame) -> DataFrame:
    """Uniform names, parsed skills, numeric salary in millions, company size."""
    df = columns.rename(columns.normalise_headers(df), {"job_leevl": "job_level"})
    if "extracted_skills" in df.columns:
        if dict(df.dtypes)["extracted_skills"] == "string":
            df = df.withColumn("extracted_skills", text.parse_list_lenient(F.col("extracted_skills")))
    else:
        df = df.withColumn("extracted_skills", F.array().cast("array<string>"))
    df = columns.default_column(df, "skills_count", F.size("extracted_skills"))
    df = columns.default_column(df, "salary_avg", F.lit(None).cast("double"))
    df = df.withColumn("salary_avg", text.to_number(F.col("salary_avg")))
    df = df.withColumn("salary_avg_jt", text.scale(F.col("salary_avg")))
    sized = lookups.with_group_size(columns.drop_ignore(df, "company_hiring_freq"), "company")
    return sized.withColumn("company_size_proxy",
                            rules.band(F.col("company_hiring_freq"), vocab.COMPANY_SIZE_BANDS))


def select(df: DataFrame, chosen: Mapping[str, Sequence[str]], low: float | None = None,
           high: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the chosen facets, and those of them with a salary in range.

    An open bound keeps the extreme rows, which a rounded one might lose.
    """
    rows = filters.facets(df, chosen)
    return rows, filters.in_range(rows, "salary_avg_jt", low, high)
