"""Both boards in one table, with salaries filled and features added."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text, vocab
from ..operators import columns, dedup, filters, impute, lookups
from ..shared import settle

# Names of the first board's columns in the merged table.
BOARD_A_NAMES = {"seniority": "job_level", "standardized_role": "search_role", "city": "location"}
BOARD_A_UNUSED = ["search_role", "location", "work_type", "jd_length"]


def merge(board_a: DataFrame, board_b: DataFrame) -> DataFrame:
    """Aligned columns and levels, one below the other; implausible salaries
    are missing and unstated places get the default."""
    level = rules.level_map_anchored(F.col("job_level"))
    b = columns.select_existing(board_b, vocab.ANALYSIS_COLUMNS).withColumn("job_level", level)
    if "city" in board_a.columns:
        a = columns.rename(columns.drop_ignore(board_a, *BOARD_A_UNUSED), BOARD_A_NAMES)
    else:
        # Without a city column the raw place stays.
        names = {k: v for k, v in BOARD_A_NAMES.items() if k != "city"}
        a = columns.rename(columns.drop_ignore(board_a, "search_role", "work_type", "jd_length"), names)
    both = dedup.union_by_name(b, a.withColumn("job_level", level))
    value = text.to_number(F.col("salary_avg"))
    return both.withColumns({
        "location": text.replace_value(F.col("location")),
        "salary_avg": filters.outlier_to_null(value)})


def with_features(df: DataFrame) -> DataFrame:
    """Company frequency and size band, seniority of the title."""
    sized = lookups.with_group_size(df, "company")
    return sized.withColumns({
        "company_size_proxy": rules.band(F.col("company_hiring_freq"), vocab.COMPANY_SIZE_BANDS),
        "title_seniority": rules.title_seniority(F.col("title"))})


def analysis_table(board_a: DataFrame, board_b: DataFrame,
                   spec: impute.ForestSpec = impute.ForestSpec(), keep_source: bool = False) -> DataFrame:
    """Merged postings without missing salaries, ready for the questions.

    The merged table is stored once, as several steps read it.  Features are
    added after the filling, so none of them is trained on.  ``keep_source``
    keeps the origin of each salary.
    """
    filled = impute.hybrid_impute(settle(merge(board_a, board_b)), spec)
    return columns.drop_ignore(with_features(filled), "city", *([] if keep_source else ["salary_source"]))
