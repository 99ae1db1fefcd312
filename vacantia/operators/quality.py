"""Gates a cleaned table has to pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import is_blank
from .reports import other_rate


def other_share_gate(df: DataFrame, role: str, limit_pct: float = 10.0) -> DataFrame:
    """Warning flag if the catch-all role exceeds ``limit_pct`` percent."""
    return other_rate(df, role).select("other_pct", (F.col("other_pct") > limit_pct).alias("warn"))


def release_gate(df: DataFrame, role: str = "standardized_role", description: str = "job_description",
                 skills: str = "extracted_skills", min_rows: int = 1000, max_other_pct: float = 10.0,
                 other: str = vocab.OTHER_ROLE) -> DataFrame:
    """All release checks in one pass, as (check, value, threshold, passed)."""
    is_list = df.schema[skills].dataType.typeName() == "array"
    facts = df.agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.count_if(is_blank(F.col(description))).cast("double").alias("blank"),
        F.count_if(F.col(role).isNull()).cast("double").alias("no_role"),
        (F.avg(F.when(F.col(role) == other, 1.0).otherwise(0.0)) * 100).alias("other"))

    def check(name: str, value: Column, threshold: float, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), value.alias("value"),
                        F.lit(float(threshold)).alias("threshold"), passed.alias("passed"))

    listed = F.lit(1.0 if is_list else 0.0)
    return facts.select(F.inline(F.array(
        check("min_rows", F.col("rows"), min_rows, F.col("rows") >= min_rows),
        check("blank_descriptions", F.col("blank"), 0, F.col("blank") == 0),
        check("missing_roles", F.col("no_role"), 0, F.col("no_role") == 0),
        check("other_pct", F.col("other"), max_other_pct, F.coalesce(F.col("other") < max_other_pct, F.lit(False))),
        check("skills_are_lists", listed, 1, listed == 1))))
