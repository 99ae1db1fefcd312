"""Writing postings as CSV, JSON and parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import vocab
from ..functions.text import format_list
from ..operators.columns import select_existing

BOM = "﻿"


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as list text, since CSV has no arrays."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    return df.withColumns({c: format_list(F.col(c)) for c in lists})


def write_csv(df: DataFrame, path: str, sep: str = ",", bom: bool = True, mode: str = "errorifexists") -> None:
    """All columns with a header, in UTF-8 with a byte order mark.

    The mark leads the first column's name, so every part file starts with it.
    """
    flat = _flat(df)
    if bom:
        flat = flat.withColumnRenamed(flat.columns[0], BOM + flat.columns[0])
    flat.write.mode(mode).options(header=True, sep=sep, quote='"', escape='"', emptyValue="").csv(path)


def write_projected(df: DataFrame, path: str, columns: Sequence[str] = vocab.BOARD_A_COLUMNS, **options) -> None:
    """The listed columns that exist, in order."""
    write_csv(select_existing(df, columns), path, **options)


# Columns of the narrow review file.
SLIM_COLUMNS = ["id", "title", "standardized_role", "company", "location", "seniority",
                "extracted_skills", "skills_count", "job_url"]


def write_slim(df: DataFrame, path: str, columns: Sequence[str] = SLIM_COLUMNS, **options) -> None:
    write_projected(df, path, columns, **options)


def write_records_light(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON records without the description; null fields are written."""
    df.drop("job_description").write.mode(mode).option("ignoreNullFields", False).json(path)


def write_summary(summary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The one-row summary as a JSON object."""
    summary.coalesce(1).write.mode(mode).json(path)


def write_per_key(df: DataFrame, path: str, run_id: str, key: str = "search_role",
                  mode: str = "errorifexists") -> str:
    """One folder per key below a folder named after the run."""
    target = f"{path.rstrip('/')}/run={run_id}"
    df.write.mode(mode).partitionBy(key).parquet(target)
    return target


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet, the table between the stages of a pipeline."""
    df.write.mode(mode).parquet(path)
