"""Choosing, ordering, naming and defaulting columns of loosely typed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text, vocab


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in names if c in df.columns])


def reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Listed columns first, all others after."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_ignore(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Column names stripped, lower-cased, blanks as underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def keep_raw_copy(df: DataFrame, *names: str, suffix: str = "_raw") -> DataFrame:
    return df.withColumns({c + suffix: F.col(c) for c in names})


def default_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add the column unless it exists."""
    return df if name in df.columns else df.withColumn(name, value)


def trim_strings(df: DataFrame, only: Sequence[str] | None = None, but: Sequence[str] = ()) -> DataFrame:
    """Strip white space in every string column, or in those ``only`` lists and ``but`` does not."""
    listed, left = {c.lower() for c in (df.columns if only is None else only)}, {c.lower() for c in but}
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name.lower() in listed - left]
    return df.withColumns({c: text.strip(F.col(c)) for c in names})


def replace_and_count(df: DataFrame, name: str, old: str = vocab.NOT_STATED,
                      new: str = vocab.DEFAULT_LOCATION) -> tuple[DataFrame, DataFrame]:
    """The table with ``old`` replaced, and a one-row frame of the number replaced."""
    count = df.agg(F.count_if(F.col(name) == old).alias("replaced"))
    return df.withColumn(name, text.replace_value(F.col(name), old, new)), count
