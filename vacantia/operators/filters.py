"""Row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.rules import contains_any
from .quantiles import exact_quantiles
from .ranking import top_per_group


def is_noise(title: Column, words: Sequence[str] | None = None) -> Column:
    """True if the title holds a noise phrase; false for null."""
    return F.coalesce(contains_any(F.lower(title), words or vocab.NOISE_TITLES), F.lit(False))


def in_domain(description: Column, words: Sequence[str] | None = None) -> Column:
    """True if the text holds a domain word; false for null.

    Most descriptions hold one of the first words, so a chain of tests that
    stops at the first hit is the quickest on long texts.
    """
    low = F.lower(description)
    found = reduce(lambda a, b: a | b, [low.contains(w) for w in words or vocab.DOMAIN_WORDS])
    return F.coalesce(found, F.lit(False))


def drop_noise(df: DataFrame, title: str = "title", words=None) -> DataFrame:
    return df.filter(~is_noise(F.col(title), words))


def keep_domain(df: DataFrame, description: str = "job_description", words=None) -> DataFrame:
    return df.filter(in_domain(F.col(description), words))


def stated(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def required(df: DataFrame, *names: str) -> DataFrame:
    """Rows with text in every listed column."""
    return df.filter(reduce(lambda a, b: a & b, [stated(F.col(c)) for c in names]))


def dropna_subset(df: DataFrame, *names: str) -> DataFrame:
    return df.dropna(subset=list(names))


def min_length(df: DataFrame, name: str = "job_description", n: int = 200) -> DataFrame:
    return df.filter(F.length(name) >= n)


def outlier_to_null(value: Column, low: float = vocab.SALARY_LOW,
                    high: float = vocab.SALARY_HIGH) -> Column:
    """Values outside [low, high] become missing; the row stays."""
    return F.when(value.between(low, high), value)


def facets(df: DataFrame, chosen: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows whose columns are among the chosen values; an empty choice keeps all."""
    for name, values in chosen.items():
        if values:
            df = df.filter(F.col(name).isin(*values))
    return df


def in_range(df: DataFrame, name: str, low=None, high=None) -> DataFrame:
    """Inclusive range, nulls excluded; a bound of None is open."""
    df = df.filter(F.col(name).isNotNull())
    if low is not None:
        df = df.filter(F.col(name) >= low)
    if high is not None:
        df = df.filter(F.col(name) <= high)
    return df


def facet_domain(df: DataFrame, *names: str) -> DataFrame:
    """Distinct non-null values of each column as (facet, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))
                      for c in names])
    return (df.select(F.explode(pairs).alias("_p")).select("_p.*")
            .filter(F.col("value").isNotNull()).distinct().orderBy("facet", "value"))


def facet_bounds(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.min(name).alias("low"), F.max(name).alias("high"))


def percentile_trim(df: DataFrame, name: str, p: float = 0.99) -> DataFrame:
    """Rows up to the exact, interpolated percentile."""
    limit = exact_quantiles(df, name, [p], names=["limit"]).scalar()
    return df.filter(F.col(name) <= limit)


def without_stop_skill(skills: Column, stop: str = vocab.STOP_SKILL, any_case: bool = True) -> Column:
    """The skill list without the stop word."""
    return F.filter(skills, lambda s: (F.lower(s) if any_case else s) != stop)


def cap_per_key(df: DataFrame, key: str, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    return top_per_group(df, [key], order, n)
