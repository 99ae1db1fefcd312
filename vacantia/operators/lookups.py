"""Look-ups of counts, support and medians per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import settle
from .quantiles import exact_quantiles
from .skew import key_counts, lookup


def with_group_size(df: DataFrame, key: str, out: str = "company_hiring_freq") -> DataFrame:
    """The number of rows that share the row's key; null for a null key."""
    counts = key_counts(df, [key])
    sizes = counts.filter(F.col(key).isNotNull()).withColumnRenamed("n", out)
    return lookup(df, sizes, [key], counts)


def _support(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows and known values per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("_known"))


def supported_keys(df: DataFrame, key: str, value: str, min_rows: int = 30) -> DataFrame:
    """Keys with at least ``min_rows`` known values."""
    return _support(df, key, value).filter((F.col("_known") >= min_rows) & F.col(key).isNotNull()).select(key)


def with_support(df: DataFrame, key: str, value: str, min_rows: int = 30,
                 out: str = "supported", base: DataFrame | None = None) -> DataFrame:
    """Flag the rows whose key has at least ``min_rows`` known values.

    ``base`` is the table to count in, if ``df`` is that table with more
    columns looked up.
    """
    stats = _support(base if base is not None else df, key, value)
    table = stats.select(key, (F.col("_known") >= min_rows).alias(out))
    return lookup(df, table, [key], stats.select(key, "n")).withColumn(out, F.coalesce(out, F.lit(False)))


def semi_min_support(df: DataFrame, key: str, value: str, min_rows: int = 30) -> DataFrame:
    """Rows whose key has at least ``min_rows`` known values."""
    return with_support(df, key, value, min_rows, "_ok").filter("_ok").drop("_ok")


def grouped_medians(df: DataFrame, value: str, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """Medians by all keys, by all but the last, ..., and over everything.

    One row per group with ``n_keys`` = number of keys in use; unused keys are
    null.  Groups with a null key are left out, as are null values.  All levels
    share one pass: equal rows are counted first and only the counts are
    expanded to the levels.  ``weight`` names a column of repeat counts.
    """
    keys = list(keys)
    known = df.filter(F.col(value).isNotNull())
    counts = known.groupBy(*keys, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    levels = []
    for depth in range(len(keys), -1, -1):
        used, usable = keys[:depth], F.lit(True)
        for k in used:
            usable = usable & F.col(k).isNotNull()
        levels.append(F.when(usable, F.struct(
            F.lit(depth).alias("n_keys"),
            *[(F.col(k) if k in used else F.lit(None).cast("string")).alias(k) for k in keys])))
    expanded = (counts
                .select(value, "_n", F.explode(F.array_compact(F.array(*levels))).alias("_g"))
                .select("_g.*", value, "_n"))
    return exact_quantiles(expanded, value, [0.5], ["n_keys", *keys], "_n", ["median"])


def median_cascade(counts: DataFrame, medians: DataFrame, keys: Sequence[str], out: str = "median") -> DataFrame:
    """Per combination of keys the median of its finest group that has one.

    ``counts`` has one row for each combination, ``medians`` is a stored result
    of ``grouped_medians``.
    """
    keys = list(keys)
    table, steps = counts, []
    for depth in range(len(keys), 0, -1):
        level = medians.filter(F.col("n_keys") == depth).select(*keys[:depth], F.col("median").alias(f"_m{depth}"))
        # Many combinations may share a coarse key.
        table = lookup(table, level, keys[:depth], key_counts(counts, keys[:depth]))
        # A median of zero counts as "not found", like an absent one.
        steps.append(F.nullif(F.col(f"_m{depth}"), F.lit(0.0)))
    overall = medians.filter(F.col("n_keys") == 0).select("median").scalar()
    return table.select(*counts.columns, F.coalesce(*steps, overall).alias(out))


def with_median_cascade(df: DataFrame, value: str, keys: Sequence[str], out: str = "median") -> DataFrame:
    """Median of the row's finest group that has one, else of a coarser one.

    Rows are counted once by keys and value; medians and the cascade of each
    combination come from those stored counts, and rows look up their
    combination.
    """
    keys = list(keys)
    cells = settle(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_cell")))
    medians = settle(grouped_medians(cells, value, keys, "_cell"))
    counts = cells.groupBy(*keys).agg(F.sum("_cell").alias("n"))
    table = settle(median_cascade(counts, medians, keys, out))
    return lookup(df, table.drop("n"), keys, table.select(*keys, "n"), null_safe=True)
