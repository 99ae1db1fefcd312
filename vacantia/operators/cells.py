"""Head figures of any selection, from stored cells.

A report recounts its figures for each choice of facets.  Sums and counts of
the facets' combinations add up, so they are stored once for each; distinct
counts do not, but sets do: the distinct values of a column get dense numbers,
and a combination's values are the bits of exact bitmaps of 32,768 numbers
each.  The bitmaps of the chosen combinations are joined by "or" and counted.
A selection then reads cells only, however large the table was.

Facets are columns of labels: the cells grow with their combinations, and a
combination that holds any of a bitmap's numbers stores 4 KB for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import settle
from .filters import facets as of_facets
from .quantiles import numbered


@dataclass
class Cells:
    """What is stored for a table: a null facet is a label of its own."""

    facets: list[str]
    figures: DataFrame
    values: DataFrame
    bits: DataFrame


def build(df: DataFrame, facets: Sequence[str], distinct: Sequence[str], value: str = "salary_avg",
          skills_count: str = "skills_count") -> Cells:
    """Cells of the facets with bitmaps for the columns in ``distinct``; one pass for each of these and two for the rest.

    Null values of a column in ``distinct`` are not counted.  An empty table has no cells.
    """
    facets = list(facets)
    figures = df.groupBy(*facets).agg(F.count(F.lit(1)).alias("_n"), F.sum(skills_count).alias("_skills"), F.count(skills_count).alias("_stated"))
    values = df.filter(F.col(value).isNotNull()).groupBy(*facets, F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    bits = [_bitmaps(df, facets, name) for name in distinct]
    return Cells(facets, settle(figures), settle(values), settle(reduce(DataFrame.unionByName, bits)))


def _bitmaps(df: DataFrame, facets: list[str], name: str) -> DataFrame:
    pairs = settle(df.filter(F.col(name).isNotNull()).select(*facets, F.col(name).cast("string").alias("_label")).distinct())
    # A label meets its number once for each cell at most, so no key of this join is hot.
    coded = pairs.join(numbered(settle(pairs.select("_label").distinct()), "_label", "_code"), "_label")
    number = F.col("_code") + 1
    return (coded.groupBy(*facets, F.bitmap_bucket_number(number).alias("_part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits"))
            .withColumn("_column", F.lit(name)))


def distinct_counts(cells: Cells, name: str, chosen: Mapping[str, Sequence[str]], by: Sequence[str] = (), out: str = "n") -> DataFrame:
    """Distinct values of a column among the chosen rows, for each label of the facets in ``by``."""
    by = list(by)
    rows = of_facets(cells.bits.filter(F.col("_column") == name), chosen)
    return (rows.groupBy(*by, "_part").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_count"))
            .groupBy(*by).agg(F.coalesce(F.sum("_count"), F.lit(0)).alias(out)))


def kpi(cells: Cells, chosen: Mapping[str, Sequence[str]], low: float | None = None, high: float | None = None,
        role: str = "search_role", company: str = "company") -> DataFrame:
    """``reports.kpi`` of the rows that have the chosen facets; zero where there is nothing to average."""
    usable = of_facets(cells.values, chosen)
    if low is not None:
        usable = usable.filter(F.col("_value") >= low)
    if high is not None:
        usable = usable.filter(F.col("_value") <= high)

    def or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    paid = usable.agg(F.sum("_n").alias("n"), F.sum(F.col("_value") * F.col("_n")).alias("total"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return of_facets(cells.figures, chosen).agg(
        total.alias("total"), (F.sum("_skills") / F.sum("_stated")).alias("_mean")).select(
        "total", distinct_counts(cells, role, chosen).scalar().alias("roles"),
        or_zero(paid.select(F.col("total") / F.col("n")).scalar()).alias("mean_value"),
        distinct_counts(cells, company, chosen).scalar().alias("companies"),
        or_zero(paid.select(F.col("n") * 100.0).scalar() / F.when(F.col("total") > 0, F.col("total"))).alias("pct_value"),
        or_zero(F.col("_mean")).alias("mean_skills"))
