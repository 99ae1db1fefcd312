"""The commonest values, without shuffling all distinct values.

Rows are first counted by a hash of their value into a fixed number of
buckets; a value is no more frequent than its bucket.  The values of the
fullest buckets are counted one by one: the n-th count among them is a
threshold that the n-th of all values cannot be below.  Then values are counted
exactly in just the buckets that reach the threshold.  So the result is exact,
ties included, and what is shuffled follows the number of buckets where some
values stand out.  Where none does (all values about equally frequent) every
bucket reaches the threshold and all values are counted, as by a plain count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import settle
from .ranking import top_per_group

#: Buckets of each group; their totals are what is stored and broadcast.
BUCKETS = 65_536


def top_counts(df: DataFrame, key: str, n: int, by: Sequence[str] = (), buckets: int = BUCKETS, count: str = "n",
               rank: str | None = None) -> DataFrame:
    """The ``n`` commonest values of ``key`` in each group of ``by`` with their counts, ties by value.

    Null values and null groups are left out.  ``by`` should hold labels: each
    group has its own ``buckets``.  ``rank`` names a column for the position.
    """
    by = list(by)
    rows = df.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col(key).alias("_value")).dropna()
    groups = [f"_g{i}" for i in range(len(by))]
    bucket = F.pmod(F.xxhash64("_value"), F.lit(buckets)).cast("int")
    hashed = rows.withColumn("_bucket", bucket)
    totals = settle(hashed.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_total")))

    def counted(some: DataFrame) -> DataFrame:
        return (hashed.join(some, [*groups, "_bucket"], "left_semi").groupBy(*groups, "_value")
                .agg(F.count(F.lit(1)).alias("_count")))

    order = [F.desc("_count"), F.asc("_value")]
    fullest = top_per_group(totals, groups, [F.desc("_total"), F.asc("_bucket")], n).select(*groups, "_bucket")
    best = settle(top_per_group(counted(fullest), groups, order, n))
    # With fewer than n values in the fullest buckets any other value may be among the first n.
    least = best.groupBy(*groups).agg(F.when(F.count(F.lit(1)) == n, F.min("_count")).otherwise(0).alias("_least"))
    if groups:
        open_buckets = totals.join(least, groups).filter(F.col("_total") >= F.col("_least"))
    else:
        open_buckets = totals.filter(F.col("_total") >= least.scalar())
    found = top_per_group(counted(open_buckets.select(*groups, "_bucket")), groups, order, n, rank)
    return found.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], F.col("_value").alias(key), F.col("_count").alias(count),
                        *([rank] if rank else []))
