"""Exact quantiles and numbering that never gather a group in one task.

``percentile`` keeps every distinct value of a group in one buffer.  Here
equal values are counted first.  Groups of many distinct values are cut into
buckets at the quantiles of a KLL sketch of them; the buckets' exact sums tell
which one holds a wanted rank, and only that bucket is sorted to read the value
off.  The sketch decides how even the buckets are, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import settle
from .skew import lookup, same

# Rows of a range; ranges are cut by a sample, so a part may be somewhat larger.
PART_ROWS = 32_768
PART = "_part"
# Buckets of a group that has more distinct values than a part, and the size of
# the sketch that cuts them: a bucket holds some thousandth of the group.
BUCKETS, SKETCH = 1024, 4096


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows of a stored table in parts ``_part`` that follow the order."""
    parts = -(-df.count() // PART_ROWS)
    if parts <= 1:
        # Always 0, but no constant: that would be optimised out of joins on the part.
        return df.withColumn(PART, F.pmod(F.xxhash64(*order), F.lit(1)).cast("int"))
    return settle(df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()))


def numbered(labels: DataFrame, name: str, out: str) -> DataFrame:
    """Numbers 0, 1, 2, ... of the rows of a stored column of distinct values, in their order."""
    placed = in_ranges(labels, [name])
    sizes = placed.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    # One row for each part.
    before = sizes.select(F.col(PART).alias("_p"), (F.sum("_n").over(Window.orderBy(PART)) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy(PART).orderBy(name)) - 1
    return (placed.withColumn("_local", local).join(before, F.col(PART) == F.col("_p"))
            .select(name, (F.col("_local") + F.col("_before")).cast("bigint").alias(out)))


def in_buckets(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The rows of a stored table in parts ``_part`` that follow the value within each group.

    Small groups are one part.  The few large ones, at most one for every
    ``PART_ROWS`` rows, are cut by their sketches; rows find their bucket by
    binary search.
    """
    sizes = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > PART_ROWS)
    if large.isEmpty():
        # Always 0, but no constant: that would be optimised out of joins on the part.
        return counts.withColumn(PART, F.pmod(F.xxhash64(value), F.lit(1)).cast("int"))
    ranks = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
    names = [f"_b_{k}" for k in keys]
    big = large.select(*[F.col(k).alias(b) for k, b in zip(keys, names)])
    chosen = counts.join(big, same(counts, big, list(zip(keys, names))), "left_semi") if keys else counts
    cuts = chosen.groupBy(*keys).agg(F.kll_sketch_agg_double(value, F.lit(SKETCH)).alias("_sketch")).select(
        *keys, F.kll_sketch_get_quantile_double("_sketch", ranks).alias("_cuts"))
    if keys:
        marked = lookup(counts, cuts, keys, sizes, null_safe=True)
    else:
        marked = counts.withColumn("_cuts", cuts.scalar())
    steps = F.array(*[F.lit(BUCKETS >> i) for i in range(1, BUCKETS.bit_length())])
    place = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get("_cuts", low + step - 1) <= F.col(value), low + step).otherwise(low))
    return marked.withColumn(PART, F.when(F.col("_cuts").isNotNull(), place).otherwise(0)).drop("_cuts")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (),
                    weight: str | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """One row per key with the linearly interpolated quantiles of ``value``.

    Nulls and NaN do not count.  ``weight`` names a column of repeat counts.
    The counts of equal values are computed and stored at once.
    """
    keys, names = list(keys), list(names or [f"q{i}" for i in range(len(probs))])
    v = F.col(value).cast("double")
    n = F.col(weight) if weight else F.lit(1)
    counts = settle(df.filter(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("_v"), n.cast("bigint").alias("_n"))
                    .groupBy(*keys, "_v").agg(F.sum("_n").alias("_n")))
    placed = in_buckets(counts, keys, "_v")

    group = Window.partitionBy(*keys)
    sums = placed.groupBy(*keys, PART).agg(F.sum("_n").alias("_sum"))
    upto = sums.withColumns({"_upto": F.sum("_sum").over(group.orderBy(PART)), "_total": F.sum("_sum").over(group)})
    wanted = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("_total") - 1)
        low = F.floor(at)
        wanted += [F.struct(F.lit(i).alias("q"), F.lit(up).alias("up"),
                            ((F.ceil(at) if up else low).cast("bigint") - (F.col("_upto") - F.col("_sum"))).alias("rank"),
                            (at - low).alias("share")) for up in (False, True)]
    # Ranks that lie in the part, counted from its begin.
    picks = upto.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col(PART).alias("_p"), F.filter(
        F.array(*wanted), lambda t: (t["rank"] >= 0) & (t["rank"] < F.col("_sum"))).alias("_wanted")).filter(F.size("_wanted") > 0)
    pairs = [(k, f"_p_{k}") for k in keys]
    held = placed.join(picks, same(placed, picks, [*pairs, (PART, "_p")]))
    held = held.withColumn("_to", F.sum("_n").over(Window.partitionBy(*keys, PART).orderBy("_v")))
    hits = F.filter("_wanted", lambda t: (t["rank"] >= F.col("_to") - F.col("_n")) & (t["rank"] < F.col("_to")))
    last = held.select(*keys, "_v", F.explode(hits).alias("_t")).select(*keys, "_v", "_t.*")

    def pick(i: int, up: bool) -> Column:
        return F.max(F.when((F.col("q") == i) & (F.col("up") == F.lit(up)), F.col("_v")))

    out = []
    for i, name in enumerate(names):
        low, high = pick(i, False), pick(i, True)
        share = F.max(F.when(F.col("q") == i, F.col("share")))
        out.append((low + (high - low) * share).alias(name))
    return last.groupBy(*keys).agg(*out)
