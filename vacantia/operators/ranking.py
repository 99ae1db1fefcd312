"""Top rows per group and fixed orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import rank_in
from .skew import row_hash

# A group's candidates of so many salts at most meet in one task.
FAN_IN = 16


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int,
                  rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group in the given order.

    ``order`` should settle all ties.  Rows are dealt out over salts, as many
    as there are shuffle partitions, and each salt of a group is cut to ``n``
    rows; salts are merged sixteen at a time until the group is one.  So a
    group of any size uses all tasks, and no task sees more than 16 ``n`` rows
    of a group after the first cut.
    """
    keys, cols = list(keys), df.columns
    name = rank or "_rn"
    salts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranked = df.withColumn("_salt", F.pmod(row_hash(df), F.lit(salts)))
    while True:
        salts = -(-salts // FAN_IN) if salts > FAN_IN else 1
        cut = Window.partitionBy(*keys, "_salt").orderBy(*order)
        ranked = ranked.withColumn("_rn", F.row_number().over(cut)).filter(F.col("_rn") <= n)
        if salts == 1:
            break
        ranked = ranked.withColumn("_salt", F.pmod("_salt", F.lit(salts)))
    ranked = ranked.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= n)
    return ranked.select(*cols, name) if rank else ranked.select(*cols)


def top_by_count(df: DataFrame, key: str, n: int, count: str = "n") -> DataFrame:
    """The ``n`` commonest values, ties by value."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count))
            .orderBy(F.desc(count), key).limit(n))


def sort_by_metric(df: DataFrame, metric: str, *ties: str, ascending: bool = False) -> DataFrame:
    first = F.col(metric).asc() if ascending else F.col(metric).desc()
    return df.orderBy(first, *ties)


def sort_fixed_order(df: DataFrame, key: str, order: Sequence[str], keep_absent: bool = False,
                     fill: dict | None = None, rank: str = "position") -> DataFrame:
    """Rows of listed categories in the listed order.

    With ``keep_absent`` categories without a row appear with nulls, or with
    the values of ``fill``.
    """
    if not keep_absent:
        return (df.withColumn(rank, rank_in(F.col(key), order))
                .filter(F.col(rank).isNotNull()).orderBy(rank))
    listed = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(order)], f"{rank} int, {key} string")
    full = listed.join(df, key, "left")
    if fill:
        full = full.fillna(fill)
    return full.select(*df.columns, rank).orderBy(rank)
