"""Equi joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

# A key is hot if it holds at least this share of the rows, so there are never
# more than 1 / HOT_SHARE hot keys and their table is safe to broadcast.
HOT_SHARE = 0.001


def same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of column pairs."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def _renamed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_p_{c}" for c in cols})


def equals(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Plain equality of column pairs; null equals nothing."""
    return reduce(lambda a, b: a & b, [left[x] == right[y] for x, y in pairs])


def key_counts(rows: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def hot_keys(counts: DataFrame, n: str = "n") -> DataFrame:
    """Keys with at least ``HOT_SHARE`` of the rows (at most 1 / HOT_SHARE of them)."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.filter(F.col(n) >= F.lit(HOT_SHARE) * total)


def per_distinct(df: DataFrame, keys: Sequence[str], add: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``add``'s columns, computed once for each distinct combination of the keys and looked up by the rows."""
    counts = key_counts(df, keys)
    return lookup(df, add(counts.select(*keys)), keys, counts, null_safe=True)


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType)


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's content (maps cannot be hashed) and of the partition it was read in."""
    usable = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    return F.xxhash64(*usable, F.spark_partition_id())


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str],
           counts: DataFrame | None = None, null_safe: bool = False) -> DataFrame:
    """Left join of ``rows`` to a table that is unique by ``keys``.

    The table's entries of hot keys, at most 1 / HOT_SHARE rows, are
    broadcast, so rows of hot keys are answered where they are.  The join has
    the hash of the keys as a further key; rows of hot keys carry a hash of the
    whole row instead, which matches nothing and spreads them over all tasks.

    ``counts`` (keys, n) are the rows per key.  Give them when ``rows`` is the
    result of earlier look-ups, so that the chain is not computed again.
    Null keys find nothing unless ``null_safe``.
    """
    keys = list(keys)
    extra = [c for c in table.columns if c not in keys]
    equal = same if null_safe else equals
    hot = hot_keys(counts if counts is not None else key_counts(rows, keys)).select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    entries = table.select(*[F.col(c).alias(f"_e_{c}") for c in [*keys, *extra]], F.lit(True).alias("_found"))
    # Hot keys without an entry are answered too: with nothing.
    marks = F.broadcast(hot.join(entries, equal(hot, entries, [(f"_k_{k}", f"_e_{k}") for k in keys]), "left")
                        .select(*[F.col(f"_k_{k}").alias(f"_h_{k}") for k in keys],
                                *[F.col(f"_e_{c}").alias(f"_h_{c}") for c in extra], F.lit(True).alias("_hot")))
    marked = rows.join(marks, same(rows, marks, [(k, f"_h_{k}") for k in keys]), "left").select(
        *[rows[c] for c in rows.columns], *[marks[f"_h_{c}"] for c in extra], "_hot")
    # A constant for all other rows would be optimised out of the join's keys.
    left = marked.withColumn("_spread", F.when(F.col("_hot"), row_hash(rows)).otherwise(F.xxhash64(*keys)))
    right = table.select(*[F.col(c).alias(f"_t_{c}") for c in [*keys, *extra]], F.xxhash64(*keys).alias("_t_spread"))
    on = equal(left, right, [(k, f"_t_{k}") for k in keys]) & (left["_spread"] == right["_t_spread"])
    return left.join(right, on, "left").select(
        *[left[c] for c in rows.columns],
        *[F.when(left["_hot"], left[f"_h_{c}"]).otherwise(right[f"_t_{c}"]).alias(c) for c in extra])
