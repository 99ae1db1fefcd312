"""Repeats, unions and set differences of postings.

Which copy survives is always decided by an explicit order.  The filter on
row number one is applied before the shuffle too, so a group of many copies
leaves one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in one exchange: a key reaches its task with at most one row of each map task."""
    name, cols = _free(df, "_rn"), df.columns
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, rank).filter(F.col(name) == 1).select(*cols)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key; null keys are equal to one another."""
    return _one(df, keys, [F.asc(c) for c in order])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key; null keys are equal to one another."""
    return _one(df, keys, [F.desc(c) for c in order])


def dedup_key(df: DataFrame, order: Sequence[str], id_col: str = "id",
              fallback: Sequence[str] = ("title", "company")) -> DataFrame:
    """Last row per id; rows without an id, or of a table without ids, are unique by the fallback columns."""
    if id_col not in df.columns:
        return keep_last(df, list(fallback), order)
    has_id = ~text.is_blank(F.col(id_col))
    keys = {"_id": F.when(has_id, F.col(id_col))}
    for c in fallback:
        keys[f"_k_{c}"] = F.when(~has_id, F.col(c))
    return keep_last(df.withColumns({"_has": has_id, **keys}), [*keys, "_has"], order).drop("_has", *keys)


def dedup_subset(df: DataFrame, order: Sequence[str],
                 keys: Sequence[str] = ("title", "company", "location", "job_description")) -> DataFrame:
    return keep_first(df, keys, order)


def dedup_url(df: DataFrame, order: Sequence[str], url: str = "job_url") -> DataFrame:
    return keep_first(df, [url], order)


def _free(df: DataFrame, name: str = "_key") -> str:
    """A name that no column has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def drop_seen(df: DataFrame, order: Sequence[str], key: Column) -> DataFrame:
    """First row per identity key; rows without a key are all kept."""
    name = _free(df)
    keyed = df.withColumn(name, key)
    first = keep_first(keyed.filter(F.col(name).isNotNull()), [name], order)
    return first.unionByName(keyed.filter(F.col(name).isNull())).drop(name)


def drop_already_collected(df: DataFrame, seen: DataFrame, key: Column) -> DataFrame:
    """Rows whose key is not in ``seen(key)``; rows without a key are kept."""
    name = _free(df)
    keyed = df.withColumn(name, key)
    with_key, without = keyed.filter(F.col(name).isNotNull()), keyed.filter(F.col(name).isNull())
    known = seen.select(F.col(seen.columns[0]).alias(name)).filter(F.col(name).isNotNull()).distinct()
    fresh = with_key.join(known, name, "left_anti")
    return fresh.select(*df.columns).unionByName(without.select(*df.columns))


def skill_gap(df: DataFrame, role: str, skills: str, has: str, lacks: str) -> DataFrame:
    """Skills named in postings of role ``has`` and in none of role ``lacks``."""
    def of(name: str) -> DataFrame:
        return df.filter(F.col(role) == name).select(F.explode(skills).alias("skill")).distinct()

    return of(has).join(of(lacks), "skill", "left_anti").orderBy("skill")


def missing_skills(posting_skills: Column, own: Sequence[str]) -> Column:
    """Skills of a posting that a person does not have, sorted."""
    mine = F.array(*[F.lit(s) for s in own]).cast("array<string>")
    return F.sort_array(F.array_except(posting_skills, mine))
