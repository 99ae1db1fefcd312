"""The nearest vectors of many queries at once, exactly.

Rows are dealt to the nearest of a few hundred sampled centres once, with their
angle to it; a cluster knows its largest angle.  A query first searches the
nearest clusters that together hold enough rows, which bounds the angle of its
last neighbour.  By the triangle inequality no row of a cluster can be nearer
than the query's angle to the centre less the cluster's largest angle, and none
nearer than the difference of both angles to the centre; clusters and rows
beyond the bound are passed over, all others are compared: queries and rows
meet in blocks of bounded size, which numpy multiplies.

Vectors that are null, have no length or hold null or non-finite components are
no neighbours and find none, nor do vectors of unlike lengths.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import once
from ..shared import settle

#: Centres at most; their table is small enough for every task.
CENTRES = 256
#: Angles are compared with this slack for rounding.
SLACK = 1e-7
#: Rows and queries of one block, about; a task holds one product of such a pair.
ROWS, QUERIES = 4096, 2048


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def unit(vector: Column) -> Column:
    """The vector in double precision with length one; null if it has none."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    wide = F.transform(vector, lambda x: x.cast("double"))
    return F.when(F.coalesce(fine, F.lit(False)), once(wide, lambda v: once(
        F.sqrt(_dot(v, v)), lambda size: F.when(size > 0, F.transform(v, lambda x: x / size)))))


def _angle(cosine: Column) -> Column:
    return F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """One row for each vector; NaN where it has another length."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.full((len(vectors), width), np.nan)
    out[sizes == width] = vectors.flatten().to_numpy()[np.repeat(sizes == width, sizes)].reshape(-1, width)
    return out


def _columns(batch: pa.Table | pa.RecordBatch, name: str, width: int) -> np.ndarray:
    column = batch.column(name)
    return _matrix(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, width)


def index(df: DataFrame, keys: Sequence[str], vector: str, centres: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Stored rows (keys, ``_unit``, ``_cluster``, ``_angle``, ``_row``) and clusters (``_cluster``, ``_centre``, ``_radius``, ``_n``).

    The centres are a sample by hash; every row is indexed.  ``_row`` numbers
    the rows in the order of their keys.
    """
    rows = df.select(*keys, unit(F.col(vector)).alias("_unit")).filter("_unit IS NOT NULL")
    wanted = centres or min(CENTRES, max(1, int(rows.count() ** 0.5)))
    sample = settle(rows.select("_unit").distinct().orderBy(F.xxhash64("_unit")).limit(wanted).select(F.monotonically_increasing_id().alias("_cluster"), "_unit"))
    # At most CENTRES vectors.
    found = sample.orderBy("_cluster").collect()
    numbers, units = [r["_cluster"] for r in found], [r["_unit"] for r in found]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widths = {w: [i for i, u in enumerate(units) if len(u) == w] for w in {len(u) for u in units}}
        for batch in batches:
            near, at = np.full(batch.num_rows, -2.0), np.zeros(batch.num_rows, np.int64)
            for w, places in widths.items():
                cosines = np.nan_to_num(_columns(batch, "_unit", w) @ np.array([units[i] for i in places]).T, nan=-2.0)
                best = cosines.argmax(1)
                value = cosines[np.arange(len(best)), best]
                at = np.where(value > near, np.array(places)[best], at)
                near = np.maximum(near, value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(numbers, np.int64)[at]), pa.array(np.arccos(np.clip(near, -1, 1)))],
                [*batch.schema.names, "_cluster", "_angle"])

    schema = rows.select("*", F.lit(0).cast("bigint").alias("_cluster"), F.lit(0.0).alias("_angle")).schema
    ordered = rows.mapInArrow(place, schema).orderBy(*keys) if found else rows.withColumns({"_cluster": F.lit(0).cast("bigint"), "_angle": F.lit(0.0)})
    placed = settle(ordered.withColumn("_row", F.monotonically_increasing_id()))
    spread = placed.groupBy("_cluster").agg(F.max("_angle").alias("_radius"), F.count(F.lit(1)).alias("_n"))
    return placed, settle(sample.withColumnRenamed("_unit", "_centre").join(spread, "_cluster"))


def _best(found: DataFrame, query: Sequence[str], keys: Sequence[str], n: int) -> DataFrame:
    order = Window.partitionBy(*query).orderBy(F.desc("similarity"), *keys)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _product(n: int):
    """Of a block of queries and one of rows: each query's first ``n`` within its bound, and how many rows were not passed over."""
    def compared(asked: pa.Table, rows: pa.Table) -> pa.Table:
        q, r = asked.column("_q").to_numpy(), rows.column("_row").to_numpy()
        sizes = asked.column("_query").combine_chunks().value_lengths().to_numpy() if len(q) else np.zeros(0, int)
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        to, bound = asked.column("_to").to_numpy(), asked.column("_bound").to_numpy()
        angle = rows.column("_angle").to_numpy()
        scanned = np.zeros(len(q), np.int64)
        for w in set(sizes.tolist()) if len(r) else ():
            some = np.flatnonzero(sizes == w)
            left, right = _columns(asked, "_query", w)[some], _columns(rows, "_unit", w)
            about = left @ right.T
            open_ = np.abs(to[some, None] - angle) <= bound[some, None] + SLACK
            scanned[some] = open_.sum(1)
            about[~open_ | np.isnan(about)] = -4.0
            # Rounding moves a product by far less.
            least = np.where(bound[some] < np.pi, np.cos(np.minimum(bound[some], np.pi)), -2.0)
            if (about >= least[:, None] - 1e-9).sum() > n * len(some) and n < len(r):
                least = np.maximum(least, np.partition(about, len(r) - n, axis=1)[:, len(r) - n])
            i, j = np.nonzero(about >= np.maximum(least, -2.0)[:, None] - 1e-9)
            exact = np.zeros(len(i))
            for d in range(w):
                exact += right[j, d] * left[i, d]
            parts.append((q[some[i]], r[j], exact))
        a, b, s = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((b, -s, a))
        a, b, s = a[order], b[order], s[order]
        first = np.arange(len(a)) - np.searchsorted(a, a) < n
        a, b, s = a[first], b[first], s[first]
        none = pa.nulls(len(q), pa.int64()), pa.nulls(len(q), pa.float64())
        return pa.table({
            "_q": pa.array(np.concatenate([a, q])), "_row": pa.chunked_array([pa.array(b), none[0]]),
            "similarity": pa.chunked_array([pa.array(s), none[1]]),
            "scanned": pa.array(np.concatenate([np.zeros(len(a), np.int64), scanned]))})

    return compared


def nearest(queries: DataFrame, query_keys: Sequence[str], query_vector: str, rows: DataFrame, clusters: DataFrame,
            keys: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """Per query its ``n`` most similar rows, and (query, scanned, rows) with the rows that were compared.

    The first has the query's and the row's keys, ``similarity`` and ``rank``;
    ties go by the row's keys, whose names must differ from the query's.
    ``rows`` and ``clusters`` are an ``index``.  Queries without a key find nothing.
    """
    query_keys, keys = list(query_keys), list(keys)
    asked = settle(queries.select(*query_keys, unit(F.col(query_vector)).alias("_query")).filter("_query IS NOT NULL")
                   .dropna(subset=query_keys).withColumn("_q", F.monotonically_increasing_id()))
    groups = max(1, -(-asked.count() // QUERIES))
    table = clusters.agg(F.collect_list(F.struct("_cluster", "_centre", "_radius", "_n"))).scalar()
    seen = asked.withColumn("_table", table).select("_q", "_query", F.explode("_table").alias("_c")).select(
        "_q", "_c._cluster", "_c._radius", "_c._n", F.coalesce(_angle(_dot(F.col("_query"), F.col("_c._centre"))), F.lit(0.0)).alias("_to"))
    seen = settle(seen.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_q").orderBy("_to", "_cluster").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    # Blocks of a cluster follow from its size; each of them meets each group of queries.
    blocks = F.ceil(F.col("_n") / ROWS).cast("int")
    group = F.pmod(F.xxhash64("_q"), F.lit(groups)).cast("int")
    dealt = (rows.join(F.broadcast(clusters.select("_cluster", blocks.alias("_blocks"))), "_cluster")
             .select("_cluster", F.pmod(F.xxhash64("_row"), F.col("_blocks")).cast("int").alias("_block"),
                     F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"), "_row", "_unit", "_angle"))
    block = ["_cluster", "_block", "_group"]

    def compared(pairs: DataFrame) -> DataFrame:
        sent = pairs.join(asked.select("_q", "_query"), "_q").select(
            "_cluster", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block"), group.alias("_group"), "_q", "_query", "_to", "_bound")
        return sent.groupBy(*block).cogroup(dealt.groupBy(*block)).applyInArrow(
            _product(n), "_q bigint, _row bigint, similarity double, scanned bigint")

    first = _best(compared(seen.filter(F.col("_before") < n).withColumn("_bound", F.lit(4.0))).filter("_row IS NOT NULL"), ["_q"], ["_row"], n)
    bound = settle(first.groupBy("_q").agg(F.when(F.count(F.lit(1)) == n, _angle(F.min("similarity"))).otherwise(F.lit(4.0)).alias("_bound")))
    left = seen.join(bound, "_q").filter(F.col("_to") - F.col("_radius") <= F.col("_bound") + SLACK)
    close = settle(compared(left))
    names = asked.select("_q", *query_keys)
    held = _best(close.filter("_row IS NOT NULL"), ["_q"], ["_row"], n).drop("rank")
    # Repeated keys of queries are one query.
    out = _best(held.join(names, "_q").join(rows.select("_row", *keys), "_row"), query_keys, keys, n)
    scanned = close.join(names, "_q").groupBy(*query_keys).agg(F.sum("scanned").alias("scanned")).withColumn("rows", clusters.agg(F.sum("_n")).scalar())
    return out.select(*query_keys, *keys, "similarity", "rank"), scanned
