"""Exact top-k search by inner product, term at a time over all candidates.

Candidates and queries are dealt into blocks; a cell of one candidate block
and one query block is one group of a co-grouped job.  A cell turns its
candidates into postings (per dimension the rows and weights that are not
zero), and each dimension of a query scatters its weighted postings into the
query's dense score array.  A partial selection keeps the k best of the cell;
the cells of a query are merged by a grouped ranking.

Defined cases: vectors that are null or hold null or non-finite components,
and rows without an id, take no part; shorter vectors count as padded by
zeros; ties go to the smaller id; all rows of the query's own id are left out;
a repeated candidate is several candidates; equal query rows are one query,
and different vectors under one id are ranked apart; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts

LOWEST = np.iinfo(np.int64).min
#: Query rows whose score arrays are filled together, so that they stay in cache.
TOGETHER = 16


def usable(vector: Column) -> Column:
    """True for vectors whose components are all finite numbers."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def quantised(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def dense(table: pa.Table, width: int) -> np.ndarray:
    """Vectors of a table's second column as rows, padded by zeros."""
    column = table.column(1).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores; of equal ones the first positions."""
    if len(scores) <= k:
        return np.flatnonzero(scores != LOWEST)
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    ties = np.flatnonzero(scores == least)[:k - len(above)] if least != LOWEST else above[:0]
    return np.concatenate([above, ties])


def search_cell(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of one cell for each of its queries."""
    schema = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    if not queries.num_rows or not candidates.num_rows:
        return schema.empty_table()
    candidates = candidates.sort_by("vec_id")
    widths = [np.diff(t.column(1).combine_chunks().offsets.to_numpy()).max(initial=0) for t in (queries, candidates)]
    width = int(max(widths))
    asked, ids = queries.column(0).to_numpy(), candidates.column(0).to_numpy()
    keys = queries.column("query_key").to_numpy()
    weights = dense(queries, width)
    by_term = np.ascontiguousarray(dense(candidates, width).T)
    postings = [(np.flatnonzero(term), term) for term in by_term]
    out: list[list[np.ndarray]] = [[], [], [], []]
    for at in range(0, len(asked), TOGETHER):
        part = weights[at:at + TOGETHER]
        scores = np.zeros((len(part), len(ids)), dtype=np.int64)
        for d, (rows, term) in enumerate(postings):
            users = np.flatnonzero(part[:, d])
            if not len(users) or not len(rows):
                continue
            if 2 * len(rows) < len(ids):
                scores[users[:, None], rows] += part[users, d, None] * term[rows]
            else:
                scores[users] += part[users, d, None] * term
        for row, (query, key) in enumerate(zip(asked[at:at + TOGETHER], keys[at:at + TOGETHER])):
            own = scores[row]
            own[np.searchsorted(ids, query, "left"):np.searchsorted(ids, query, "right")] = LOWEST
            found = best(own, k)
            for column, values in zip(out, (np.full(len(found), query), np.full(len(found), key), ids[found], own[found])):
                column.append(values)
    return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=schema)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, scale: int = 64, vec_id: str = "vec_id",
          vector: str = "embedding", candidate_block: int = 4096, query_block: int = 16384) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best candidates."""
    def rows(df: DataFrame) -> DataFrame:
        return (df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"))
                .where(F.col("vec_id").isNotNull() & usable(F.col("v"))).select("vec_id", quantised(F.col("v"), scale).alias("v")))

    def number(i: str, n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(i)

    asked = rows(queries).distinct().withColumn("query_key", F.xxhash64("v"))
    given = rows(candidates)
    columns = parts(candidates.count(), candidate_block)
    lines = parts(queries.count(), query_block)
    left = asked.select("vec_id", "v", "query_key", F.pmod(F.xxhash64("vec_id"), F.lit(lines)).cast("int").alias("i"), number("j", columns))
    right = given.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(columns)).cast("int").alias("j"), number("i", lines))
    cells = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(
        lambda q, c: search_cell(q, c, k), "query_id long, query_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
