"""Collecting postings as files arrive: no record twice, one folder per role.

A collector has to remember the ids it has seen.  Here the collected
table itself is that memory, so nothing grows in the stream's state and a
restart knows everything collected before.  An index of its keys beside it
spares a batch from reading all of them; runs that it lacks are read from the
table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import drop_already_collected, drop_seen
from ..sources.writers import write_per_key
from .seen import SeenKeys, table_runs

KEY = "_identity"
#: Under this name a stream tells its id, which its checkpoint keeps.
QUERY_ID = "sql.streaming.queryId"


def _collected_keys(keys: DataFrame, target: str, run: str, index: SeenKeys) -> DataFrame | None:
    """Keys collected before this batch that may be among its own; a repeated batch ignores its own rows."""
    spark = keys.sparkSession
    before = [r for r in table_runs(spark, target) if r != run]
    indexed = set(index.runs(spark)).intersection(before)
    seen = index.among(keys, sorted(indexed))
    others = [f"{target}/run={r}" for r in before if r not in indexed]
    if others:
        read = spark.read.schema(f"{KEY} string").option("basePath", target).parquet(*others).select(F.col(KEY).alias("key"))
        seen = read if seen is None else seen.unionByName(read)
    return seen


def collect_batch(batch: DataFrame, epoch: int, target: str, key: Column, order: Sequence[str],
                  role: str = "search_role") -> None:
    """Write the records of a batch that were not collected before.

    A batch's folder is named after the stream and the epoch: a repeated batch
    replaces its own rows, and a stream that has lost its checkpoint and counts
    epochs from 0 again is another stream, which replaces nothing.
    """
    stream = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "batch"
    run = f"{stream}-{epoch}"
    target = target.rstrip("/")
    # Beside the table, so that readers of the table see records only.
    index = SeenKeys(f"{target}_keys")
    keyed = batch.withColumn(KEY, key)
    fresh = drop_seen(keyed, order, keyed[KEY])
    seen = _collected_keys(keyed.select(KEY), target, run, index)
    if seen is not None:
        fresh = drop_already_collected(fresh, seen, fresh[KEY])
    folder = write_per_key(fresh, target, run, role, mode="overwrite")
    index.add(batch.sparkSession.read.schema(f"{KEY} string").parquet(folder), run)


def collect(stream: DataFrame, target: str, checkpoint: str, key: Column, order: Sequence[str],
            role: str = "search_role") -> StreamingQuery:
    """Collect what has arrived since the last call and stop."""
    return (stream.writeStream
            .foreachBatch(lambda batch, epoch: collect_batch(batch, epoch, target, key, order, role))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
