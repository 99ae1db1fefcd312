"""An index of the keys that a collection has seen.

Keys lie in hash buckets, one file for each bucket and run, and every such file
has a Bloom filter: bits at two positions of each key's hash, kept as bitmaps
of 32,768 positions.  A batch looks up its own keys' bits first and then reads
only the files whose filter may hold one of them, so a batch of new keys reads
next to none of what was collected before, and no file is read whole for a
bucket that the batch does not hit.

The index only saves reading: what counts is the collected table.  A run's
filters are written last, and a run without them, as after a loss in between,
is not in the index; its keys are to be read from the table itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of one bitmap.
BITS = 32_768


@dataclass
class SeenKeys:
    """Keys below ``path``; ``buckets`` and ``bitmaps`` must stay the same for as long as the index lives.

    A filter of one bucket and run has ``bitmaps`` times 32,768 bits; it stays
    sharp up to about an eighth as many keys.
    """

    path: str
    buckets: int = 64
    bitmaps: int = 4

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _positions(self, key: Column) -> Column:
        """Numbers from 1 of a key's bits, from hashes that do not follow from the bucket's."""
        return F.array(*[F.pmod(F.xxhash64(F.lit(seed), key), F.lit(self.bitmaps * BITS)) + 1 for seed in (1, 2)])

    def add(self, keys: DataFrame, run: str) -> None:
        """Add a run's keys (one column; null is no key).  A repeated run replaces its own."""
        spark = keys.sparkSession
        found = keys.select(F.col(keys.columns[0]).alias("key")).filter("key is not null").distinct()
        target = f"{self.path}/keys/run={run}"
        found.withColumn("bucket", self._bucket(F.col("key"))).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
        # The written keys are read again, so that filters never lack a key of them.
        stored = spark.read.schema("key string, bucket int").parquet(target)
        position = F.explode(self._positions(F.col("key"))).alias("position")
        (stored.select("bucket", position)
         .groupBy("bucket", F.bitmap_bucket_number("position").alias("part"))
         .agg(F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bits"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/filters/run={run}"))

    def runs(self, spark: SparkSession) -> list[str]:
        """Runs whose keys and filters are stored whole."""
        found = _matching(spark, f"{self.path}/filters/run=*/_SUCCESS")
        return sorted(unquote(p.rsplit("/", 2)[1].removeprefix("run=")) for p in found)

    def places(self, keys: DataFrame, runs: Sequence[str]) -> list[str]:
        """Folders of the runs and buckets that may hold a key of ``keys``; one name for each comes to the driver."""
        if not runs:
            return []
        spark = keys.sparkSession
        filters = (spark.read.schema("bucket int, part long, bits binary, run string").option("basePath", f"{self.path}/filters")
                   .parquet(*[f"{self.path}/filters/run={r}" for r in runs]))
        return sorted(f"{self.path}/keys/run={r['run']}/bucket={r['bucket']}" for r in self._hits(keys, filters).collect())

    def _hits(self, keys: DataFrame, filters: DataFrame) -> DataFrame:
        key = F.col(keys.columns[0])
        bits = keys.filter(key.isNotNull()).select(
            self._bucket(key).alias("bucket"), F.xxhash64(key).alias("hash"), F.explode(self._positions(key)).alias("position")).distinct()
        asked = bits.select("bucket", "hash", "position", F.bitmap_bucket_number("position").alias("part"), F.bitmap_bit_position("position").cast("int").alias("at"))
        byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), F.pmod("at", F.lit(8)) + 1)) != 0
        # A key may be in a file if both of its bits are set there.
        both = (asked.join(filters, ["bucket", "part"]).filter(is_set).groupBy("run", "bucket", "hash")
                .agg(F.count(F.lit(1)).alias("n")))
        wanted = bits.groupBy("bucket", "hash").agg(F.count(F.lit(1)).alias("n"))
        return both.join(wanted, ["bucket", "hash", "n"], "left_semi").select("run", "bucket").distinct()

    def among(self, keys: DataFrame, runs: Sequence[str]) -> DataFrame | None:
        """Stored keys of the runs' files that may hold one of ``keys``; None if there is no such file."""
        places = self.places(keys, runs)
        return keys.sparkSession.read.schema("key string").option("basePath", f"{self.path}/keys").parquet(*places) if places else None


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found] if found else []


def table_runs(spark: SparkSession, target: str) -> list[str]:
    """Runs of a collected table, from its folders."""
    return sorted(unquote(p.rsplit("/", 1)[1].removeprefix("run=")) for p in _matching(spark, f"{target.rstrip('/')}/run=*"))
