"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.shared import new_path

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = "\x20\x09-\x0d"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def store(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table to the shared folder, one folder for each value of ``by``, and read it back; cuts the lineage."""
    path = new_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Delete a table of ``store`` once nothing that is still to be computed reads it."""
    files = stored.inputFiles()
    if files:
        jvm = stored.sparkSession._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(stored.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def total_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def parts(total: int, each: int, least: int = 1) -> int:
    """How many parts hold a total if one holds so much; grows with the total."""
    return max(least, -(-int(total) // each))


def text_slices(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text starts (one entry more); null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, dtype="<i8")[column.offset:column.offset + len(column) + 1] if starts else np.zeros(1, "<i8")
    body = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return body[starts[0]:starts[-1]], (starts - starts[0]).astype(np.int64)


def row_ranges(starts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(first, last + 1) rows of stretches of about so many bytes; one text at least."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + limit, "right")) - 1)
        yield first, last
        first = last


def stretches(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about so many bytes each."""
    starts = text_slices(batch.column(column))[1]
    for first, last in row_ranges(starts, limit):
        yield batch.slice(first, last - first)


def mixed(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))
