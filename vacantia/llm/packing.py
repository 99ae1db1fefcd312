"""Best-fit packing of token sequences, planned on a histogram of lengths.

Documents become pieces of at most ``capacity`` tokens.  The plan sees only
how many pieces there are of each length (at most ``capacity`` numbers): it
runs best-fit decreasing on counts, so that one step places whole ranges of
equal pieces into ranges of equally filled sequences.  A piece then finds its
slot by its rank among the pieces of its length.

Defined cases: a null text is empty and becomes the single end token; rows
that repeat an id are documents of their own; a null id is kept; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import json
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import parts, store

END = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a tokenizer's JSON file; they are matched inside texts, too."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in found):
        raise ValueError("added tokens must be matched as they stand")
    return {t["content"]: t["id"] for t in found}


def token_encoder(path: str, pattern: str, added: dict[str, int]):
    """Byte-pair encoder of a rank file; ``added`` tokens are found in the text first."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    return partial(encoding.encode, allowed_special="all")


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full ones, only the first may be shorter."""
    first = length % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


def pieces(docs: DataFrame, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text",
           ranks: str = "byte_bpe_50k.tiktoken", tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Tokenise whole documents and cut the longer ones; one row per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        added = added_tokens(public_tokenizers.path(tokenizer))
        encode = token_encoder(public_tokenizers.path(ranks), public_tokenizers.PATTERN, added)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(body or "")
                ids.append(END)
                raw = np.array(ids, dtype="<u4").tobytes()
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    row = (key, number, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]))
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns (length, first rank, last rank + 1, sequence of the first rank,
    offset): the pieces of these ranks go to consecutive sequences, all at the
    same offset.  Sequences are numbered from 0 without gaps.  Open sequences
    are kept as ranges by the room that is left, at most one entry per step.
    """
    open_ranges: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    slots: list[tuple[int, int, int, int, int]] = []
    fresh = 0

    def keep(room: int, low: int, high: int) -> None:
        if room and high > low:
            if room not in open_ranges:
                bisect.insort(rooms, room)
                open_ranges[room] = []
            open_ranges[room].append((low, high))

    def fill(length: int, rank: int, low: int, count: int, copies: int, room: int) -> int:
        """Put so many copies into each of count sequences from low on."""
        for copy in range(copies):
            slots.append((length, rank, rank + count, low, capacity - room + copy * length))
            rank += count
        keep(room - copies * length, low, low + count)
        return rank

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                low, high = open_ranges[room].pop()
                if not open_ranges[room]:
                    del open_ranges[room]
                    rooms.pop(at)
            else:
                room, low, high = capacity, fresh, None
            copies = room // length
            whole = left // copies if high is None else min(high - low, left // copies)
            if whole:
                rank = fill(length, rank, low, whole, copies, room)
                left -= whole * copies
                low += whole
            if left and (high is None or low < high) and left < copies:
                rank = fill(length, rank, low, 1, left, room)
                low, left = low + 1, 0
            if high is None:
                fresh = low
            else:
                keep(room, low, high)
    return slots


def ranked(rows: DataFrame, key: str, order: list[str], histogram: dict, group: int) -> DataFrame:
    """Add the rank of a row among the rows of its key, without gathering a key.

    A key's rows are dealt out by hash into as many buckets as its count asks
    for; ranks are local to the bucket, plus the sizes of the buckets before.
    """
    spark = rows.sparkSession
    sizes = spark.createDataFrame([(k, parts(n, group)) for k, n in histogram.items()], "key long, buckets long")
    rows = (rows.join(F.broadcast(sizes), rows[key] == F.col("key"))
            .withColumn("bucket", F.pmod(F.xxhash64(*order), "buckets")).drop("key", "buckets"))
    counts = rows.groupBy(key, "bucket").agg(F.count("*").alias("n"))
    before = counts.select(
        key, "bucket", (F.sum("n").over(Window.partitionBy(key).orderBy("bucket")) - F.col("n")).alias("before"))
    local = F.row_number().over(Window.partitionBy(key, "bucket").orderBy(*order)) - 1
    return (rows.withColumn("local", local).join(before, [key, "bucket"])
            .withColumn("rank", F.col("local") + F.col("before")).drop("local", "before", "bucket"))


def best_fit_pack(docs: DataFrame, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text",
                  group: int = 100_000) -> DataFrame:
    """Pack all documents into as few sequences as best-fit decreasing needs.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    ``group`` is the number of pieces of one length that one task ranks.
    """
    spark = docs.sparkSession
    rows = store(pieces(docs, capacity, doc_id, text), "pieces")
    # At most ``capacity`` rows, whatever the number of documents.
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    # The plan is bounded by the capacity as well, so it may be broadcast.
    slots = spark.createDataFrame(plan(histogram, capacity), "len long, low long, high long, seq long, offset long")
    placed = ranked(rows, "length", ["doc_id", "piece", "ids_crc32"], histogram, group).join(
        F.broadcast(slots), (F.col("length") == F.col("len")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("seq") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset")
