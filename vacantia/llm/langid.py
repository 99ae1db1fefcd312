"""Language identification with bit-sliced Bloom filters of n-grams.

Every language has a Bloom filter of its n-grams (five bytes of lower-cased
text, all but letters as spaces).  The filters are stored side by side: the
byte at a position holds that position's bit of eight languages, so ANDing the
bytes of an n-gram's positions returns all languages that contain it at once.
A text is given to the language with the largest count of its n-grams, after
taking off what that filter's false-positive rate alone would give.

An n-gram enters a filter if it makes up at least ``rare`` of its language's
n-grams and occurs in at least ``least_docs`` of its documents, so a filter holds at most 1 / rare of them and the broadcast table
has a fixed size, whatever the corpus.

Defined cases: null text or text without a letter is ``und`` with score 0;
text shorter than an n-gram is padded by spaces; a null language is not
learned; equal counts go to the language first in the alphabet; nothing
learned makes every text ``und``; rows that repeat an id are judged each for
itself; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import mixed, remainder, store, stretches

SIZE = 5
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: ASCII bytes other than letters become spaces; other bytes belong to letters or marks.
KEEP = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
BLANK = int.from_bytes(b" " * SIZE, "big")


@dataclass
class Filters:
    """Bit-sliced filters: ``table[slot, position]`` has the bits of languages 8 slot to 8 slot + 7."""

    languages: list[str]
    table: np.ndarray
    hashes: int

    def false_rates(self) -> np.ndarray:
        """Per language: how likely an n-gram that it lacks passes all its hashes."""
        fill = [np.mean(self.table[i // 8] >> np.uint8(i % 8) & np.uint8(1)) for i in range(len(self.languages))]
        return np.array(fill) ** self.hashes


def positions(grams: np.ndarray, hashes: int, size: int) -> list[np.ndarray]:
    """Positions of each n-gram in a filter of a power-of-two size."""
    first = mixed(grams)
    step = mixed(first) | np.uint64(1)
    with np.errstate(over="ignore"):
        return [((first + np.uint64(k) * step) >> np.uint64(20)) & np.uint64(size - 1) for k in range(hashes)]


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams of the texts, and where each text's begin and end."""
    bodies = [b" " + (t or "").lower().encode().translate(KEEP) + b" " * (SIZE - 2) for t in texts]
    ends = np.cumsum([len(b) for b in bodies], dtype=np.int64)
    data = np.frombuffer(b"".join(bodies), dtype=np.uint8).astype(np.uint64)
    count = max(0, len(data) - SIZE + 1)
    grams = np.zeros(count, dtype=np.uint64)
    for k in range(SIZE):
        grams = (grams << np.uint64(8)) | data[k:k + count]
    return grams, ends - [len(b) for b in bodies], ends - SIZE + 1


def gram_counts(docs: DataFrame, texts_too: bool = False) -> DataFrame:
    """(lang, gram, n, docs) over the columns lang and text; docs is the number of texts that hold the n-gram, if asked for."""

    def texts_of(grams: np.ndarray, used: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Per distinct n-gram: how many texts hold it."""
        starts = np.zeros(len(grams), dtype=np.int32)
        np.add.at(starts, begins[begins < len(grams)], 1)
        text, grams = np.cumsum(starts, dtype=np.int32)[used], grams[used]
        order = np.argsort(grams, kind="stable")
        grams, text = grams[order], text[order]
        first = np.ones(len(grams), dtype=bool)
        first[1:] = grams[1:] != grams[:-1]
        at = np.flatnonzero(first)
        # Texts of an n-gram come in order, so each begins where its number changes.
        first[1:] |= text[1:] != text[:-1]
        return np.add.reduceat(first, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in ((x.column(0).to_pylist(), x.column(1).to_pylist())
                             for batch in batches for x in stretches(batch, 1, 4 << 20)):
            for lang in sorted(set(langs)):
                grams, begins, ends = grams_of([t for t, x in zip(texts, langs) if x == lang])
                inside = np.zeros(len(grams) + 1, dtype=np.int8)
                np.add.at(inside, begins[begins < len(grams)], 1)
                np.add.at(inside, ends[ends <= len(grams)], -1)
                used = (np.cumsum(inside[:-1]) > 0) & (grams != BLANK)
                found, n = np.unique(grams[used], return_counts=True)
                held = texts_of(grams, used, begins) if texts_too else np.ones(len(found), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n, pa.int64()), pa.array(held, pa.int64())],
                    ["lang", "gram", "n", "docs"])

    return (docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long, docs long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", size: int = 1 << 21, hashes: int = 3,
          rare: float = 1e-6, least_docs: int = 1) -> Filters:
    """Filters of the languages of the given rows.

    The table has ``size`` bytes for every eight languages; only it and one
    number per language come to the driver.
    """
    spark = docs.sparkSession
    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = store(gram_counts(known, least_docs > 1), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Filters([], np.zeros((0, size), np.uint8), hashes)
    number = spark.createDataFrame([(x, i, totals[x] * rare) for i, x in enumerate(languages)], "lang string, i int, least double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.column(0).to_numpy()
            for at in positions(batch.column(1).to_numpy().view(np.uint64), hashes, size):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((i // 8).astype(np.int32)), pa.array(at.astype(np.int32)), pa.array((1 << i % 8).astype(np.int32))],
                    ["slot", "at", "bits"])

    bits = (counts.join(F.broadcast(number), "lang").where((F.col("n") >= F.col("least")) & (F.col("docs") >= least_docs)).select("i", "gram")
            .mapInArrow(run, "slot int, at int, bits int").groupBy("slot", "at").agg(F.bit_or("bits").alias("bits")))
    table = np.zeros((-(-len(languages) // 8), size), dtype=np.uint8)
    found = bits.toArrow()
    table[found["slot"].to_numpy(), found["at"].to_numpy()] = found["bits"].to_numpy()
    return Filters(languages, table, hashes)


def decide(texts: list[str | None], filters: Filters, rates: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score (corrected share of the n-grams) of each text."""
    n = len(filters.languages)
    grams, begins, ends = grams_of(texts)
    counted = np.concatenate([[0], np.cumsum(grams != BLANK)])
    total = np.maximum(counted[ends] - counted[begins], 0)
    at = positions(grams, filters.hashes, filters.table.shape[1])
    hits = np.zeros((n, len(texts)))
    for slot in range(len(filters.table)):
        mask = filters.table[slot][at[0]]
        for p in at[1:]:
            mask &= filters.table[slot][p]
        mask[grams == BLANK] = 0
        for i in range(8 * slot, min(n, 8 * slot + 8)):
            running = np.concatenate([[0], np.cumsum(mask >> np.uint8(i % 8) & np.uint8(1), dtype=np.int64)])
            hits[i] = running[ends] - running[begins]
    share = np.zeros((n, len(texts)))
    some = total > 0
    share[:, some] = (hits[:, some] / total[some] - rates[:, None]) / (1 - rates[:, None])
    best = share.argmax(axis=0) if n else np.zeros(len(texts), int)
    known = [bool(n and some[k] and t and LETTER.search(t)) for k, t in enumerate(texts)]
    names = [filters.languages[best[k]] if ok else UNKNOWN for k, ok in enumerate(known)]
    score = np.array([min(1.0, max(0.0, share[best[k], k])) if ok else 0.0 for k, ok in enumerate(known)])
    return names, score


def predicted(text: Column, filters: Filters, spark) -> Column:
    """Column of struct(lang, score) for whole texts; sees nothing but the text."""
    shipped = spark.sparkContext.broadcast((filters, filters.false_rates()))

    @arrow_udf("lang string, score double")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        filters, rates = shipped.value
        for column in columns:
            names, scores = [], []
            for part in stretches(pa.RecordBatch.from_arrays([column], ["text"]), 0, 1 << 20):
                some, share = decide(part.column(0).to_pylist(), filters, rates)
                names += some
                scores.append(share)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["lang", "score"])

    return predict(text)


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 4) == 2


def identify(docs: DataFrame, doc_id: str = "doc_id", lang: str = "lang", text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows that are not held out."""
    filters = learn(docs.where(~held_out(F.col(doc_id))), lang, text, **options)
    return (docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"),
                        predicted(F.col(text), filters, docs.sparkSession).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))
