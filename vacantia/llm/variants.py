"""Groups of spelling variants: words one edit apart, found by asymmetric q-chunks.

Of a pair, the longer word (of equal lengths the later one) contributes two
disjoint chunks, its first and its last half; the other contributes all
positional grams of that length.  One inserted, deleted or replaced code point
touches one of the chunks at most, so the other occurs in the shorter word,
shifted by one place at most: words that share a gram within that shift are
compared in full.  Grams that no chunk can meet within the shift are not sent.

A key with very many words on it is not paired up.  Its words are joined by
what is left after one deletion instead, which two words one edit apart always
have in common and only a few hundred words at most can share.

Defined cases: null and empty texts hold no words; a null id counts as empty
text in the checksum; rows that repeat an id are counted each; words of any
length are compared as wholes; of equally frequent near words the first in
code-point order is the form; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

#: UTF-8 bytes of maximal runs of A-Z, a-z and U+00C0 to U+00FF.
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
DIVISOR = 31
#: Distinct words that a task counts before it hands them on.
HELD = 400_000
#: Words of one key above which they are joined by deletions.
CROWD = 2048
#: Doublings after which every chain of forms has ended: a step multiplies n by ten, and n is a long.
DOUBLINGS = 5


def varied(prefix: int, run: bytes) -> bytes:
    """The run, less one code point where its checksum says so; ``prefix`` is the checksum of what precedes it."""
    h = zlib.crc32(run, prefix)
    if h % DIVISOR:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 7, least_n: int = 2) -> DataFrame:
    """word and n of all distinct words of enough code points and occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not body.is_valid:
                    continue
                prefix = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(RUN.findall(body.as_buffer().to_pybytes().lower())).items():
                    if len(word) >= least_length:
                        held[varied(prefix, word)] += n
                if len(held) > HELD:
                    yield flushed()
        yield flushed()

    found = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return (found.where(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n))


def _after(word: str, other: str) -> Column:
    """``word`` takes the chunks of the pair: it is longer, or as long and later."""
    return (F.length(word) > F.length(other)) | ((F.length(word) == F.length(other)) & (F.col(word) > F.col(other)))


def chunks(words: DataFrame) -> DataFrame:
    """The two disjoint chunks of every word: word, length of the chunks' word, which chunk, its text."""
    length = F.length("word")
    half = F.floor(length / 2).cast("int")
    two = F.array(F.struct(F.lit(0).alias("part"), F.substring("word", F.lit(1), half).alias("gram")),
                  F.struct(F.lit(1).alias("part"), F.substring("word", length - half + 1, half).alias("gram")))
    return words.select("word", length.alias("length"), F.inline(two))


def grams(words: DataFrame) -> DataFrame:
    """All positional grams of every word that lie within one place of a chunk of a word as long or one longer."""
    by_length = words.select(F.col("word").alias("other"), F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("length"))
    half = F.floor(F.col("length") / 2).cast("int")
    placed = by_length.withColumn("half", half).select(
        "other", "length", "half", F.inline(F.array(F.struct(F.lit(0).alias("part"), F.lit(0).alias("place")),
                                                    F.struct(F.lit(1).alias("part"), (F.col("length") - half).alias("place")))))
    near = placed.withColumn("at", F.explode(F.sequence(F.col("place") - 1, F.col("place") + 1)))
    return near.where("at >= 0 AND at + half <= length(other)").select(
        "other", "length", "part", F.expr("substring(other, at + 1, half)").alias("gram")).distinct()


def deletions(word: str) -> Column:
    """Hashes of the word and of what is left of it after each one deletion."""
    def without(i: Column) -> Column:
        return F.xxhash64(F.concat(F.substring(F.col(word), F.lit(1), i - 1), F.substring(F.col(word), i + 1, F.length(word))))
    return F.array_distinct(F.concat(F.array(F.xxhash64(word)), F.transform(F.sequence(F.lit(1), F.length(word)), without)))


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Distinct pairs (word, other) of the words that are exactly one edit apart."""
    key = ["length", "part", "gram"]
    ours, theirs = store(chunks(words), "chunks"), store(grams(words), "grams")
    sizes = (ours.select(*key).union(theirs.select(*key)).groupBy(*key).count())
    crowded = store(sizes.where(F.col("count") > crowd).select(*key), "crowded")
    one_edit = F.levenshtein(F.col("word"), F.col("other"), 1) == 1
    plain = (ours.join(crowded, key, "left_anti").join(theirs.join(crowded, key, "left_anti"), key)
             .where(_after("word", "other") & one_edit).select("word", "other"))
    left = ours.join(crowded, key, "left_semi").select("word").distinct().withColumn("rest", F.explode(deletions("word")))
    right = theirs.join(crowded, key, "left_semi").select("other").distinct().withColumn("rest", F.explode(deletions("other")))
    rest = left.join(right, "rest").where(_after("word", "other") & one_edit).select("word", "other")
    return plain.union(rest).distinct()


def spelling_variants(words: DataFrame, factor: int = 10, crowd: int = CROWD) -> DataFrame:
    """word, form, root, n, n_near and form_n of counted words (word, n)."""
    words = store(words, "words")
    pairs = store(near_pairs(words.select("word"), crowd), "near")
    both = pairs.union(pairs.select("other", "word"))
    known = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = known.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    formed = store(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.m") >= factor * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.m")).alias("form_n"))).alias("f")), "forms")
    roots = formed.where("f IS NOT NULL").select("word", F.col("f.form").alias("root"))
    for _ in range(DOUBLINGS):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = store(roots.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
    return formed.join(roots, "word", "left").select(
        "word", F.col("f.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("f.form_n").alias("form_n"))
