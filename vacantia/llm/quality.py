"""Quality classifier without labels: a label model and a hashed scorer.

Heuristic labellers vote good, bad or nothing on each text; their votes
overlap and disagree.  Expectation-maximisation over the counts of vote
patterns, of all documents, estimates how often each labeller is right, and
with that the probability that a text of a pattern is good.  These
probabilities are the labels of a linear scorer on hashed byte n-grams, which
judges every text.

Only the vote patterns come to the driver, at most 3 to the power of the
labellers.  The scorer is fitted on a bounded sample (``sample_rows``, the
least hashes of the ids); patterns, accuracies and scores cover all rows.

Defined cases: a null text is empty; an empty text gets no votes and the
scorer's prior; rows that repeat an id are judged each for itself; an empty
table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import row_ranges, text_slices

NONE, GOOD, BAD = 0, 1, 2
#: (name, good up to, bad from): the feature of a text, in between no vote.
#: Every defect is seen by several labellers; only such overlap tells how good each is.
LABELLERS = [
    ("symbols per word", 0.05, 0.25),
    ("bars per word", 0.02, 0.20),
    ("words with marks", 0.05, 0.30),
    ("marks per byte", 0.01, 0.05),
    ("exclamations per word", 0.05, 0.30),
    ("capitals per letter", 0.15, 0.40),
    ("repeats of the word before", 0.02, 0.20),
    ("repeated lines", 0.05, 0.40),
    ("words used before", 0.60, 0.85),
    ("pairs of words used before", 0.35, 0.60),
]
UPPER, LETTERS, SYMBOLS, EXCLAMATIONS, BARS, MARKS = range(6)
CLASSES = np.zeros((256, 6))
CLASSES[65:91, UPPER] = 1
CLASSES[65:91, LETTERS] = CLASSES[97:123, LETTERS] = CLASSES[128:, LETTERS] = 1
CLASSES[np.frombuffer(b"#*$%&<>", np.uint8), SYMBOLS] = 1
CLASSES[ord("!"), EXCLAMATIONS] = CLASSES[ord("|"), BARS] = 1
CLASSES[np.frombuffer(b"#*$%&<>|!~^", np.uint8), MARKS] = 1
#: Words without such marks, but for a single one of exclamation at the end; numbers and addresses are plain.
PLAIN = re.compile(rb"(?<!\S)[^\s#*$%&<>|!~^]+!?(?!\S)")
FALSE_ALARM = 0.002
GRAM = 4
BUCKET_BITS = 16
#: N-grams of a text count against so many unseen ones of weight zero.
SHRINK = 64.0


def votes(body: bytes, data: np.ndarray) -> int:
    """The vote pattern of one text, as a number to base three."""
    words = body.split()
    n = len(words)
    if not n:
        return 0
    count = np.bincount(data, minlength=256) @ CLASSES
    lines = [x for x in body.split(b"\n") if x.strip()]
    values = (
        count[SYMBOLS] / n,
        count[BARS] / n,
        1 - len(PLAIN.findall(body)) / n if n >= 5 else None,
        count[MARKS] / len(data),
        count[EXCLAMATIONS] / n,
        count[UPPER] / count[LETTERS] if count[LETTERS] >= 30 else None,
        sum(map(eq, words, words[1:])) / n if n >= 10 else None,
        1 - len(set(lines)) / len(lines) if len(lines) >= 4 else None,
        _used_before(words) if n >= 20 else None,
        _used_before(list(zip(words, words[1:]))) if n >= 20 else None,
    )
    pattern = 0
    for value, (_, good, bad) in zip(values, LABELLERS):
        pattern = 3 * pattern + (NONE if value is None else GOOD if value <= good else BAD if value >= bad else NONE)
    return pattern


def _used_before(words: list, part: int = 1000) -> float:
    """Share of entries that occurred before in the same part of the text."""
    fresh = sum(len(set(words[i:i + part])) for i in range(0, len(words), part))
    return 1 - fresh / len(words)


def digits(patterns: np.ndarray) -> np.ndarray:
    """Votes (pattern, labeller) of numbered patterns."""
    n = len(LABELLERS)
    return patterns[:, None] // 3 ** np.arange(n - 1, -1, -1) % 3


@dataclass
class LabelModel:
    """Prior of good, and per class and labeller how likely it votes good if it votes."""

    prior: float
    good_vote: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability that a text of each pattern is good; no vote changes nothing."""
        vote = digits(patterns)
        logs = [np.log(p) + (vote == GOOD) @ np.log(g) + (vote == BAD) @ np.log1p(-g)
                for p, g in ((self.prior, self.good_vote[1]), (1 - self.prior, self.good_vote[0]))]
        return 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -700, 700)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> LabelModel:
    """Expectation-maximisation over vote patterns.

    Labellers look for different defects, so it starts from the belief that
    one bad vote tells more than the good votes of the others.  A labeller is
    taken to call at most ``FALSE_ALARM`` of the good texts bad, without which
    a frequent defect that only one labeller sees would pass for good.
    """
    vote = digits(patterns)
    is_good, is_bad = (vote == GOOD).astype(float), (vote == BAD).astype(float)
    good = np.where(is_bad.any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        rates = []
        for weight, (more, less) in ((counts * (1 - good), (1, 1)), (counts * good, (9, 1))):
            rates.append((weight @ is_good + more) / (weight @ (is_good + is_bad) + more + less))
        bad_class, good_class = rates
        model = LabelModel(float(np.clip((counts @ good + 1) / (counts.sum() + 2), 0.01, 0.99)),
                           np.clip([np.minimum(bad_class, good_class), np.maximum(good_class, 1 - FALSE_ALARM)], 1e-4, 1 - 1e-4))
        before, good = good, model.posterior(patterns)
        if np.abs(good - before).max() < 1e-6:
            break
    return model


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """Hash bucket of the n-gram at every byte but the last three."""
    count = max(0, len(data) - GRAM + 1)
    h = np.zeros(count, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for k in range(GRAM):
            h = h * np.uint32(0x01000193) ^ data[k:k + count]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
    return h >> np.uint32(32 - BUCKET_BITS)


@dataclass
class Scorer:
    """Weights of hashed n-grams (averaged over a text) and of the votes."""

    weights: np.ndarray
    vote_weights: np.ndarray
    bias: float

    def logits(self, data: np.ndarray, starts: np.ndarray, patterns: np.ndarray) -> np.ndarray:
        """One number per text; starts has one entry more than there are texts."""
        out = self.bias + self.vote_weights[np.arange(len(LABELLERS)), digits(patterns)].sum(axis=1)
        for first, last in row_ranges(starts, 1 << 20):
            part = data[starts[first]:starts[last]]
            running = np.concatenate([[0.0], np.cumsum(self.weights[gram_buckets(part)], dtype=np.float64)])
            begin = np.minimum(starts[first:last] - starts[first], len(running) - 1)
            end = np.clip(starts[first + 1:last + 1] - starts[first] - GRAM + 1, begin, len(running) - 1)
            out[first:last] += (running[end] - running[begin]) / (end - begin + SHRINK)
        return out


def fit_scorer(texts: list[np.ndarray], patterns: np.ndarray, labels: np.ndarray, rounds: int = 3, batch: int = 64,
               rate: float = 1.0) -> Scorer:
    """Logistic regression by AdaGrad on soft labels."""
    size, n = 1 << BUCKET_BITS, len(LABELLERS)
    weights, squares, bias = np.zeros(size), np.full(size, 1e-8), 0.0
    vote_weights, vote_squares = np.zeros((n, 3)), np.full((n, 3), 1e-8)
    vote, order = digits(patterns), np.random.default_rng(7).permutation(len(texts))
    # Few texts are passed more often.
    rounds = min(60, max(rounds, 36_000 // max(1, len(texts))))
    for _ in range(rounds):
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            buckets = [gram_buckets(texts[i]) for i in rows]
            share = np.array([1 / (len(b) + SHRINK) for b in buckets])
            logits = bias + vote_weights[np.arange(n), vote[rows]].sum(axis=1) + share * [weights[b].sum() for b in buckets]
            error = 1 / (1 + np.exp(-np.clip(logits, -50, 50))) - labels[rows]
            gradient = np.bincount(np.concatenate(buckets), np.repeat(error * share, [len(b) for b in buckets]), minlength=size)
            squares += gradient ** 2
            weights -= rate * gradient / np.sqrt(squares)
            vote_gradient = np.stack([error @ (vote[rows] == v) for v in range(3)], axis=1)
            # A labeller that gives no vote says nothing.
            vote_gradient[:, NONE] = 0
            vote_squares += vote_gradient ** 2
            vote_weights -= 0.1 * rate * vote_gradient / np.sqrt(vote_squares)
            bias -= 0.05 * error.mean()
    return Scorer(weights.astype(np.float32), vote_weights, float(bias))


@dataclass
class Classifier:
    labels: LabelModel
    scorer: Scorer


def pattern_column(text: Column) -> Column:
    @arrow_udf("int")
    def found(column: pa.Array) -> pa.Array:
        data, starts = text_slices(column)
        raw = data.tobytes()
        return pa.array([votes(raw[a:b], data[a:b]) for a, b in zip(starts.tolist(), starts[1:].tolist())], pa.int32())
    return found(text)


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = 12_000) -> Classifier:
    """Label model of all rows, scorer of a bounded sample of them."""
    rows = docs.select(pattern_column(F.col(text)).alias("pattern"))
    counts = {r["pattern"]: r["count"] for r in rows.groupBy("pattern").count().collect()}
    if not counts:
        return Classifier(LabelModel(0.5, np.full((2, len(LABELLERS)), 0.5)), Scorer(np.zeros(1 << BUCKET_BITS, np.float32), np.zeros((len(LABELLERS), 3)), 0.0))
    patterns = np.array(sorted(counts))
    model = fit_labels(patterns, np.array([counts[p] for p in patterns.tolist()], dtype=float))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, found = [], []
        for batch in batches:
            data, starts = text_slices(batch.column(0))
            texts += [data[a:b] for a, b in zip(starts, starts[1:])]
            found += batch.column(1).to_pylist()
        seen = np.array(found, dtype=np.int64)
        scorer = fit_scorer(texts, seen, model.posterior(seen))
        yield pa.RecordBatch.from_arrays(
            [pa.array([scorer.weights.tobytes()]), pa.array([scorer.vote_weights.tobytes()]), pa.array([scorer.bias])],
            ["weights", "votes", "bias"])

    # Rows below a hash limit, about ``sample_rows`` of them; the limit holds for any repeats, so one task may take them.
    limit = min(2 ** 64 - 1, 2 ** 64 * sample_rows // sum(counts.values())) - 2 ** 63
    some = docs.where(F.xxhash64(doc_id, text) <= limit).select(F.col(text).alias("text")).limit(2 * sample_rows)
    sample = some.select("text", pattern_column(F.col("text")).alias("pattern")).coalesce(1)
    fitted = sample.mapInArrow(fit, "weights binary, votes binary, bias double").first()
    return Classifier(model, Scorer(np.frombuffer(bytes(fitted["weights"]), np.float32),
                                    np.frombuffer(bytes(fitted["votes"])).reshape(-1, 3), fitted["bias"]))


def judged(text: Column, classifier: Classifier, spark) -> Column:
    """Column of struct(pattern, posterior, score); sees nothing but the text."""
    shipped = spark.sparkContext.broadcast(classifier)

    @arrow_udf("pattern int, posterior double, score double")
    def judge(column: pa.Array) -> pa.Array:
        model = shipped.value
        data, starts = text_slices(column)
        raw = data.tobytes()
        found = np.array([votes(raw[a:b], data[a:b]) for a, b in zip(starts.tolist(), starts[1:].tolist())], dtype=np.int32)
        score = 1 / (1 + np.exp(-np.clip(model.scorer.logits(data, starts, found.astype(np.int64)), -50, 50)))
        return pa.StructArray.from_arrays(
            [pa.array(found), pa.array(model.labels.posterior(found.astype(np.int64)).reshape(len(found))), pa.array(score)],
            ["pattern", "posterior", "score"])

    return judge(text)


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, pattern, posterior (label model), score (scorer), kept."""
    classifier = learn(docs, doc_id, text, **options)
    return (docs.select(F.col(doc_id).alias("doc_id"), judged(F.col(text), classifier, docs.sparkSession).alias("p"))
            .select("doc_id", "p.pattern", "p.posterior", "p.score", (F.col("p.score") >= threshold).alias("kept")))
