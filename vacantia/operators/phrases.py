"""Lexicons and ordered rules that are tables, of any size.

A list in a plan grows the plan; a table is joined.  A text is cut into words
and what stands between them.  Its windows of as many words as some phrase has
are joined with the phrases by their words, and the symbols that a phrase
begins or ends with are compared with what stands around the window.  So every
phrase is met by equality, never by trying each phrase on each text.  A table
of at most ``SMALL`` phrases is broadcast, so that only what is found leaves
the task; with a larger one, windows that are frequent in the corpus are
answered from a broadcast and all others are exchanged.

A phrase stands in a text as in ``skills.whole_words``: as whole words, with
the characters between them as written; a boundary next to a symbol needs a
word character on the other side.  Texts and phrases are lower-cased.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.skills import TOKEN, W
from ..shared import settle
from .skew import key_counts, lookup

#: Words that a phrase may have.
MOST_WORDS = 16


GAP = W.replace("[", "[^", 1) + "*"

#: Phrases and symbols of a lexicon that is broadcast: their number and their characters.
SMALL, SMALL_CHARS = 250_000, 20_000_000


def prepared(lexicon: DataFrame, phrase: str) -> DataFrame:
    """One row for each core (the phrase from its first word to its last) with its number of words and its phrases."""
    low = lexicon.select(F.lower(phrase).alias("phrase")).filter(F.col("phrase").rlike(W)).distinct()
    head, tail = F.regexp_extract("phrase", f"^{GAP}", 0), F.regexp_extract("phrase", f"{GAP}$", 0)
    cut = low.select("phrase", head.alias("head"), tail.alias("tail"))
    core = F.substr("phrase", F.length("head") + 1, F.length("phrase") - F.length("head") - F.length("tail"))
    # A core has as many phrases as there are symbols around it.
    return (cut.withColumn("core", core).groupBy("core").agg(F.collect_list(F.struct("head", "tail", "phrase")).alias("phrases"))
            .withColumn("words", F.size(F.regexp_extract_all("core", F.lit(TOKEN), F.lit(0)))))


def windows(df: DataFrame, keys: Sequence[str], text: str, sizes: Sequence[int]) -> DataFrame:
    """(keys, core, before, after) of each text's windows of so many words.

    ``before`` and ``after`` are what stands between the window and the
    neighbouring word; null without one.
    """
    low = df.select(*keys, F.lower(text).alias("_low"))
    # Word i stands between the gaps i and i + 1.
    cut = low.select(*keys, F.regexp_extract_all("_low", F.lit(TOKEN), F.lit(0)).alias("_words"), F.split("_low", TOKEN).alias("_gaps"))
    at = cut.select("*", F.explode(F.when(F.size("_words") > 0, F.sequence(F.lit(0), F.size("_words") - 1))).alias("_i"))
    # Words and gaps are read where they are; only the window is copied.
    each = at.select("*", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("_size")).filter(F.col("_i") + F.col("_size") <= F.size("_words"))
    core = F.lit(None).cast("string")
    for size in sizes:
        parts = [F.get("_words", F.col("_i"))]
        for k in range(1, size):
            parts += [F.get("_gaps", F.col("_i") + k), F.get("_words", F.col("_i") + k)]
        core = F.when(F.col("_size") == size, F.concat(*parts)).otherwise(core)
    end = F.col("_i") + F.col("_size")
    return each.select(*keys, core.alias("core"), F.when(F.col("_i") > 0, F.get("_gaps", F.col("_i"))).alias("before"),
                       F.when(end < F.size("_words"), F.get("_gaps", end)).alias("after"))


def phrases_in(df: DataFrame, keys: Sequence[str], text: str, lexicon: DataFrame, phrase: str) -> DataFrame:
    """Distinct (keys, phrase) of all phrases of the lexicon that stand in the texts.

    Rows of equal keys count as one.  Null texts and phrases, and phrases
    without a word, find nothing.
    """
    keys = list(keys)
    table = settle(prepared(lexicon, phrase))
    n, chars = table.agg(F.coalesce(F.sum(F.size("phrases")), F.lit(0)), F.coalesce(
        F.sum(F.length("core") + F.aggregate("phrases", F.lit(0), lambda m, p: m + F.length(p["phrase"]) * 2)), F.lit(0))).first()
    sizes = sorted(r[0] for r in table.select("words").distinct().limit(MOST_WORDS + 1).collect())
    if not sizes:
        return df.select(*keys, F.lit(None).cast("string").alias("phrase")).limit(0)
    if len(sizes) > MOST_WORDS or sizes[-1] > MOST_WORDS:
        raise ValueError(f"a phrase may have {MOST_WORDS} words")
    placed = windows(df, keys, text, sizes)
    known = table.select("core", "phrases")
    if n <= SMALL and chars <= SMALL_CHARS:
        found = placed.join(F.broadcast(known), "core")
    else:
        found = lookup(placed, known, ["core"], key_counts(placed, ["core"])).filter("phrases IS NOT NULL")
    fits = F.filter("phrases", lambda p: ((p["head"] == "") | F.coalesce(p["head"] == F.col("before"), F.lit(False))) & (
        (p["tail"] == "") | F.coalesce(p["tail"] == F.col("after"), F.lit(False))))
    return found.select(*keys, F.explode(fits).alias("_p")).select(*keys, F.col("_p.phrase").alias("phrase")).distinct()


def with_phrases(df: DataFrame, keys: Sequence[str], text: str, lexicon: DataFrame, phrase: str, out: str = "found") -> DataFrame:
    """(keys, out): the sorted phrases of each row's text, ``[]`` without any."""
    keys = list(keys)
    found = phrases_in(df, keys, text, lexicon, phrase).groupBy(*keys).agg(F.sort_array(F.collect_set("phrase")).alias(out))
    rows = df.select(*keys).distinct()
    return lookup(rows, found, keys, null_safe=True).withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def first_rule(df: DataFrame, keys: Sequence[str], text: str, rules: DataFrame, phrase: str, label: str, number: str,
               default: str | None = None, out: str = "label") -> DataFrame:
    """(keys, out): the label of the rule with the least number whose phrase stands in the text, else ``default``.

    Several rules may have one phrase, and one label many phrases; of equal
    numbers the least label counts.
    """
    keys = list(keys)
    best = rules.groupBy(F.lower(phrase).alias("phrase")).agg(F.min(F.struct(F.col(number).alias("number"), F.col(label).alias("label"))).alias("rule"))
    found = lookup(phrases_in(df, keys, text, rules, phrase), best, ["phrase"])
    first = found.groupBy(*keys).agg(F.min("rule").alias("rule")).select(*keys, F.col("rule.label").alias(out))
    return lookup(df.select(*keys).distinct(), first, keys, null_safe=True).withColumn(out, F.coalesce(out, F.lit(default)))
