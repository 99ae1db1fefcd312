"""TF-IDF role similarity and cosine of vectors as column expressions.

The weighting is that of one corpus per title: the role documents plus the
title itself.  The role side is a constant, so each title's score needs only
the counts of its own terms and a look-up of the terms it shares with a role.
No title is ever compared with another, and nothing is shuffled.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab
from .rules import role_by_keyword

WORD = r"(?U)\b\w\w+\b"


def _terms(text: str) -> list[str]:
    words = re.findall(r"\b\w\w+\b", text.lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def role_term_counts(rules=None) -> list[tuple[str, Counter]]:
    """Terms (one and two words) of each role's joined keywords."""
    return [(role, Counter(_terms(" ".join(words)))) for role, words in rules or vocab.ROLE_KEYWORDS]


def title_words(title: Column) -> Column:
    return F.regexp_extract_all(F.lower(title), F.lit(WORD), F.lit(0))


def terms_of(words: Column) -> Column:
    """One- and two-word terms of a title's words, repeats kept."""
    pairs = F.when(
        F.size(words) > 1,
        F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1),
                   F.slice(words, F.lit(2), F.size(words) - 1),
                   lambda a, b: F.concat_ws(" ", a, b)))
    return F.concat(words, F.coalesce(pairs, F.array().cast("array<string>")))


def with_role_scores(df: DataFrame, title: str, out: str, rules=None) -> DataFrame:
    """Add an array of cosines of the title with every role, in rule order."""
    docs = role_term_counts(rules)
    n_docs, k = len(docs) + 1, len(docs)
    df_of = Counter(t for _, counts in docs for t in counts)

    def weight(d: int) -> float:
        return (math.log((1 + n_docs) / (1 + d)) + 1) ** 2

    # Per known term: weight, then per role the factor of the dot product,
    # then per role what the role's squared norm gains when the title has it.
    # Terms of the title raise the document frequency by one.
    entries = {}
    for term in sorted(df_of):
        w, base = weight(df_of[term] + 1), weight(df_of[term])
        dots = [counts[term] * w for _, counts in docs]
        gains = [counts[term] ** 2 * (w - base) for _, counts in docs]
        entries[term] = [w, *dots, *gains]
    # A constant that folds into one literal.
    table = F.from_json(F.lit(json.dumps(entries)), "map<string, array<double>>")
    other = weight(1)
    norms = [float(sum(c * c * weight(df_of[t]) for t, c in counts.items())) for _, counts in docs]
    terms, distinct = F.col("_terms"), F.col("_distinct")

    def times(term: Column) -> Column:
        """How often the title has the term; mostly every term is there once."""
        return F.when(F.size(terms) == F.size(distinct), F.lit(1.0)).otherwise(
            F.size(F.filter(terms, lambda t: t == term)).cast("double"))

    def counted(term: Column) -> Column:
        return F.struct(times(term).alias("q"), F.try_element_at(table, term).alias("entry"))

    def add(total: Column, hit: Column) -> Column:
        q = hit["q"]
        # A term no role has only adds its square to the title's length.
        known = F.transform(
            hit["entry"],
            lambda v, i: F.get(total, i) + v * F.when(i == 0, q * q).when(i <= k, q).otherwise(F.lit(1.0)))
        unknown = F.transform(total, lambda v, i: F.when(i == 0, v + q * q * other).otherwise(v))
        return F.when(hit["entry"].isNull(), unknown).otherwise(known)

    def score(i: int) -> Column:
        dot, gain = F.get("_sums", F.lit(1 + i)), F.get("_sums", F.lit(1 + k + i))
        length = F.sqrt(F.get("_sums", F.lit(0)) * (F.lit(norms[i]) + gain))
        return F.coalesce(F.try_divide(dot, length), F.lit(0.0))

    # Each stage is a column of its own, so that it is computed once per row.
    zeros = F.array(*[F.lit(0.0)] * (2 * k + 1))
    return (df.withColumn("_words", title_words(F.col(title)))
            .withColumn("_terms", terms_of(F.col("_words")))
            .withColumn("_distinct", F.array_distinct("_terms"))
            .withColumn("_hits", F.transform("_distinct", counted))
            .withColumn("_sums", F.aggregate("_hits", zeros, add))
            .withColumn(out, F.array(*[score(i) for i in range(k)]))
            .drop("_words", "_terms", "_distinct", "_hits", "_sums"))


def with_role_by_similarity(df: DataFrame, title: str, out: str = "similar_role",
                            score: str = "similarity", rules=None,
                            floor: float = vocab.ROLE_SIMILARITY_FLOOR,
                            default: str = vocab.OTHER_ROLE) -> DataFrame:
    """Add the nearest role (first of equals) and its score."""
    rules = rules or vocab.ROLE_KEYWORDS
    names = F.array(*[F.lit(r) for r, _ in rules])
    at = F.array_position("_scores", F.col(score)).cast("int")
    return (with_role_scores(df, title, "_scores", rules)
            .withColumn(score, F.array_max("_scores"))
            .withColumn(out, F.when(F.col(score) >= floor, F.get(names, at - 1))
                        .otherwise(F.lit(default)))
            .drop("_scores"))


def with_standard_role(df: DataFrame, title: str, out: str = "standardized_role",
                       rules=None, floor: float = vocab.ROLE_SIMILARITY_FLOOR,
                       default: str = vocab.OTHER_ROLE) -> DataFrame:
    """Role by keyword; only titles without a keyword are scored."""
    rules = rules or vocab.ROLE_KEYWORDS
    by_word = df.withColumn("_by_word", role_by_keyword(F.col(title), rules))
    open_title = by_word.withColumn("_open", F.when(F.col("_by_word").isNull(), F.col(title)))
    scored = with_role_by_similarity(open_title, "_open", "_near", "_score", rules, floor, default)
    return (scored.withColumn(out, F.coalesce("_by_word", "_near"))
            .drop("_by_word", "_open", "_near", "_score"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays; null if one has no length."""
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(df: DataFrame, vector: str, query: Column, n: int,
            tie_break: Sequence[str], out: str = "similarity") -> DataFrame:
    """The ``n`` rows most similar to one query vector."""
    return (df.withColumn("_query", query)
            .withColumn(out, cosine(F.col(vector), F.col("_query"))).drop("_query")
            .orderBy(F.desc_nulls_last(out), *tie_break).limit(n))
