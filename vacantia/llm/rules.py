"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a condition that rejects a text.  The verdict is one CASE
expression that stops at the first rule that rejects, so the order of the
rules decides the cost and never the result.  The order is found on a small
sample: rules are timed one by one, and those that reject most per second
come first.

Defined cases: a null or blank text has no words and fails the base rules;
rows that repeat an id are judged each for itself; a null id is kept; an empty
table gives an empty result and leaves the rules in the order given; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

# Fixed values of the rules: the characters of words and symbols.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
WINDOW = 5


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate a value once and use it several times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def removed(text: Column, characters: str) -> Column:
    """How many of these characters the text holds."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def covered(starts: Column) -> Column:
    """Words covered by windows at these ascending starts."""
    steps = F.transform(starts, lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1), v + WINDOW) - v))
    return F.aggregate(steps, F.lit(0), lambda a, b: a + b)


def repeats(words: Column) -> Column:
    """Words in windows that occur twice or more, the first included.

    Window hashes tell whether anything repeats at all; only then are the
    windows themselves sorted and compared with their neighbours.
    """
    at = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def hashes(h: Column) -> Column:
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WINDOW)]))

    def repeated(w: Column) -> Column:
        def starts(s: Column) -> Column:
            same = F.transform(s, lambda x, k: F.when(
                (x["w"] == F.get(s, k - 1)["w"]) | (x["w"] == F.get(s, k + 1)["w"]), x["i"]))
            return F.array_sort(F.filter(same, lambda i: i.isNotNull()))
        windows = F.transform(at, lambda i: F.struct(
            F.array_join(F.slice(w, i + 1, F.lit(WINDOW)), " ").alias("w"), i.alias("i")))
        return bind(bind(F.array_sort(windows), starts), covered)

    some = bind(F.transform(words, lambda w: F.xxhash64(w)),
                lambda h: bind(hashes(h), lambda x: F.size(F.array_distinct(x)) < F.size(x)))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(F.when(some, repeated(words)).otherwise(0))


def base_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and the base counts of every text."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD_CLASS))
    return (docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"))
            .withColumn("words", F.array_remove(F.split("text", SPACE_CLASS), ""))
            .withColumn("lines", lines)
            .select(
                "doc_id", "text",
                F.size("words").cast("long").alias("n_words"),
                (F.length("text") - removed(F.col("text"), SPACE_CHARS)).cast("long").alias("word_chars"),
                removed(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
                F.size("lines").cast("long").alias("n_lines"),
                (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                repeats(F.col("words")).cast("long").alias("n_repeat_words")))




def default_rules() -> dict[str, Column]:
    """Conditions on the columns of ``base_counts``."""
    words, chars, body = F.col("n_words"), F.col("word_chars"), F.col("text")
    return {
        "symbols": 100 * F.col("n_symbols") > 30 * words,
        "repeated_lines": (F.col("n_dup_lines") >= 3) & (100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
        "short_words": 10 * chars < 20 * words,
        "long_words": chars > 14 * words,
        "shouting": 100 * removed(body, UPPER) > 40 * chars,
        "numbers": 100 * removed(body, DIGITS) > 30 * chars,
    }


def order_rules(sample: DataFrame, rules: dict[str, Column]) -> list[str]:
    """Rule names by rejected rows per second on a stored sample.

    A rule's time is that of a pass that evaluates it alone, less that of a
    pass that only reads the rows.
    """
    def seconds(condition: Column) -> tuple[float, int]:
        began = time.perf_counter()
        n = sample.agg(F.count_if(condition)).first()[0]
        return time.perf_counter() - began, n

    blank = F.length("text") < 0
    seconds(blank)
    floor = seconds(blank)[0]
    measured = {name: seconds(rule) for name, rule in rules.items()}
    return sorted(rules, key=lambda name: -measured[name][1] / max(measured[name][0] - floor, 1e-3))


def cascade(rules: dict[str, Column], order: list[str]) -> Column:
    """Name of the first rule that rejects, or null."""
    verdict = None
    for name in order:
        hit = F.coalesce(rules[name], F.lit(False))
        verdict = F.when(hit, name) if verdict is None else verdict.when(hit, name)
    return verdict


def quality_rules(docs: DataFrame, rules: dict[str, Column] | None = None, doc_id: str = "doc_id", text: str = "text",
                  sample_rows: int = 2000) -> DataFrame:
    """Base counts, base verdict and the cascade's verdict of every text.

    The ordering looks at about ``sample_rows`` texts; every text is judged.
    Returns doc_id, text, the counts, base_failed, rejected_by, kept.
    """
    rules = default_rules() if rules is None else rules
    every = max(1, docs.count() // sample_rows)
    some = docs.select(doc_id, text).where(F.pmod(F.xxhash64(F.col(doc_id)), F.lit(every)) == 0)
    sample = store(base_counts(some, doc_id, text), "rules")
    verdict = cascade(rules, order_rules(sample, rules))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (base_counts(docs, doc_id, text)
            .withColumn("base_failed", failed)
            .withColumn("rejected_by", F.when(~F.col("base_failed"), verdict))
            .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (
  SELECT doc_id, i, array_to_string(words[i + 1:i + 5], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(0, len(words) - 4)) AS i FROM d)),
r AS (SELECT doc_id, s FROM w GROUP BY doc_id, s HAVING count(*) > 1),
c AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT w.doc_id, unnest(range(w.i, w.i + 5)) AS p FROM w JOIN r ON w.doc_id = r.doc_id AND w.s = r.s)
  GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 30 * n_words OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)
       OR 10 * word_chars < 20 * n_words OR word_chars > 14 * n_words
       OR 100 * n_upper > 40 * word_chars OR 100 * n_digits > 30 * word_chars) AS kept
FROM f
"""
