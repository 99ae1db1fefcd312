"""Ordered rule tables as CASE expressions, and bands."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .text import is_blank, strip


def any_of(words: Sequence[str]) -> str:
    """Pattern that matches any of the words, the longest possible first.

    Common beginnings are written once, so a search looks at every position
    of the text only briefly, however many words there are.
    """
    tails: dict[str, list[str]] = {}
    for w in words:
        if w:
            tails.setdefault(w[0], []).append(w[1:])
    arms = [re.escape(c) + any_of(t) for c, t in tails.items()]
    if not arms:
        return ""
    body = arms[0] if len(arms) == 1 and "" not in words else f"(?:{'|'.join(arms)})"
    return f"{body}?" if "" in words else body


def starting(pattern: str) -> str:
    """The pattern behind a look at the next letter, where each alternative begins with a plain one.

    A search then passes most positions of a text without trying alternatives.
    """
    arms = pattern.split("|")
    if re.search(r"[()\[\]{}]", pattern) or not all(re.match(r"[a-z0-9](?![?*])", a) for a in arms):
        return pattern
    return f"(?=[{''.join(sorted({a[0] for a in arms}))}])(?:{pattern})"


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """True if the text holds any of the words, in one pass over the text."""
    return c.rlike(any_of(words))


def first_rule(tests: Sequence[tuple[str, Column]], default: Column) -> Column:
    """Label of the first test that holds."""
    out = F.when(tests[0][1], F.lit(tests[0][0]))
    for label, test in tests[1:]:
        out = out.when(test, F.lit(label))
    return out.otherwise(default)


def classify_words(c: Column, rules: Sequence[tuple[str, Sequence[str]]],
                   default: str | None, lower_rules: bool = False) -> Column:
    """First rule with a word contained in the lower-cased text.

    Words are used as given unless ``lower_rules``: an upper-case word then
    never matches, which is what the role list relies on.
    """
    low = F.lower(c)
    tests = [(label, contains_any(low, [w.lower() if lower_rules else w for w in words]))
             for label, words in rules]
    return first_rule(tests, F.lit(default))


def classify_patterns(c: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First rule whose pattern is found in the lower-cased text."""
    low = F.lower(c)
    return first_rule([(label, low.rlike("(?U)" + starting(p))) for label, p in rules], F.lit(default))


def role_by_keyword(title: Column, rules=None, lower_rules: bool = False) -> Column:
    """Standard role by keyword, null where none matches."""
    return classify_words(title, rules or vocab.ROLE_KEYWORDS, None, lower_rules)


def role_by_pattern(term: Column, rules=None, default: str = vocab.OTHER_ROLE) -> Column:
    """Standard role of a search term; blank and unmatched give ``default``."""
    return (F.when(is_blank(term), F.lit(default))
            .otherwise(classify_patterns(term, rules or vocab.ROLE_PATTERNS, default)))


def place(location: Column, rules=None, blank: str = vocab.NOT_STATED,
          default: str = vocab.UNMAPPED_LOCATION) -> Column:
    """Province or country of a location text."""
    return (F.when(is_blank(location) | (strip(location) == blank), F.lit(blank))
            .otherwise(classify_patterns(location, rules or vocab.LOCATION_PATTERNS, default)))


def level_from_text(title: Column, description: Column, rules=None,
                    default: str = vocab.NOT_STATED) -> Column:
    """Job level from title and description."""
    text = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")))
    return classify_patterns(text, rules or vocab.LEVEL_PATTERNS, default)


def seniority(title: Column, rules=None, default: str = vocab.SENIORITY_DEFAULT) -> Column:
    """Seniority of a first-board title; no keyword gives ``default``."""
    return classify_words(title, rules or vocab.SENIORITY_WORDS, default)


def title_seniority(title: Column, rules=None, default: str = vocab.NOT_STATED) -> Column:
    """Seniority of a title in the merged table; null gives ``default``."""
    return classify_words(title, rules or vocab.TITLE_SENIORITY_WORDS, default, lower_rules=True)


def level_map_regex(level: Column, renames=None) -> Column:
    """Replace every pattern hit inside the label.

    Which patterns apply is decided on the original value.  Alternation takes
    ``Mid`` first, so ``Mid-level`` becomes ``Mid-level-level``;
    :func:`level_map_anchored` has no such surprise.
    """
    out = level
    for pattern, new in renames or vocab.LEVEL_RENAMES:
        out = F.when(level.rlike(pattern), F.regexp_replace(out, pattern, new)).otherwise(out)
    return out


def level_map_exact(level: Column, renames=None) -> Column:
    """Replace labels that equal a key; a key with ``|`` is no alternation."""
    out = level
    for key, new in reversed(renames or vocab.LEVEL_RENAMES):
        out = F.when(level == key, F.lit(new)).otherwise(out)
    return out


def level_map_anchored(level: Column, renames=None) -> Column:
    """Replace labels that one alternative matches in full."""
    out = level
    for pattern, new in reversed(renames or vocab.LEVEL_RENAMES):
        out = F.when(level.rlike(f"^(?:{pattern})$"), F.lit(new)).otherwise(out)
    return out


def band(x: Column, bands: Sequence[tuple[float, float | None, str]]) -> Column:
    """Label of the right-closed band (low, high]; without a high end all above; outside all bands null."""
    return first_rule([(label, x > low if high is None else (x > low) & (x <= high)) for low, high, label in bands],
                      F.lit(None).cast("string"))


def rank_in(c: Column, order: Sequence[str]) -> Column:
    """Position of a category in a fixed order, null if not listed."""
    return first_rule([(i, c == v) for i, v in enumerate(order)], F.lit(None).cast("int"))
