"""Elements of stored pages, found by matching opening and closing tags.

A page is cut before every ``<``; one fold over the pieces keeps the stack of
open elements and notes where each wanted element begins and ends, so nested
elements of one name are told apart and the text of an element is its whole
inner text.  Void elements (``br``, ``img``, ...) never hold anything; a
closing tag closes what was left open inside; ``p``, ``li``, table cells and
the like end where the next of their kind or their container begins or ends;
what is never closed ends with the page.  Scripts, styles and comments are cut
out first.

Selectors are written as in style sheets: a name, ``#id``, ``.class``,
``[attribute]``, ``[attribute="value"]``, ``[attribute*="part"]`` and
``:not([attribute])`` in one, several of them divided by blanks (the last lies
inside the former), and alternatives divided by commas.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import HTML_NOISE, once, strip_html

# Elements without content, and elements that end where another begins.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
BLOCKS = ["address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"]
#: (opened names, names that they end, names that shield what lies outside of them)
ENDS = [
    (["li"], ["li"], ["ul", "ol", "menu"]),
    (["dt", "dd"], ["dt", "dd"], ["dl"]),
    (["option", "optgroup"], ["option"], ["select"]),
    (["tr"], ["tr"], ["table"]),
    (["td", "th"], ["td", "th"], ["tr", "table"]),
    (["thead", "tbody", "tfoot"], ["thead", "tbody", "tfoot"], ["table"]),
    (BLOCKS, ["p"], ["td", "th", "table", "button", "li", "div", "section", "article", "main", "nav"]),
]

TAG = "^</?([a-zA-Z][a-zA-Z0-9-]*)"
OPEN = "array<struct<name:string,start:int,own:bigint,within:bigint>>"


def _attribute(name: str, value: str | None, part: bool, word: bool = False) -> str:
    """Pattern of an opening tag with this attribute."""
    begin = rf"(?is)^<[^>]*\s{re.escape(name)}"
    if value is None:
        return begin + r"(?=[\s=/>])"
    value = re.escape(value)
    if word:
        return begin + rf"""\s*=\s*(?:"(?:[^">]*\s)?{value}(?:\s[^">]*)?"|'(?:[^'>]*\s)?{value}(?:\s[^'>]*)?'|{value}(?=[\s/>]))"""
    some = ('[^">]*', "[^'>]*", r"""[^\s>"']*""") if part else ("", "", "")
    return begin + rf"""\s*=\s*(?:"{some[0]}{value}{some[0]}"|'{some[1]}{value}{some[1]}'|{some[2]}{value}{some[2]}(?=[\s/>]))"""


def _matches(simple: str, tag: Column, name: Column) -> Column:
    """Does an opening tag match a selector without blanks?"""
    rest, tests = simple, []
    while rest:
        m = re.match(r"""([\w-]+|\*)|#([\w-]+)|\.([\w-]+)|:not\(\[([\w-]+)\]\)|\[([\w-]+)(?:(\*?)=["']?([^\]"']*)["']?)?\]""", rest)
        if m is None or (m[1] and rest != simple):
            raise ValueError(f"not a selector: {simple}")
        if m[1]:
            tests += [name == m[1].lower()] if m[1] != "*" else []
        elif m[2]:
            tests.append(tag.rlike(_attribute("id", m[2], False)))
        elif m[3]:
            tests.append(tag.rlike(_attribute("class", m[3], False, word=True)))
        elif m[4]:
            tests.append(~tag.rlike(_attribute(m[4], None, False)))
        else:
            tests.append(tag.rlike(_attribute(m[5], m[7], m[6] == "*")))
        rest = rest[m.end():]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _bits(conditions: Sequence[Column]) -> Column:
    """A number whose bit i tells whether condition i holds."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions)]).cast("bigint")


def _last(stack: Column, names: Sequence[str]) -> Column:
    """Place (from 1) of the topmost open element of one of the names; 0 without."""
    return F.coalesce(F.array_max(F.transform(stack, lambda e, i: F.when(e["name"].isin(*names), i + 1).otherwise(0))), F.lit(0))


def _unshielded(stack: Column, shields: Sequence[str], inner: Column) -> Column:
    """Open elements that stay if the one at place ``inner`` ends, unless a shield lies above it."""
    return F.when(inner > _last(stack, shields), inner - 1).otherwise(F.size(stack))


def _steps(selectors: Sequence[str]) -> tuple[list[str], list[list[tuple[int, ...]]]]:
    """The distinct simple selectors, and per selector the chains of their numbers."""
    simple: list[str] = []
    chains = []
    for text in selectors:
        chains.append([])
        for alternative in re.split(r",(?![^\[]*\])", text):
            parts = re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", alternative)
            if not parts:
                raise ValueError(f"not a selector: {text}")
            for p in parts:
                if p not in simple:
                    simple.append(p)
            chains[-1].append(tuple(simple.index(p) for p in parts))
    if len(simple) > 60:
        raise ValueError("too many selectors")
    return simple, chains


def _spans(pieces: Column, simple: Sequence[str]) -> Column:
    """(start, stop, own, within) of all elements that match a simple selector, in the order of their ends."""
    none = F.lit(0).cast("bigint")

    def step(state: Column, piece: Column) -> Column:
        def open_or_close(x: Column) -> Column:
            """How many open elements stay open, and what the tag opens."""
            stack, name, size = x["stack"], x["name"], F.size(x["stack"])
            ended = F.least(*[F.when(name.isin(*opened), once(_last(stack, ends), partial(_unshielded, stack, shields))).otherwise(size) for opened, ends, shields in ENDS])
            closed = once(_last(stack, [name]), lambda same: F.when(same > 0, same - 1).otherwise(size))
            return F.struct(*[x[c].alias(c) for c in ("at", "stack", "found", "name", "closing")],
                            F.when(x["closing"], closed).otherwise(ended).alias("keep"),
                            F.when(~x["closing"], _bits([_matches(s, piece, name) for s in simple])).alias("own"))

        def moved(x: Column) -> Column:
            at, stack, keep = x["at"], x["stack"], x["keep"]
            ended = F.when(keep < F.size(stack), F.filter(F.slice(stack, keep + 1, F.size(stack) - keep), lambda e: e["own"] != 0))
            spans = F.transform(ended, lambda e: F.struct(e["start"].alias("start"), at.alias("stop"), e["own"].alias("own"), e["within"].alias("within")))
            found = F.when(F.size(ended) > 0, F.concat(x["found"], spans)).otherwise(x["found"])
            around = once(F.get(stack, keep - 1), lambda e: F.coalesce(e["own"].bitwiseOR(e["within"]), none))
            entry = F.struct(x["name"].alias("name"), at.alias("start"), x["own"].alias("own"), around.alias("within"))
            left = F.slice(stack, F.lit(1), keep)
            grown = F.when(x["closing"] | x["name"].isin(*VOID), left).otherwise(F.concat(left, F.array(entry)))
            return F.struct((at + 1).alias("at"), grown.alias("stack"), found.alias("found"))

        named = F.struct(state["at"].alias("at"), state["stack"].alias("stack"), state["found"].alias("found"),
                         F.lower(F.regexp_extract(piece, TAG, 1)).alias("name"), piece.startswith("</").alias("closing"))
        return once(named, lambda x: F.when(x["name"] == "", F.struct((x["at"] + 1).alias("at"), x["stack"].alias("stack"), x["found"].alias("found")))
                    .otherwise(once(open_or_close(x), moved)))

    span = "array<struct<start:int,stop:int,own:bigint,within:bigint>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(OPEN).alias("stack"), F.array().cast(span).alias("found"))
    return F.aggregate(pieces, start, step, lambda s: F.concat(s["found"], F.transform(
        F.filter(s["stack"], lambda e: e["own"] != 0),
        lambda e: F.struct(e["start"].alias("start"), s["at"].alias("stop"), e["own"].alias("own"), e["within"].alias("within")))))


def _chosen(chains: Sequence[tuple[int, ...]], span: Column) -> Column:
    """Does an element end one of the chains, the rest of which lies around it?"""
    def has(bits: Column, i: int) -> Column:
        return bits.bitwiseAND(F.lit(1 << i)) != 0

    return reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [has(span["own"], c[-1]), *[has(span["within"], i) for i in c[:-1]]]) for c in chains])


def texts(page: Column, selectors: Sequence[str]) -> Column:
    """Per selector the inner texts of all its elements, in the order in which they begin."""
    simple, chains = _steps(selectors)

    def of(pieces: Column) -> Column:
        def inner(span: Column) -> Column:
            whole = F.array_join(F.slice(pieces, span["start"] + 1, span["stop"] - span["start"]), "")
            return strip_html(F.regexp_replace(whole, "^<[^>]*>", ""))

        def found(spans: Column) -> Column:
            ordered = F.array_sort(spans)
            return F.array(*[F.transform(F.filter(ordered, partial(_chosen, c)), inner) for c in chains])
        return once(_spans(pieces, simple), found)

    return once(F.split(F.regexp_replace(F.coalesce(page, F.lit("")), HTML_NOISE, " "), "(?=<)", -1), of)


def first_text(page: Column, selectors: Sequence[str]) -> Column:
    """Text of the first element that has any, by the first selector that finds one; else ``""``."""
    def pick(found: Column) -> Column:
        filled = F.filter(F.transform(found, lambda t: F.get(F.filter(t, lambda s: s != ""), F.lit(0))), lambda s: s.isNotNull())
        return F.coalesce(F.get(filled, F.lit(0)), F.lit(""))
    return once(texts(page, selectors), pick)


def longest_text(page: Column, selectors: Sequence[str], fallback: str, min_block: int = 50, min_joined: int = 100) -> Column:
    """Longest text over ``min_block`` characters of the first selector that finds one (the first of equals).

    Without one: the texts of the ``fallback`` elements joined by line breaks
    if that is longer than ``min_joined``, else ``""``.
    """
    def longer(best: Column, text: Column) -> Column:
        return F.when(F.length(text) > F.greatest(F.length(best), F.lit(min_block)), text).otherwise(best)

    def pick(found: Column) -> Column:
        best = F.transform(F.slice(found, 1, len(selectors)), lambda t: F.aggregate(t, F.lit(""), longer))
        joined = F.array_join(F.filter(F.get(found, F.lit(len(selectors))), lambda s: s != ""), "\n")
        return F.coalesce(F.get(F.filter(best, lambda s: s != ""), F.lit(0)), F.when(F.length(joined) > min_joined, joined), F.lit(""))
    return once(texts(page, [*selectors, fallback]), pick)
