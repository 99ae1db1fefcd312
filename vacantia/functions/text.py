"""Column expressions that clean text, lists, numbers, dates, URLs and HTML."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# The white space of Unicode, as ``(?U)\s`` has it.
SPACE = "".join(map(chr, [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Cut white space at both ends, no-break space included (``trim`` alone keeps it)."""
    return F.btrim(c, F.lit(SPACE))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def fill_sentinel(c: Column, sentinel: str = vocab.NOT_STATED) -> Column:
    """Null or empty becomes ``sentinel``."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(sentinel))


def replace_value(c: Column, old: str = vocab.NOT_STATED,
                  new: str = vocab.DEFAULT_LOCATION) -> Column:
    return F.when(c == old, F.lit(new)).otherwise(c)


def to_number(c: Column) -> Column:
    """Double, or null for text that is no number."""
    number = strip(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_time(c: Column) -> Column:
    """Timestamp of an ISO text, or null."""
    return F.try_to_timestamp(c)


def scale(c: Column, unit: float = 1_000_000) -> Column:
    return c / F.lit(float(unit))


def clip(c: Column, low: float = vocab.SALARY_LOW, high: float = vocab.SALARY_HIGH) -> Column:
    """Clamp to [low, high]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high))))


# Pieces of a written list: strings with their prefix, numbers, names, marks, white space, anything else.
_STRING = r"""[uUrR]?(?:'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+")"""
_NUMBER = r"[+-]?(?:\d[\d_]*(?:\.[\d_]*)?|\.\d[\d_]*)(?:[eE][+-]?\d+)?(?![\w.'\"])"
LITERAL = rf"(?s){_STRING}|{_NUMBER}|[A-Za-z_]\w*|\s+|."
WHOLE = r"^[+-]?(?:0[0_]*|[1-9]\d*(?:_\d+)*)$"
REAL = r"^[+-]?(?:\d+(?:_\d+)*)?(?:\.(?:\d+(?:_\d+)*)?)?(?:[eE][+-]?\d+)?$"
# The commonest form: strings in single quotes without escapes, prefixes or line breaks, one comma between them.
_PLAIN = r"'[^'\\\n]*+'"
PLAIN_LIST = rf"^\[(?:{_PLAIN}(?:, ?{_PLAIN})*+)?\]\z"
# What a letter after a backslash stands for.
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "v": "\v", "a": "\a", "\\": "\\", "'": "'", '"': '"', "\n": ""}
ESCAPE = r"(?s)[^\\]+|\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|.)"


def _unescaped(piece: Column) -> Column:
    """The text that a piece of a string stands for; null for a broken escape."""
    mark, digits = F.substring(piece, 2, 1), F.substr(piece, F.lit(3))
    wide = F.lpad(F.conv(F.when(mark.rlike("[0-7]"), F.conv(F.substr(piece, F.lit(2)), 8, 16)).otherwise(digits), 16, 16), 8, "0")
    out = F.when(~piece.startswith("\\"), piece)
    for letter, text in ESCAPES.items():
        out = out.when(mark == letter, F.lit(text))
    out = out.when(mark.isin("x", "u", "U") & (F.length(piece) == 2), F.lit(None).cast("string"))
    return out.when(mark.rlike("[xuU0-7]"), F.decode(F.unhex(wide), "UTF-32")).otherwise(piece)


def _string(token: Column) -> Column:
    """The text that a written string stands for; null if an escape in it is broken."""
    raw = token.rlike("^[rR]")
    body = F.regexp_replace(token, r"(?s)^[uUrR]?['\"]|['\"]$", "")

    def joined(pieces: Column) -> Column:
        return F.when(~F.exists(pieces, lambda x: x.isNull()), F.array_join(pieces, ""))
    return F.when(raw | ~token.contains("\\"), body).otherwise(
        once(F.transform(F.regexp_extract_all(body, F.lit(ESCAPE), F.lit(0)), _unescaped), joined))


def _kind(token: Column) -> Column:
    """s for a string, n for a number or name that is a value, the mark itself, x for what no list may hold."""
    number = token.rlike(WHOLE) | (token.rlike(REAL) & token.rlike(r"[\d]") & token.rlike("[.eE]"))
    return (F.when(token.rlike(f"(?s)^{_STRING}$"), "s").when(token.isin("[", "]", "(", ")", ","), token)
            .when(token.isin("None", "True", "False") | number, "n").otherwise("x"))


def _value(token: Column, kind: Column) -> Column:
    bare = F.regexp_replace(token, "[_+]", "")
    return (F.when(kind == "s", _string(token)).when(token.isin("True", "False"), token)
            .when(token.rlike(WHOLE), F.regexp_replace(bare, "^-?0+$", "0"))
            .when((kind == "n") & (token != "None"), F.regexp_replace(token, "_", "").try_cast("double").cast("string")))


def parse_list(c: Column) -> Column:
    """A list or tuple as it is written in source text to an array; anything else to ``[]``.

    Items are strings (either quote, escapes, ``r`` and ``u`` prefixes,
    neighbours joined), decimal numbers, ``True`` and ``False`` as texts, and ``None``
    as null; a comma may trail.  Nested lists, other names and broken text
    make the whole value ``[]``.  Lists of plain strings only are read by two
    patterns, without looking at kinds of tokens.
    """
    empty = F.array().cast("array<string>")
    is_value = lambda x: x["kind"].isin("s", "n")

    def plain(values: Column) -> Column:
        return F.transform(F.filter(values, is_value), lambda x: x["value"])

    def joined(values: Column) -> Column:
        """Neighbouring strings are one."""
        def add(state: Column, x: Column) -> Column:
            items = state["items"]
            last = F.concat(F.slice(items, F.lit(1), F.size(items) - 1), F.array(F.concat(F.element_at(items, -1), x["value"])))
            more = F.when(~is_value(x), items).when((x["kind"] == "s") & (state["before"] == "s"), last).otherwise(F.concat(items, F.array(x["value"])))
            return F.struct(more.alias("items"), x["kind"].alias("before"))
        return F.aggregate(values, F.struct(empty.alias("items"), F.lit("").alias("before")), add, lambda s: s["items"])

    def read(values: Column) -> Column:
        kinds = F.array_join(F.transform(values, lambda x: x["kind"]), "")
        whole = F.regexp_replace(kinds, "s+|n", "e")
        fits = whole.rlike(r"^\[(?:e,)*+e?\]$") | whole.rlike(r"^\((?:(?:e,)++e?)?\)$") | whole.rlike(r"^(?:e,)++e?$")
        broken = F.exists(values, lambda x: (x["kind"] == "s") & x["value"].isNull())
        return F.when(fits & ~broken, F.when(kinds.contains("ss"), joined(values)).otherwise(plain(values))).otherwise(empty)

    tokens = F.filter(F.regexp_extract_all(c, F.lit(LITERAL), F.lit(0)), lambda t: ~t.rlike(r"^\s+$"))
    kinds = F.transform(tokens, lambda t: F.struct(_kind(t).alias("kind"), t.alias("token")))
    values = F.transform(kinds, lambda x: F.struct(x["kind"].alias("kind"), _value(x["token"], x["kind"]).alias("value")))
    plainly = F.regexp_extract_all(c, F.lit(r"'([^'\\\n]*+)'"), F.lit(1))
    return F.coalesce(F.when(c.rlike(PLAIN_LIST), plainly).otherwise(once(values, read)), empty)


def parse_list_lenient(c: Column) -> Column:
    """Drop brackets and quotes, split at commas, trim, drop empties."""
    bare = F.regexp_replace(F.regexp_replace(c, r"^[\[\]]+|[\[\]]+$", ""), "['\"]", "")
    parts = F.filter(F.transform(F.split(bare, ","), strip), lambda s: s != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def format_list(c: Column) -> Column:
    """Array to the list text that :func:`parse_list` reads back."""
    quoted = F.transform(c, lambda s: F.concat(
        F.lit("'"), F.when(s.contains("'") | s.contains("\\"), F.regexp_replace(s, r"(['\\])", r"\\$1")).otherwise(s), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def city(location: Column) -> Column:
    """Text before the first comma."""
    return strip(F.substring_index(location, ",", 1))


# Work modes that boards put in parentheses after the place.
WORK_TYPES = [
    ("On-site", r"on.?site|di lokasi"),
    ("Remote", r"remote|jarak jauh"),
    ("Hybrid", r"hybrid|hibrid"),
]


def work_type(location: Column) -> Column:
    """On-site / Remote / Hybrid from the parenthesised part, else Unknown."""
    inner = F.regexp_extract(F.lower(location), r"\(([^)]*)\)", 1)
    out = F.lit("Unknown")
    for label, pattern in reversed(WORK_TYPES):
        out = F.when(inner.rlike(pattern), F.lit(label)).otherwise(out)
    return out


# Script, style and comment first: their text is not content.
HTML_NOISE = (r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->")
HTML_TAG = r"(?s)<[^>]+>"


def strip_html(c: Column) -> Column:
    """Text without markup, white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(c, HTML_NOISE, " "), HTML_TAG, " ")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def canonical_url(c: Column, host: str) -> Column:
    """Absolute URL without query; neither rooted nor http gives ``""``."""
    bare = F.substring_index(c, "?", 1)
    return (F.when(c.startswith("/"), F.concat(F.lit(host), bare))
            .when(c.startswith("http"), bare)
            .otherwise(F.lit("")))


def url_id(c: Column, pattern: str = r"/jobs/view/(\d+)") -> Column:
    """First group of ``pattern``, or ``""``."""
    return F.coalesce(F.regexp_extract(c, pattern, 1), F.lit(""))


def identity_key(id_: Column, url: Column) -> Column:
    """The id, else the URL, else null (a record that is never a repeat)."""
    return F.coalesce(F.nullif(id_, F.lit("")), F.nullif(url, F.lit("")))


def first_match(html: Column, patterns: Sequence[str]) -> Column:
    """Stripped first group of the first pattern that yields text, else ``""``."""
    picks = [F.nullif(strip_html(F.regexp_extract(html, p, 1)), F.lit("")) for p in patterns]
    return F.coalesce(*picks, F.lit(""))


def all_matches(html: Column, pattern: str) -> Column:
    """Stripped first group of every match."""
    return F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), strip_html)


def join_matches(html: Column, pattern: str, sep: str = ", ") -> Column:
    return F.array_join(F.filter(all_matches(html, pattern), lambda s: s != ""), sep)
