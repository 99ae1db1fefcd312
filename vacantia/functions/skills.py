"""Skills of a text by lexicon."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .rules import any_of
from .text import once

# A word character, spelled out so that accents count as letters.
W = r"[\p{L}\p{N}_]"
TOKEN = W + "+"
# In strict mode an underscore separates words.
STRICT_TOKEN = r"[\p{L}\p{N}]+"


def _is_word(s: str) -> bool:
    return re.fullmatch(r"\w+", s) is not None


def boundary_pattern(skill: str) -> str:
    r"""``\bskill\b`` with the word class above.

    A boundary next to a symbol needs a word character on the other side, so
    ``c++`` is found in ``c++x`` and not in ``c++ daily``.
    """
    head = f"(?<!{W})" if _is_word(skill[0]) else f"(?<={W})"
    tail = f"(?!{W})" if _is_word(skill[-1]) else f"(?={W})"
    return head + re.escape(skill) + tail


def strict_pattern(skill: str) -> str:
    """Neither a letter, digit nor ``+``/``#`` around the skill."""
    return r"(?<![\p{L}\p{N}])" + re.escape(skill) + r"(?![\p{L}\p{N}+#])"


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _hits(tests: Sequence[tuple[str, Column]]) -> Column:
    """Labels of the tests that hold."""
    if not tests:
        return _strings([])
    return F.array_except(F.array(*[F.when(t, F.lit(s)) for s, t in tests]), F.array(F.lit(None).cast("string")))


def whole_words(text: Column, lexicon: Sequence[str] | None = None,
                strict_tokens: bool = False) -> Column:
    """Sorted distinct skills standing in the text as whole words.

    The text is split into words once.  Skills made of word characters only
    are looked up among them; the few with spaces or symbols are searched one
    by one, and only if all their words occur.
    """
    lexicon = list(lexicon or vocab.SKILLS_FULL)
    simple = [] if strict_tokens else [s for s in lexicon if _is_word(s)]
    shaped = [s for s in lexicon if s not in simple]
    parts = {s: re.findall(r"\w+", s) for s in shaped}
    make = strict_pattern if strict_tokens else boundary_pattern

    vocabulary = dict.fromkeys([*simple, *(p for ps in parts.values() for p in ps)])

    def found_in(low: Column) -> Column:
        tokens = F.regexp_extract_all(low, F.lit(STRICT_TOKEN if strict_tokens else TOKEN), F.lit(0))
        return once(F.array_intersect(_strings(list(vocabulary)), tokens), lambda present: found_among(low, present))

    def found_among(low: Column, present: Column) -> Column:
        def test(skill: str) -> Column:
            out = F.lit(True)
            for p in parts[skill]:
                out = out & F.array_contains(present, p)
            return out & low.rlike(make(skill))

        found = _hits([(s, test(s)) for s in shaped])
        return F.concat(F.array_intersect(_strings(simple), present), found) if simple else found

    return F.coalesce(F.sort_array(F.array_distinct(once(F.lower(text), found_in))), _strings([]))


def substrings(text: Column, lexicon: Sequence[str] | None = None) -> Column:
    """Sorted skills contained anywhere in the text, in one pass.

    At every position the longest skill that starts there is noted; a skill
    occurs if it or a skill that contains it was noted.
    """
    lexicon = list(lexicon or vocab.SKILLS_SHORT)
    noted = F.array_intersect(_strings(lexicon), F.regexp_extract_all(
        F.lower(text), F.lit(f"(?=({any_of(lexicon)}))"), F.lit(1)))
    found = _hits([(s, F.arrays_overlap(noted, _strings([x for x in lexicon if s in x]))) for s in lexicon])
    return F.coalesce(F.sort_array(found), _strings([]))


def sorted_unique(skills: Column) -> Column:
    return F.sort_array(F.array_distinct(skills))


def flag_columns(skills: Column, names: Sequence[str], prefix: str = "skill_") -> list[Column]:
    """One 0/1 column per skill name."""
    return [F.array_contains(skills, s).cast("int").alias(prefix + s) for s in names]
