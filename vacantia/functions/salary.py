"""Salary text to numbers and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .text import once, strip

SHORTHAND = r"(?iU)([0-9]+(?:[.,][0-9]+)?)\s*(?:jt|juta)"
AMOUNT = r"[0-9][0-9.,]*"


def _amount(n: Column) -> Column:
    return F.concat(F.lit("Rp "), F.translate(F.format_number(n, 0), ",", "."))


def display(low: Column, high: Column) -> Column:
    """``Rp 5.000.000 – Rp 8.000.000``."""
    return F.concat(_amount(low), F.lit(" – "), _amount(high))


def midpoint(low: Column, high: Column) -> Column:
    """Mean of both ends, or the one that is known."""
    return F.coalesce((low.cast("double") + high.cast("double")) / 2,
                      low.cast("double"), high.cast("double"))


def parse(raw: Column, blank: str = vocab.NOT_STATED,
          floor: int = vocab.SALARY_TEXT_FLOOR) -> Column:
    """Struct (salary_min, salary_max, salary_display) of a salary text.

    ``jt``/``juta`` numbers count in millions and, if there is one, plain
    numbers are ignored.  Otherwise every number of at least ``floor`` counts,
    dots and commas dropped.
    """
    def numbers(s: Column) -> Column:
        millions = F.transform(
            F.regexp_extract_all(s, F.lit(SHORTHAND), F.lit(1)),
            lambda t: (F.replace(t, F.lit(","), F.lit(".")).cast("double") * 1_000_000).cast("bigint"))
        plain = F.filter(
            F.transform(F.regexp_extract_all(s, F.lit(AMOUNT), F.lit(0)),
                        lambda t: F.translate(t, ".,", "").try_cast("bigint")),
            lambda n: n >= floor)
        stated = s.isNotNull() & ~s.isin("", blank, "nan")
        return F.when(stated, once(millions, lambda m: F.when(
            F.size(m) > 0, F.struct(F.lit(True).alias("short"), m.alias("all"))).otherwise(
            F.struct(F.lit(False).alias("short"), plain.alias("all")))))

    def ends(n: Column) -> Column:
        amounts = F.when(F.size(n["all"]) > 0, n["all"])
        low, high = F.array_min(amounts), F.array_max(amounts)
        shown = (F.when(amounts.isNull(), F.lit(blank))
                 .when(~n["short"] & (F.size(amounts) == 1), _amount(low))
                 .otherwise(display(low, high)))
        return F.struct(low.alias("salary_min"), high.alias("salary_max"), shown.alias("salary_display"))

    return once(once(strip(raw), numbers), ends)


def source_flag(value: Column) -> Column:
    """Provenance before filling: known or still missing."""
    return F.when(value.isNotNull(), F.lit("actual")).otherwise(F.lit("missing"))
