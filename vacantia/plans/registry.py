"""The list of queries, each with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def r4(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


def values_sql(rows: list[tuple], columns: str) -> str:
    """A constant table in SQL."""
    def lit(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({columns})"


def contains_sql(expr: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{w}')" for w in words) + ")"


def words_case_sql(expr: str, rules, default: str) -> str:
    arms = " ".join(f"WHEN {contains_sql(expr, words)} THEN '{label}'" for label, words in rules)
    return f"CASE {arms} ELSE {default} END"


def patterns_case_sql(expr: str, rules, default: str) -> str:
    arms = " ".join(f"WHEN regexp_matches({expr}, '{p}') THEN '{label}'" for label, p in rules)
    return f"CASE {arms} ELSE {default} END"


def bands_case_sql(expr: str, bands) -> str:
    arms = " ".join(f"WHEN {expr} > {low}" + (f" AND {expr} <= {high}" if high is not None else "") + f" THEN '{label}'"
                    for low, high, label in bands)
    return f"CASE {arms} END"
