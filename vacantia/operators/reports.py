"""Counts, shares, means and profiles of a postings table.

Skills are exploded and counted per (role, skill) with map-side combining; no
list of a whole group is ever built.  Shares read their total from a scalar
subquery over the already aggregated counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.rules import band, rank_in
from ..functions.skills import flag_columns
from ..shared import settle
from .filters import percentile_trim
from .quantiles import exact_quantiles
from .ranking import top_by_count, top_per_group
from .skew import key_counts, lookup


def known(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull())


def share_of_total(counts: DataFrame, n: str = "n", out: str = "pct", digits: int = 1) -> DataFrame:
    """Percent of the grand total of an aggregated count."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(out, F.round(F.col(n) / total * 100, digits))


def role_share(df: DataFrame, role: str = "search_role", digits: int = 1) -> DataFrame:
    """Q1: postings per role and percent of all, most frequent first."""
    counts = key_counts(known(df, role), [role])
    return share_of_total(counts, digits=digits).orderBy(F.desc("n"), role)


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per value, nulls left out."""
    return key_counts(known(df, name), [name]).orderBy(F.desc("n"), name)


def facet_values(df: DataFrame, names: Sequence[str], value: str | None = None) -> DataFrame:
    """(facet, value, n, mean) of several columns in one pass over the rows.

    ``mean`` is that of the ``value`` column; with it, rows that lack it do not count.
    """
    kept = known(df, value) if value else df
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in names])
    measure = F.col(value) if value else F.lit(None).cast("double")
    rows = kept.select(measure.alias("_m"), F.explode(pairs).alias("_f")).select("_m", "_f.*")
    return known(rows, "value").groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"), F.avg("_m").alias("mean"))


def other_rate(df: DataFrame, role: str, other: str = vocab.OTHER_ROLE) -> DataFrame:
    """Percent of rows with the catch-all role."""
    hit = F.when(F.col(role) == other, 1.0).otherwise(0.0)
    return df.agg((F.avg(hit) * 100).alias("other_pct"))


def other_titles(df: DataFrame, role: str, title: str = "title", n: int = 15,
                 limit_pct: float = 10.0, other: str = vocab.OTHER_ROLE) -> DataFrame:
    """Commonest titles of the catch-all role, empty unless it exceeds ``limit_pct``."""
    pct = other_rate(df, role, other).scalar()
    return top_by_count(df.filter((F.col(role) == other) & (pct > limit_pct)), title, n)


def _skill_rows(df: DataFrame, skills: str, stop: str | None, any_case: bool, *keep: str) -> DataFrame:
    rows = df.select(*keep, F.explode(skills).alias("skill"))
    if stop is None:
        return rows
    return rows.filter((F.lower("skill") if any_case else F.col("skill")) != stop)


def top_skills(df: DataFrame, skills: str = "extracted_skills", n: int = 20,
               stop: str | None = None, any_case: bool = False) -> DataFrame:
    """Commonest skills with the percent of rows (not of mentions)."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    return (_skill_rows(df, skills, stop, any_case).groupBy("skill").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "skill").limit(n)
            .withColumn("pct", F.col("n") / rows * 100))


def top_skills_per_role(df: DataFrame, role: str = "search_role", skills: str = "extracted_skills",
                        n: int = 8, stop: str | None = vocab.STOP_SKILL, any_case: bool = False,
                        skip_role: str | None = None) -> DataFrame:
    """Q2: the ``n`` commonest skills of each role."""
    if skip_role is not None:
        df = df.filter(F.col(role) != skip_role)
    counts = (_skill_rows(known(df, role), skills, stop, any_case, role)
              .groupBy(role, "skill").agg(F.count(F.lit(1)).alias("n")))
    return top_per_group(counts, [role], [F.desc("n"), "skill"], n, "rank")


def top_skills_selected(df: DataFrame, role_value: str | None, n: int = 10, role: str = "search_role",
                        skills: str = "extracted_skills", stop: str = vocab.STOP_SKILL) -> DataFrame:
    """Commonest skills of one role, or of all with ``role_value`` None."""
    if role_value is not None:
        df = df.filter(F.col(role) == role_value)
    return (_skill_rows(df, skills, stop, True).groupBy("skill").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "skill").limit(n))


def skill_role_matrix(df: DataFrame, role: str = "search_role", skills: str = "extracted_skills",
                      n: int = 15, stop: str = vocab.STOP_SKILL, any_case: bool = False,
                      digits: int = 1) -> DataFrame:
    """Q2b: percent of a role's postings naming each globally common skill.

    Long form (role, position, skill, pct); a skill no posting of the role
    names has 0.  The denominator is every row of the role.
    """
    df = known(df, role)
    counts = (_skill_rows(df, skills, stop, any_case, role)
              .groupBy(role, "skill").agg(F.count(F.lit(1)).alias("n")))
    best = (counts.groupBy("skill").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "skill").limit(n))
    # At most n names, in order.
    names = best.agg(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "skill"))),
        lambda s: s["skill"])).scalar()
    # No filter on the skill here: both uses of the counts stay one shuffle.
    wanted = F.when(F.array_contains(names, F.col("skill")), F.struct("skill", "n"))
    hits = counts.groupBy(role).agg(F.map_from_entries(F.collect_list(wanted)).alias("_hits"))
    totals = key_counts(df, [role], "_rows")
    return (totals.join(hits, role, "left")
            .select(role, "_rows", "_hits", F.posexplode(names).alias("position", "skill"))
            .select(role, "position", "skill",
                    F.round(F.coalesce(F.try_element_at("_hits", F.col("skill")), F.lit(0))
                            / F.col("_rows") * 100, digits).alias("pct")))


def mean_by(df: DataFrame, key: str, value: str = "salary_avg", out: str = "mean") -> DataFrame:
    """Q3: mean of the known values per key, highest first."""
    return (known(known(df, value), key).groupBy(key).agg(F.avg(value).alias(out))
            .orderBy(F.desc(out), key))


def level_crosstab(df: DataFrame, role: str = "search_role", level: str = "job_level",
                   levels: Sequence[str] = vocab.LEVEL_ORDER) -> DataFrame:
    """Q4: postings per role and listed level, zeros filled."""
    df = known(known(df, role), level)
    return df.groupBy(role).agg(*[F.count_if(F.col(level) == v).alias(v) for v in levels])


def level_share(df: DataFrame, role: str = "search_role", level: str = "job_level",
                levels: Sequence[str] = vocab.LEVEL_ORDER) -> DataFrame:
    """Q4: percent per role; the base counts listed levels only."""
    table = level_crosstab(df, role, level, levels)
    base = sum((F.col(f"`{v}`") for v in levels[1:]), F.col(f"`{levels[0]}`"))
    return table.select(role, *[F.try_divide(F.col(f"`{v}`") * 100, base).alias(v) for v in levels])


def trimmed(df: DataFrame, value: str, p: float | None = 0.99) -> DataFrame:
    df = known(df, value)
    return df if p is None else percentile_trim(df, value, p)


def correlation(df: DataFrame, x: str = "skills_count", y: str = "salary_avg",
                p: float | None = 0.99) -> DataFrame:
    """Q5: Pearson r after trimming ``y``."""
    return trimmed(df, y, p).agg(F.corr(x, y).alias("r"))


def bucket_mean(df: DataFrame, x: str = "skills_count", y: str = "salary_avg",
                bands=vocab.SKILL_COUNT_BANDS, p: float | None = 0.99) -> DataFrame:
    """Q5: mean of trimmed ``y`` per band of ``x``; empty bands are absent."""
    order = [label for _, _, label in bands]
    return (known(trimmed(df, y, p).withColumn("bucket", band(F.col(x), bands)), "bucket")
            .groupBy("bucket").agg(F.avg(y).alias("mean"))
            .orderBy(rank_in(F.col("bucket"), order)))


def top_companies(df: DataFrame, company: str = "company", n: int = 15) -> DataFrame:
    """Q6a: companies with most postings."""
    return top_by_count(df, company, n)


def size_salary_volume(df: DataFrame, size: str = "company_size_proxy", value: str = "salary_avg",
                       bands=vocab.COMPANY_SIZE_BANDS) -> DataFrame:
    """Q6b: mean value and postings per size band, every band in order.

    ``salaried`` counts rows with a known value, ``postings`` all rows.
    """
    table = known(df, size).groupBy(size).agg(
        F.avg(value).alias("mean"), F.count(value).alias("salaried"), F.count(F.lit(1)).alias("postings"))
    listed = df.sparkSession.createDataFrame([(i, b[2]) for i, b in enumerate(bands)], f"position int, {size} string")
    return (listed.join(table, size, "left").fillna(0, ["salaried", "postings"])
            .select(size, "position", "mean", "salaried", "postings").orderBy("position"))


def seniority_salary(df: DataFrame, level: str = "title_seniority", value: str = "salary_avg",
                     order: Sequence[str] = vocab.LEVEL_ORDER, p: float | None = 0.99) -> DataFrame:
    """Q7a: trimmed mean and count per seniority, in fixed order."""
    return (trimmed(df, value, p).groupBy(level)
            .agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
            .withColumn("position", rank_in(F.col(level), order))
            .filter(F.col("position").isNotNull()).orderBy("position"))


def unique_titles(df: DataFrame, role: str = "search_role", title: str = "title") -> DataFrame:
    """Q7b: distinct titles per role."""
    return (known(df, role).groupBy(role).agg(F.count_distinct(title).alias("titles"))
            .orderBy(F.desc("titles"), role))


def kpi(df: DataFrame, role: str = "search_role", company: str = "company",
        value: str = "salary_avg", skills_count: str = "skills_count",
        low: float | None = None, high: float | None = None) -> DataFrame:
    """Head figures of a selection; zero where there is nothing to average.

    ``low`` and ``high`` bound the values that count as stated.
    """
    usable = F.col(value).isNotNull()
    if low is not None:
        usable = usable & (F.col(value) >= low)
    if high is not None:
        usable = usable & (F.col(value) <= high)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(role).alias("roles"),
        F.coalesce(F.avg(F.when(usable, F.col(value))), F.lit(0.0)).alias("mean_value"),
        F.count_distinct(company).alias("companies"),
        F.coalesce(F.avg(F.when(usable, 100.0).otherwise(0.0)), F.lit(0.0)).alias("pct_value"),
        F.coalesce(F.avg(skills_count), F.lit(0.0)).alias("mean_skills"))


def clean_report(df: DataFrame, role: str = "search_role", company: str = "company",
                 location: str = "location", value: str = "salary_min",
                 skills_count: str = "skills_count") -> DataFrame:
    """Size and coverage of a cleaned table."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(role).alias("roles"),
        F.count_distinct(company).alias("companies"),
        F.count_distinct(location).alias("locations"),
        F.count(value).alias("with_value"),
        F.avg(F.when(F.col(value).isNotNull(), 100.0).otherwise(0.0)).alias("pct_value"),
        F.avg(skills_count).alias("mean_skills"),
        F.count_if(F.col(skills_count) == 0).alias("without_skills"))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column as (column, nulls)."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns])
    return counts.select(F.inline(pairs))


def schema_info(df: DataFrame) -> DataFrame:
    """Non-null count and type per column."""
    counts = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns])
    types = dict(df.dtypes)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("non_null"),
                               F.lit(types[c]).alias("type")) for c in df.columns])
    return counts.select(F.inline(pairs))


def describe(df: DataFrame, name: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of a column."""
    quart = exact_quantiles(df, name, [0.25, 0.5, 0.75], names=["q25", "q50", "q75"])
    value = F.col(name).cast("double")
    base = df.agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev(value).alias("std"),
                  F.min(value).alias("min"), F.max(value).alias("max"))
    return base.withColumn("_q", quart.select(F.struct("q25", "q50", "q75")).scalar()).select(
        "count", "mean", "std", "min", "_q.q25", "_q.q50", "_q.q75", "max")


def range_counts(df: DataFrame, name: str, low: float = vocab.SALARY_LOW,
                 high: float = vocab.SALARY_HIGH) -> DataFrame:
    """How many values lie above, below (but positive) and are missing."""
    c = F.col(name)
    return df.agg(F.count_if(c > high).alias("above"), F.count_if((c > 0) & (c < low)).alias("below"),
                  F.count_if(c.isNull()).alias("missing"), F.count(c).alias("known"))


def row_fingerprint(columns: Sequence[str]) -> tuple[Column, Column]:
    """128 bits of a row's values."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)


def duplicate_count(df: DataFrame, fingerprint: Callable[[Sequence[str]], tuple[Column, Column]] = row_fingerprint) -> DataFrame:
    """Rows that repeat an earlier row in every column.

    Only fingerprints are shuffled at first; rows whose fingerprint occurs
    again are compared by value, so different rows of one fingerprint count as
    different.
    """
    a, b = fingerprint(df.columns)
    marks = df.select(a.alias("_a"), b.alias("_b")).groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("n"))
    again = lookup(df.withColumns({"_a": a, "_b": b}), marks.filter("n > 1").select("_a", "_b", F.lit(True).alias("_again")), ["_a", "_b"], marks)
    values = again.filter("_again").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return values.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def dominant_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value per key, ties by value."""
    counts = key_counts(known(known(df, key), value), [key, value])
    return top_per_group(counts, [key], [F.desc("n"), value], 1)


def dominant_skill(df: DataFrame, key: str, skills: str = "extracted_skills",
                   stop: str = vocab.STOP_SKILL) -> DataFrame:
    return top_skills_per_role(df, key, skills, 1, stop, any_case=True).drop("rank")


def step_counts(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left and removed after each filter of a chain, in one pass."""
    passed, kept = [], F.lit(True)
    for _, test in steps:
        kept = kept & F.coalesce(test, F.lit(False))
        passed.append(F.count_if(kept))
    counts = df.agg(F.count(F.lit(1)).alias("_0"), *[c.alias(f"_{i}") for i, c in enumerate(passed, 1)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("step"),
                 F.col(f"_{i - 1}").alias("before"), F.col(f"_{i}").alias("after"),
                 (F.col(f"_{i - 1}") - F.col(f"_{i}")).alias("removed"))
        for i, (name, _) in enumerate(steps, 1)])
    return counts.select(F.inline(rows))


def step_log(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows after each stage of a pipeline, and rows the stage removed.

    For stages that are no plain filter, such as dropping repeats.  If each
    stage is made from the one before, observing them while the last one runs
    counts all of them in one pass (``observed``).
    """
    counts = None
    for position, (name, stage) in enumerate(stages):
        line = stage.agg(F.count(F.lit(1)).alias("after")).select(F.lit(position).alias("position"), F.lit(name).alias("step"), "after")
        counts = line if counts is None else counts.unionByName(line)
    before = F.lag("after").over(Window.orderBy("position"))
    return counts.select("position", "step", "after", (F.coalesce(before, F.col("after")) - F.col("after")).alias("removed"))


def observed(df: DataFrame, steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]], name: str = "read") -> tuple[DataFrame, DataFrame]:
    """Apply steps one after the other, store the result, and log it: (result, rows after each step and rows removed).

    Every step's output is observed while the result is written, so nothing is computed again for the log.
    """
    watched = [(name, Observation())]
    df = df.observe(watched[0][1], F.count(F.lit(1)).alias("n"))
    for step, apply in steps:
        watched.append((step, Observation()))
        df = apply(df).observe(watched[-1][1], F.count(F.lit(1)).alias("n"))
    result = settle(df)
    after = [(i, step, seen.get["n"]) for i, (step, seen) in enumerate(watched)]
    rows = [(i, step, n, after[max(0, i - 1)][2] - n) for i, step, n in after]
    return result, df.sparkSession.createDataFrame(rows, "position int, step string, after bigint, removed bigint")


def skill_trend(df: DataFrame, time: str = "scraped_at", skills: str = "extracted_skills",
                unit: str = "month") -> DataFrame:
    """Postings per period and skill."""
    rows = df.select(F.date_trunc(unit, time).alias("period"), F.explode(skills).alias("skill"))
    return key_counts(known(rows, "period"), ["period", "skill"])


def word_freq_per_role(df: DataFrame, role: str, description: str, n: int = 50) -> DataFrame:
    """Commonest words of the descriptions per role."""
    words = F.explode(F.split(F.lower(description), r"[^\p{L}\p{N}]+"))
    counts = key_counts(known(df, role).select(role, words.alias("word")).filter("word <> ''"), [role, "word"])
    return top_per_group(counts, [role], [F.desc("n"), "word"], n, "rank")


def role_card(df: DataFrame, role: str = "search_role", skills: str = "extracted_skills",
              n: int = 5, stop: str | None = None) -> DataFrame:
    """One record per role: job count and its ``n`` commonest skills."""
    best = top_skills_per_role(df, role, skills, n, stop)
    lists = best.groupBy(role).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("rank", "skill"))), lambda s: s["skill"]).alias("top_skills"))
    return (key_counts(known(df, role), [role], "job_count").join(lists, role, "left")
            .select(role, F.coalesce("top_skills", F.array().cast("array<string>")).alias("top_skills"),
                    "job_count"))


def role_profile(df: DataFrame, role: str = "search_role", level: str = "job_level",
                 value: str = "salary_avg", skills: str = "extracted_skills",
                 stop: str = vocab.STOP_SKILL) -> DataFrame:
    """Per role: postings, share, commonest skill and level, mean value."""
    base = (known(df, role).groupBy(role)
            .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean")))
    total = df.agg(F.count(F.lit(1))).scalar()
    skill = dominant_skill(df, role, skills, stop).select(role, F.col("skill").alias("top_skill"))
    top_level = dominant_value(df, role, level).select(role, F.col(level).alias("top_level"))
    return (base.join(skill, role, "left").join(top_level, role, "left")
            .select(role, "n", (F.col("n") / total * 100).alias("pct"), "top_skill", "top_level", "mean"))


def location_top(df: DataFrame, location: str = "location", n: int = 10) -> DataFrame:
    return top_by_count(df, location, n)


def _as_map(counts: DataFrame, key: str, value: str) -> Column:
    """Scalar map of a grouped count; the keys are labels of a rule table."""
    return counts.agg(F.map_from_entries(F.collect_list(F.struct(key, value)))).scalar()


def run_summary(df: DataFrame, generated_at: str, role: str = "standardized_role",
                level: str = "seniority", company: str = "company",
                skills: str = "extracted_skills", skills_count: str = "skills_count",
                other: str = vocab.OTHER_ROLE, n: int = 10) -> DataFrame:
    """One row: totals, role and seniority maps, mean skills, top skills per role.

    Totals and both maps come from one count per (role, level); the maps'
    keys are labels of rule tables.
    """
    cells = df.groupBy(role, level).agg(
        F.count(F.lit(1)).alias("n"), F.sum(skills_count).alias("_sum"), F.count(skills_count).alias("_counted"))
    sets = (cells.groupingSets([[F.col(role)], [F.col(level)], []], role, level)
            .agg(F.sum("n").alias("n"), F.sum("_sum").alias("_sum"), F.sum("_counted").alias("_counted"),
                 F.grouping(role).alias("_all_roles"), F.grouping(level).alias("_all_levels")))
    best = top_skills_per_role(df, role, skills, n, None, skip_role=other)
    top = best.groupBy(F.col(role).alias("_role")).agg(
        F.map_from_entries(F.transform(F.sort_array(F.collect_list(F.struct("rank", "skill", "n"))),
                                       lambda s: F.struct(s["skill"], s["n"]))).alias("_top"))
    lines = sets.join(top, F.col(role) == F.col("_role"), "left")
    is_role = (F.col("_all_roles") == 0) & F.col(role).isNotNull()
    is_level = (F.col("_all_levels") == 0) & F.col(level).isNotNull()
    is_total = (F.col("_all_roles") == 1) & (F.col("_all_levels") == 1)
    # A role without any skill still has its (empty) entry.
    skill_map = F.coalesce("_top", F.create_map().cast("map<string,bigint>"))

    def entries(test: Column, key: str, value: Column) -> Column:
        return F.map_from_entries(F.collect_list(F.when(test, F.struct(F.col(key), value))))

    companies = df.agg(F.count_distinct(company)).scalar()
    return lines.agg(
        F.coalesce(F.max(F.when(is_total, F.col("n"))), F.lit(0)).alias("total_jobs"),
        entries(is_role, role, F.col("n")).alias("role_distribution"),
        entries(is_level, level, F.col("n")).alias("seniority_distribution"),
        F.round(F.max(F.when(is_total, F.try_divide("_sum", "_counted"))), 2).alias("avg_skills_per_job"),
        entries(is_role & (F.col(role) != other), role, skill_map).alias("skills_per_role"),
    ).select(
        F.lit(generated_at).alias("generated_at"), "total_jobs", companies.alias("unique_companies"),
        "role_distribution", "seniority_distribution", "avg_skills_per_job", "skills_per_role")


def extended_summary(df: DataFrame, work_type: str, city: str, skills: str = "extracted_skills",
                     n_cities: int = 10, n_skills: int = 50) -> DataFrame:
    """Older extra parts of the summary: work types, top cities, top skills."""
    return df.sparkSession.range(1).select(
        _as_map(key_counts(known(df, work_type), [work_type]), work_type, "n").alias("work_type_distribution"),
        _as_map(top_by_count(df, city, n_cities), city, "n").alias("top_cities"),
        _as_map(top_skills(df, skills, n_skills), "skill", "n").alias("top_50_skills"))


def skill_vector(df: DataFrame, skills: str = "extracted_skills", n: int = 50,
                 out: str = "skill_vector") -> DataFrame:
    """0/1 array over the ``n`` commonest skills, in order of frequency."""
    best = top_skills(df, skills, n)
    names = best.agg(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "skill"))),
        lambda s: s["skill"])).scalar()
    return df.withColumn("_names", names).withColumn(out, F.transform(
        "_names", lambda s: F.array_contains(F.col(skills), s).cast("int"))).drop("_names")


def skill_columns(df: DataFrame, skills: str = "extracted_skills", n: int = 50,
                  names: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column per skill, by default for the ``n`` commonest.

    Column names must be known when the plan is made, so those ``n`` names
    (no more) are fetched first.
    """
    if names is None:
        names = [r["skill"] for r in top_skills(df, skills, n).select("skill").collect()]
    return df.select("*", *flag_columns(F.col(skills), names))
