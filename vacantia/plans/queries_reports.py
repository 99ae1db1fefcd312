"""Queries on counts, shares, means, profiles and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, vocab
from ..operators import cells, dedup, filters, frequent, impute, lookups, quality, reports
from .registry import bands_case_sql, contains_sql, query, r4, values_sql, words_case_sql
from .tables import jobs, over_jobs, table

# Company sizes over the jobs, and roles by keyword only.
SIZED_SQL = f"""sized AS (
  SELECT *, {bands_case_sql('freq', vocab.COMPANY_SIZE_BANDS)} AS size_band
  FROM (SELECT *, count(*) OVER (PARTITION BY company) AS freq FROM jobs))"""
KEYED_SQL = f"""keyed AS (
  SELECT *, {words_case_sql('lower(title)', vocab.ROLE_KEYWORDS, "'Other'")} AS standardized_role,
         {words_case_sql('lower(title)', vocab.SENIORITY_WORDS, "'Mid-level'")} AS seniority FROM jobs)"""
SKILLED_SQL = "skilled AS (SELECT id, search_role, job_level, scraped_at, unnest(extracted_skills) AS skill FROM jobs)"


def sized(spark, d):
    rows = lookups.with_group_size(jobs(spark, d).select("id", "company", "salary_avg", "skills_count"), "company", "freq")
    return rows.withColumn("size_band", rules.band(F.col("freq"), vocab.COMPANY_SIZE_BANDS))


def keyed(spark, d):
    role = F.coalesce(rules.role_by_keyword(F.col("title")), F.lit(vocab.OTHER_ROLE))
    return jobs(spark, d).withColumns({"standardized_role": role, "seniority": rules.seniority(F.col("title"))})


@query("agg_role_share", over_jobs("""
SELECT search_role, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM jobs), 4) AS pct
FROM jobs GROUP BY search_role"""))
def _(spark, d):
    return reports.role_share(jobs(spark, d), digits=4)


@query("agg_value_counts", over_jobs("""
SELECT facet, value, n FROM (
  SELECT 'job_level' AS facet, job_level AS value, count(*) AS n FROM jobs GROUP BY ALL
  UNION ALL SELECT 'location', location, count(*) FROM jobs GROUP BY ALL
  UNION ALL SELECT 'company', company, count(*) FROM jobs GROUP BY ALL) WHERE value IS NOT NULL"""))
def _(spark, d):
    return reports.facet_values(jobs(spark, d), ["job_level", "location", "company"]).drop("mean")


@query("agg_other_rate", over_jobs("""
SELECT title, n, round(pct, 4) AS other_pct FROM (
  SELECT title, count(*) AS n FROM keyed WHERE standardized_role = 'Other' GROUP BY ALL
  ORDER BY n DESC, title LIMIT 15)
CROSS JOIN (SELECT avg(CASE WHEN standardized_role = 'Other' THEN 100.0::DOUBLE ELSE 0 END) AS pct FROM keyed)
WHERE pct > 10""", KEYED_SQL))
def _(spark, d):
    df = keyed(spark, d).select("title", "standardized_role")
    pct = reports.other_rate(df, "standardized_role").scalar()
    return reports.other_titles(df, "standardized_role").withColumn("other_pct", r4(pct))


@query("agg_top_skills_global", over_jobs("""
SELECT skill, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM jobs), 4) AS pct
FROM skilled GROUP BY skill ORDER BY n DESC, skill LIMIT 20""", SKILLED_SQL))
def _(spark, d):
    return reports.top_skills(jobs(spark, d)).withColumn("pct", r4("pct"))


@query("agg_top_skills_per_role", over_jobs("""
SELECT search_role, skill, count(*) AS n,
       row_number() OVER (PARTITION BY search_role ORDER BY count(*) DESC, skill)::INTEGER AS rank
FROM skilled WHERE skill <> 'r' GROUP BY search_role, skill QUALIFY rank <= 8""", SKILLED_SQL))
def _(spark, d):
    return reports.top_skills_per_role(jobs(spark, d))


@query("agg_top_skills_selected", over_jobs("""
SELECT skill, n, scope FROM (
  SELECT skill, count(*) AS n, 'Data Engineer' AS scope FROM skilled
  WHERE skill <> 'r' AND search_role = 'Data Engineer' GROUP BY ALL ORDER BY n DESC, skill LIMIT 12)
UNION ALL SELECT skill, n, scope FROM (
  SELECT skill, count(*) AS n, 'all' AS scope FROM skilled WHERE skill <> 'r' GROUP BY ALL
  ORDER BY n DESC, skill LIMIT 5)""", SKILLED_SQL))
def _(spark, d):
    df = jobs(spark, d)
    one = reports.top_skills_selected(df, "Data Engineer", 12).withColumn("scope", F.lit("Data Engineer"))
    return one.unionByName(reports.top_skills_selected(df, None, 5).withColumn("scope", F.lit("all")))


@query("agg_skill_role_matrix", over_jobs("""
SELECT r.search_role, b.position, b.skill, round(coalesce(c.n, 0) * 100.0::DOUBLE / r.n, 4) AS pct
FROM (SELECT search_role, count(*) AS n FROM jobs GROUP BY ALL) r
CROSS JOIN (SELECT skill, (row_number() OVER (ORDER BY count(*) DESC, skill) - 1)::INTEGER AS position
            FROM skilled WHERE skill <> 'r' GROUP BY skill QUALIFY position < 10) b
LEFT JOIN (SELECT search_role, skill, count(*) AS n FROM skilled GROUP BY ALL) c
  ON c.search_role = r.search_role AND c.skill = b.skill""", SKILLED_SQL))
def _(spark, d):
    return reports.skill_role_matrix(jobs(spark, d), n=10, digits=4)


@query("agg_mean_salary_by", over_jobs("""
SELECT 'role' AS by, search_role AS key, round(avg(salary_avg), 4) AS mean FROM sized WHERE salary_avg IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'level', job_level, round(avg(salary_avg), 4) FROM sized WHERE salary_avg IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'size', size_band, round(avg(salary_avg), 4) FROM sized WHERE salary_avg IS NOT NULL GROUP BY ALL""",
    SIZED_SQL))
def _(spark, d):
    rows = lookups.with_group_size(jobs(spark, d).select("company", "search_role", "job_level", "salary_avg"), "company", "freq")
    named = rows.select("salary_avg", F.col("search_role").alias("role"), F.col("job_level").alias("level"),
                        rules.band(F.col("freq"), vocab.COMPANY_SIZE_BANDS).alias("size"))
    means = reports.facet_values(named, ["role", "level", "size"], "salary_avg")
    return means.select(F.col("facet").alias("by"), F.col("value").alias("key"), r4("mean").alias("mean"))


LEVEL_COLUMNS = {v: v.lower().replace(" ", "_").replace("/", "_").replace("-", "_") for v in vocab.LEVEL_ORDER}


@query("agg_level_crosstab", over_jobs("SELECT search_role, " + ", ".join(
    f"count(*) FILTER (job_level = '{v}') AS {c}" for v, c in LEVEL_COLUMNS.items())
    + " FROM jobs GROUP BY search_role"))
def _(spark, d):
    return reports.level_crosstab(jobs(spark, d)).withColumnsRenamed(LEVEL_COLUMNS)


@query("agg_level_share", over_jobs("SELECT search_role, " + ", ".join(
    f"round(count(*) FILTER (job_level = '{v}') * 100.0::DOUBLE / count(*) FILTER (job_level <> 'Junior'), 4) AS {c}"
    for v, c in LEVEL_COLUMNS.items() if v != "Junior") + " FROM jobs GROUP BY search_role"))
def _(spark, d):
    # One level is not listed, so its rows leave the base.
    listed = [v for v in vocab.LEVEL_ORDER if v != "Junior"]
    shares = reports.level_share(jobs(spark, d), levels=listed)
    return shares.select("search_role", *[r4(F.col(f"`{v}`")).alias(LEVEL_COLUMNS[v]) for v in listed])


TRIM_SQL = """trimmed AS (
  SELECT * FROM jobs WHERE salary_avg <= (SELECT quantile_cont(salary_avg, 0.99) FROM jobs))"""


@query("agg_corr", over_jobs("SELECT round(corr(skills_count, salary_avg), 6) AS r FROM trimmed", TRIM_SQL))
def _(spark, d):
    return reports.correlation(jobs(spark, d)).select(F.round("r", 6).alias("r"))


@query("agg_bucket_mean", over_jobs(f"""
SELECT bucket, round(avg(salary_avg), 4) AS mean FROM (
  SELECT {bands_case_sql('skills_count', vocab.SKILL_COUNT_BANDS)} AS bucket, salary_avg FROM trimmed)
WHERE bucket IS NOT NULL GROUP BY bucket""", TRIM_SQL))
def _(spark, d):
    return reports.bucket_mean(jobs(spark, d)).withColumn("mean", r4("mean"))


@query("agg_top_companies", over_jobs(
    "SELECT company, count(*) AS n FROM jobs GROUP BY company ORDER BY n DESC, company LIMIT 15"))
def _(spark, d):
    return reports.top_companies(jobs(spark, d))


@query("agg_size_salary_volume", over_jobs(f"""
SELECT size_band, position, round(mean, 4) AS mean, coalesce(salaried, 0) AS salaried, coalesce(postings, 0) AS postings
FROM {values_sql([(i, b[2]) for i, b in enumerate(vocab.COMPANY_SIZE_BANDS)], 'position, size_band')}
LEFT JOIN (SELECT size_band, avg(salary_avg) AS mean, count(salary_avg) AS salaried, count(*) AS postings
           FROM sized GROUP BY ALL) USING (size_band)""", SIZED_SQL))
def _(spark, d):
    return reports.size_salary_volume(sized(spark, d), "size_band").withColumn("mean", r4("mean"))


TITLED_SQL = "lower(title)"
TITLE_RULES = [(label, [w.lower() for w in words]) for label, words in vocab.TITLE_SENIORITY_WORDS]


@query("agg_seniority_salary", over_jobs(f"""
SELECT title_seniority, round(avg(salary_avg), 4) AS mean, count(*) AS n,
       list_position({vocab.LEVEL_ORDER}, title_seniority)::INTEGER - 1 AS position
FROM (SELECT {words_case_sql(TITLED_SQL, TITLE_RULES, "'Tidak Disebutkan'")} AS title_seniority, salary_avg FROM trimmed)
GROUP BY title_seniority""", TRIM_SQL))
def _(spark, d):
    df = jobs(spark, d).withColumn("title_seniority", rules.title_seniority(F.col("title")))
    return reports.seniority_salary(df).withColumn("mean", r4("mean"))


@query("agg_unique_titles", over_jobs(
    "SELECT search_role, count(DISTINCT title) AS titles FROM jobs GROUP BY search_role"))
def _(spark, d):
    return reports.unique_titles(jobs(spark, d))


@query("agg_kpi", over_jobs("""
SELECT count(*) AS total, count(DISTINCT search_role) AS roles,
       round(avg(salary_avg) FILTER (salary_avg BETWEEN 5e6 AND 9e7), 4) AS mean_value,
       count(DISTINCT company) AS companies,
       round(count(*) FILTER (salary_avg BETWEEN 5e6 AND 9e7) * 100.0::DOUBLE / count(*), 4) AS pct_value,
       round(avg(skills_count), 4) AS mean_skills
FROM jobs WHERE job_level IN ('Senior', 'Junior')"""))
def _(spark, d):
    chosen = filters.facets(jobs(spark, d), {"job_level": ["Senior", "Junior"], "search_role": []})
    df = reports.kpi(chosen, low=5e6, high=9e7)
    return df.withColumns({c: r4(c) for c in ("mean_value", "pct_value", "mean_skills")})


# Selections of the dashboard that one set of cells answers.
SELECTIONS = {"all": {}, "levels": {"job_level": ["Senior", "Junior"]},
              "role and levels": {"job_level": ["Senior", "Mid"], "search_role": ["Data Engineer", "Data Scientist"]}}


def _chosen_sql(chosen):
    return " AND ".join(["true", *(f"{c} IN ({', '.join(repr(v) for v in values)})" for c, values in chosen.items())])


@query("agg_kpi_cells", over_jobs(" UNION ALL ".join(f"""
SELECT '{name}' AS selection, count(*) AS total, count(DISTINCT search_role) AS roles,
       round(coalesce(avg(salary_avg) FILTER (salary_avg BETWEEN 5e6 AND 9e7), 0), 4) AS mean_value,
       count(DISTINCT company) AS companies,
       round(coalesce(count(*) FILTER (salary_avg BETWEEN 5e6 AND 9e7) * 100.0::DOUBLE / nullif(count(*), 0), 0), 4) AS pct_value,
       round(coalesce(avg(skills_count), 0), 4) AS mean_skills
FROM jobs WHERE {_chosen_sql(chosen)}""" for name, chosen in SELECTIONS.items())))
def _(spark, d):
    stored = cells.build(jobs(spark, d), ["search_role", "job_level"], ["search_role", "company"])
    found = [cells.kpi(stored, chosen, 5e6, 9e7).select(F.lit(name).alias("selection"), "*") for name, chosen in SELECTIONS.items()]
    return dedup.union_by_name(*found).withColumns({c: r4(c) for c in ("mean_value", "pct_value", "mean_skills")})


@query("agg_unique_titles_cells", over_jobs("""
SELECT search_role, count(DISTINCT title) AS titles FROM jobs WHERE job_level IN ('Senior', 'Junior') GROUP BY search_role"""))
def _(spark, d):
    stored = cells.build(jobs(spark, d), ["search_role", "job_level"], ["title"])
    return cells.distinct_counts(stored, "title", SELECTIONS["levels"], ["search_role"], "titles")


@query("agg_top_companies_threshold", over_jobs("""
SELECT company, count(*) AS n FROM jobs WHERE company IS NOT NULL GROUP BY company ORDER BY n DESC, company LIMIT 15"""))
def _(spark, d):
    return frequent.top_counts(jobs(spark, d), "company", 15)


@query("agg_word_freq_threshold", """
SELECT source, word, n, rank FROM (
  SELECT source, word, count(*) AS n, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, word) AS rank
  FROM (SELECT source, unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS word FROM documents WHERE source IS NOT NULL)
  WHERE word <> '' GROUP BY source, word) WHERE rank <= 50""")
def _(spark, d):
    words = F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("word")
    rows = table(spark, d, "documents").select("source", words).filter("word <> ''")
    return frequent.top_counts(rows, "word", 50, by=["source"], buckets=16_384, rank="rank")


def _flat_summary(df):
    """One row per entry of the summary's maps."""
    roles = df.select(F.explode("role_distribution").alias("key", "n")).select(
        F.lit("role").alias("part"), "key", F.lit("").alias("skill"), "n")
    levels = df.select(F.explode("seniority_distribution").alias("key", "n")).select(
        F.lit("seniority").alias("part"), "key", F.lit("").alias("skill"), "n")
    top = (df.select(F.explode("skills_per_role").alias("key", "_top"))
           .select(F.lit("skills").alias("part"), "key", F.explode("_top").alias("skill", "n")))
    head = df.select(F.lit("head").alias("part"), F.col("avg_skills_per_job").cast("string").alias("key"),
                     F.col("unique_companies").cast("string").alias("skill"), F.col("total_jobs").alias("n"))
    return roles.unionByName(levels).unionByName(top).unionByName(head)


SUMMARY_SQL = over_jobs("""
SELECT 'role' AS part, standardized_role AS key, '' AS skill, count(*) AS n FROM keyed GROUP BY ALL
UNION ALL SELECT 'seniority', seniority, '', count(*) FROM keyed GROUP BY ALL
UNION ALL SELECT 'skills', standardized_role, skill, count(*) FROM (
  SELECT standardized_role, unnest(extracted_skills) AS skill FROM keyed WHERE standardized_role <> 'Other')
  GROUP BY standardized_role, skill QUALIFY row_number() OVER (PARTITION BY standardized_role ORDER BY count(*) DESC, skill) <= 10
UNION ALL SELECT 'head', round(avg(skills_count), 2)::VARCHAR, count(DISTINCT company)::VARCHAR, count(*) FROM keyed
""", KEYED_SQL)


@query("agg_run_summary", SUMMARY_SQL)
def _(spark, d):
    return _flat_summary(reports.run_summary(keyed(spark, d), "20260531_183706"))


@query("agg_clean_report", over_jobs("""
SELECT count(*) AS total, count(DISTINCT search_role) AS roles, count(DISTINCT company) AS companies,
       count(DISTINCT location) AS locations, count(salary_avg) AS with_value,
       round(count(salary_avg) * 100.0::DOUBLE / count(*), 4) AS pct_value, round(avg(skills_count), 4) AS mean_skills,
       count(*) FILTER (skills_count = 0) AS without_skills FROM jobs"""))
def _(spark, d):
    df = reports.clean_report(jobs(spark, d), value="salary_avg")
    return df.withColumns({c: r4(c) for c in ("pct_value", "mean_skills")})


@query("agg_null_profile", over_jobs("""
SELECT 'salary_avg' AS column, count(*) - count(salary_avg) AS nulls FROM jobs
UNION ALL SELECT 'company', count(*) - count(company) FROM jobs
UNION ALL SELECT 'part', count(*) - count(part) FROM (
  SELECT CASE WHEN l_discount > 0.05 THEN l_partkey END AS part FROM lineitem)"""))
def _(spark, d):
    lines = table(spark, d, "lineitem").select(F.when(F.col("l_discount") > 0.05, F.col("l_partkey")).alias("part"))
    return (reports.null_profile(jobs(spark, d).select("salary_avg", "company"))
            .unionByName(reports.null_profile(lines)))


@query("agg_describe", over_jobs("""
SELECT count(salary_avg) AS count, round(avg(salary_avg), 4) AS mean, round(stddev_samp(salary_avg), 2) AS std,
       min(salary_avg) AS min, round(quantile_cont(salary_avg, 0.25), 4) AS q25,
       round(quantile_cont(salary_avg, 0.5), 4) AS q50, round(quantile_cont(salary_avg, 0.75), 4) AS q75,
       max(salary_avg) AS max FROM jobs"""))
def _(spark, d):
    df = reports.describe(jobs(spark, d), "salary_avg")
    return df.withColumns({"std": F.round("std", 2), **{c: r4(c) for c in ("mean", "q25", "q50", "q75")}})


@query("agg_duplicate_count", """
SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT lang, text, n_chars FROM documents))
       AS duplicates""")
def _(spark, d):
    return reports.duplicate_count(table(spark, d, "documents").select("lang", "text", "n_chars"))


@query("agg_dominant_value", over_jobs("""
SELECT * FROM (SELECT location, job_level AS top_level, count(*) AS n FROM jobs GROUP BY location, job_level
  QUALIFY row_number() OVER (PARTITION BY location ORDER BY count(*) DESC, job_level) = 1)
JOIN (SELECT location, skill AS top_skill FROM (SELECT location, unnest(extracted_skills) AS skill FROM jobs)
  WHERE skill <> 'r' GROUP BY location, skill
  QUALIFY row_number() OVER (PARTITION BY location ORDER BY count(*) DESC, skill) = 1) USING (location)"""))
def _(spark, d):
    df = jobs(spark, d)
    level = reports.dominant_value(df, "location", "job_level").withColumnRenamed("job_level", "top_level")
    skill = reports.dominant_skill(df, "location").select("location", F.col("skill").alias("top_skill"))
    return level.join(skill, "location")


@query("agg_grouped_median", over_jobs("""
SELECT 3 AS n_keys, search_role, job_level, city, round(median(salary_avg), 4) AS median FROM jobs
  WHERE salary_avg IS NOT NULL GROUP BY search_role, job_level, city
UNION ALL SELECT 2, search_role, job_level, NULL, round(median(salary_avg), 4) FROM jobs
  WHERE salary_avg IS NOT NULL GROUP BY search_role, job_level
UNION ALL SELECT 1, search_role, NULL, NULL, round(median(salary_avg), 4) FROM jobs
  WHERE salary_avg IS NOT NULL GROUP BY search_role
UNION ALL SELECT 0, NULL, NULL, NULL, round(median(salary_avg), 4) FROM jobs"""))
def _(spark, d):
    medians = lookups.grouped_medians(jobs(spark, d), "salary_avg", ["search_role", "job_level", "city"])
    return medians.withColumn("median", r4("median"))


NOISE_SQL = contains_sql("lower(title)", vocab.NOISE_TITLES)
STEPS_SQL = over_jobs(f"""
SELECT 1 AS position, 'title' AS step, count(*) AS before, sum(a)::BIGINT AS after, count(*) - sum(a)::BIGINT AS removed FROM f
UNION ALL SELECT 2, 'noise', sum(a)::BIGINT, sum(a * b)::BIGINT, (sum(a) - sum(a * b))::BIGINT FROM f
UNION ALL SELECT 3, 'salary', sum(a * b)::BIGINT, sum(a * b * c)::BIGINT, (sum(a * b) - sum(a * b * c))::BIGINT FROM f""",
    f"""f AS (SELECT (title <> '')::INTEGER AS a, (NOT {NOISE_SQL})::INTEGER AS b,
         (salary_avg IS NOT NULL)::INTEGER AS c FROM jobs)""")


@query("agg_step_counts", STEPS_SQL)
def _(spark, d):
    return reports.step_counts(jobs(spark, d), [
        ("title", filters.stated(F.col("title"))), ("noise", ~filters.is_noise(F.col("title"))),
        ("salary", F.col("salary_avg").isNotNull())])


@query("agg_impute_coverage", over_jobs("""
SELECT method, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM jobs), 4) AS pct FROM (
  SELECT CASE WHEN salary_avg IS NOT NULL THEN 'actual'
    WHEN company IN (SELECT company FROM jobs WHERE salary_avg IS NOT NULL GROUP BY ALL HAVING count(*) >= 8)
    THEN 'forest' ELSE 'median' END AS method FROM jobs) GROUP BY method"""))
def _(spark, d):
    df = impute.coverage(jobs(spark, d).select("company", "salary_avg"), role="company", min_support=8)
    return df.withColumn("pct", r4("pct"))


@query("agg_location_top", over_jobs(
    "SELECT location, count(*) AS n FROM jobs GROUP BY location ORDER BY n DESC, location LIMIT 10"))
def _(spark, d):
    return reports.location_top(jobs(spark, d))


@query("agg_skill_trend", over_jobs("""
SELECT strftime(date_trunc('month', scraped_at), '%Y-%m') AS period, skill, count(*) AS n FROM skilled GROUP BY ALL""",
    SKILLED_SQL))
def _(spark, d):
    return reports.skill_trend(jobs(spark, d)).withColumn("period", F.date_format("period", "yyyy-MM"))


@query("agg_word_freq_per_role", r"""
SELECT lang, word, count(*) AS n,
       row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word)::INTEGER AS rank
FROM (SELECT lang, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS word FROM documents)
WHERE word <> '' GROUP BY lang, word QUALIFY rank <= 50""")
def _(spark, d):
    return reports.word_freq_per_role(table(spark, d, "documents"), "lang", "text")


@query("agg_role_card", over_jobs("""
SELECT j.search_role, job_count, coalesce(top_skills, '') AS top_skills
FROM (SELECT search_role, count(*) AS job_count FROM jobs GROUP BY ALL) j
LEFT JOIN (SELECT search_role, string_agg(skill, ',' ORDER BY n DESC, skill) AS top_skills FROM (
  SELECT search_role, skill, count(*) AS n FROM skilled GROUP BY search_role, skill
  QUALIFY row_number() OVER (PARTITION BY search_role ORDER BY count(*) DESC, skill) <= 5) GROUP BY ALL) s
USING (search_role)""", SKILLED_SQL))
def _(spark, d):
    cards = reports.role_card(jobs(spark, d))
    return cards.withColumn("top_skills", F.array_join("top_skills", ","))


@query("dq_other_share", over_jobs("""
SELECT round(avg(CASE WHEN standardized_role = 'Other' THEN 100.0::DOUBLE ELSE 0 END), 4) AS other_pct,
       avg(CASE WHEN standardized_role = 'Other' THEN 100.0::DOUBLE ELSE 0 END) > 10 AS warn FROM keyed""", KEYED_SQL))
def _(spark, d):
    return quality.other_share_gate(keyed(spark, d), "standardized_role").withColumn("other_pct", r4("other_pct"))


@query("dq_release_gate", over_jobs("""
SELECT 'min_rows' AS check, n AS value, 1000.0::DOUBLE AS threshold, n >= 1000 AS passed FROM f
UNION ALL SELECT 'blank_descriptions', b, 0.0, b = 0 FROM f
UNION ALL SELECT 'missing_roles', m, 0.0, m = 0 FROM f
UNION ALL SELECT 'other_pct', o, 10.0, o < 10 FROM f
UNION ALL SELECT 'skills_are_lists', 1.0, 1.0, true FROM f""", KEYED_SQL,
    """f AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (trim(job_description) = '')::DOUBLE AS b,
  count(*) FILTER (standardized_role IS NULL)::DOUBLE AS m,
  round(avg(CASE WHEN standardized_role = 'Other' THEN 100.0::DOUBLE ELSE 0 END), 4) AS o FROM keyed)"""))
def _(spark, d):
    return quality.release_gate(keyed(spark, d)).withColumn("value", r4("value"))


@query("dq_step_log", """
SELECT 0 AS position, 'read' AS step, (SELECT count(*) FROM documents) AS after, 0 AS removed
UNION ALL SELECT 1, 'distinct text', (SELECT count(DISTINCT text) FROM documents),
  (SELECT count(*) FROM documents) - (SELECT count(DISTINCT text) FROM documents)
UNION ALL SELECT 2, 'long enough', (SELECT count(DISTINCT text) FROM documents WHERE length(text) >= 200),
  (SELECT count(DISTINCT text) FROM documents WHERE length(text) < 200)""")
def _(spark, d):
    _, log = reports.observed(table(spark, d, "documents"), [
        ("distinct text", lambda df: dedup.dedup_subset(df, ["doc_id"], ["text"])),
        ("long enough", lambda df: filters.min_length(df, "text"))])
    return log
