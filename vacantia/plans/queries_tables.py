"""Queries that run a whole table's preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, text, vocab
from . import board_a, board_b, dashboard, market
from .queries_filters import lexicon_sql
from .queries_scalars import PLACE_CASE, SALARY_SQL, SPARSE_TABLES, by_origin, origin_sql, salary_text, tfidf_sql
from .registry import bands_case_sql, contains_sql, patterns_case_sql, query, words_case_sql
from .tables import jobs, over_jobs


def _raw_a(spark, d):
    return jobs(spark, d).select("id", "title", "company", "location", "job_description", "job_url",
                                 F.col("search_term").alias("search_role"))


@query("board_a_table", over_jobs(f"""
SELECT id, title, coalesce({words_case_sql('lower(title)', vocab.ROLE_KEYWORDS, 'NULL')},
         CASE WHEN sim >= {vocab.ROLE_SIMILARITY_FLOOR} THEN role ELSE 'Other' END) AS standardized_role,
       company, location, {words_case_sql('lower(title)', vocab.SENIORITY_WORDS, "'Mid-level'")} AS seniority,
       length(job_description)::INTEGER AS jd_length, job_description,
       array_to_string({lexicon_sql('lower(job_description)', vocab.SKILLS_FULL)}, ',') AS extracted_skills,
       len({lexicon_sql('lower(job_description)', vocab.SKILLS_FULL)})::INTEGER AS skills_count,
       job_url, search_term AS search_role
FROM jobs LEFT JOIN near USING (title)
WHERE NOT {contains_sql('lower(title)', vocab.NOISE_TITLES)}
  AND {contains_sql('lower(job_description)', vocab.DOMAIN_WORDS)}""", tfidf_sql("jobs").strip()))
def _(spark, d):
    return board_a.standardise(_raw_a(spark, d)).withColumn("extracted_skills", F.array_join("extracted_skills", ","))


def _raw_b(spark, d):
    """Postings of one level have no id; all were collected twice."""
    key = F.when(F.col("priority") == "4-NOT SPECIFIED", " ").otherwise(F.col("id").cast("string"))
    once = jobs(spark, d).select(
        key.alias("id"), F.concat(F.lit(" "), "title").alias("title"), "company", "location", "job_description",
        "job_url", salary_text().alias("salary"), F.col("search_term").alias("search_role"),
        F.lit("indonesia").alias("search_location"), text.format_list(F.col("extracted_skills")).alias("extracted_skills"),
        F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"), F.col("id").alias("_row"))
    twice = once.withColumn("_source", F.explode(F.array(F.lit("first"), F.lit("second"))))
    return twice.withColumn("salary", F.when(F.col("_source") == "first", "Rp 1.000.000").otherwise(F.col("salary")))


LEVEL_CASE = patterns_case_sql("lower(title || ' ' || job_description)", vocab.LEVEL_PATTERNS, "'Tidak Disebutkan'")


@query("board_b_table", over_jobs(f"""
SELECT CASE WHEN priority = '4-NOT SPECIFIED' THEN '' ELSE id::VARCHAR END AS id, title,
  CASE WHEN trim(search_term) = '' THEN 'Other'
       ELSE {patterns_case_sql('lower(search_term)', vocab.ROLE_PATTERNS, "'Other'")} END AS search_role,
  trim(search_term) AS search_role_raw, {LEVEL_CASE} AS job_level, company,
  CASE WHEN location = '' THEN 'Tidak Disebutkan' ELSE {PLACE_CASE} END AS location,
  CASE WHEN location = '' THEN 'Tidak Disebutkan' ELSE location END AS location_raw,
  salary_display, salary_min, salary_max, (salary_min + salary_max) / 2.0::DOUBLE AS salary_avg,
  array_to_string(extracted_skills, ',') AS extracted_skills, skills_count, job_url, job_description,
  'indonesia' AS search_location, strftime(scraped_at, '%Y-%m-%d') AS day
FROM jobs JOIN sal USING (id) WHERE title <> ''
QUALIFY priority <> '4-NOT SPECIFIED'
  OR row_number() OVER (PARTITION BY priority = '4-NOT SPECIFIED', title, company ORDER BY id DESC) = 1""",
    SALARY_SQL))
def _(spark, d):
    df = board_b.clean(_raw_b(spark, d), ["_source", "_row"])
    return (df.withColumn("extracted_skills", F.array_join("extracted_skills", ","))
            .withColumn("day", F.date_format("scraped_at", "yyyy-MM-dd")).drop("scraped_at", "salary"))


# Postings of these levels come from the first board, all others from the second.
FIRST_BOARD = "priority IN ('1-URGENT', '3-MEDIUM')"


def _boards(spark, d):
    base = jobs(spark, d)
    a = (base.filter(FIRST_BOARD)
         .select("id", "title", "company", "city", "location", "job_description", "extracted_skills", "skills_count",
                 "job_url", F.col("search_role").alias("standardized_role"), F.col("raw_level").alias("seniority"),
                 F.length("job_description").alias("jd_length"), F.lit("On-site").alias("work_type"),
                 F.col("search_term").alias("search_role")))
    b = (base.filter(f"NOT {FIRST_BOARD}")
         .select("id", "title", "company", rules.place(F.col("location")).alias("location"), "extracted_skills",
                 "skills_count", "job_url", "search_role", F.col("raw_level").alias("job_level"),
                 F.col("raw_salary").alias("salary_avg"), "job_description", "scraped_at"))
    return a, b


@query("market_merge", over_jobs(f"""
SELECT id, title, search_role, job_level, company, CASE WHEN {FIRST_BOARD} THEN city
         WHEN location = '' THEN 'DKI Jakarta' ELSE {PLACE_CASE} END AS location,
       CASE WHEN NOT {FIRST_BOARD} THEN salary_avg END AS salary_avg, skills_count, job_url
FROM jobs"""))
def _(spark, d):
    return market.merge(*_boards(spark, d)).select(
        "id", "title", "search_role", "job_level", "company", "location", "salary_avg", "skills_count", "job_url")


LOWERED_TITLES = [(label, [w.lower() for w in words]) for label, words in vocab.TITLE_SENIORITY_WORDS]


@query("market_table", over_jobs(f"""
SELECT o.*, m.title, m.search_role, m.job_level, m.company, m.location, m.skills_count, m.job_url, company_hiring_freq,
       {bands_case_sql('company_hiring_freq', vocab.COMPANY_SIZE_BANDS)} AS company_size_proxy,
       {words_case_sql('lower(m.title)', LOWERED_TITLES, "'Tidak Disebutkan'")} AS title_seniority
FROM ({origin_sql('estimated_median', 'coalesce(g3.m, g2.m, g1.m, g0.m)')}) o JOIN m ON o.id = m.id
JOIN (SELECT company, count(*) AS company_hiring_freq FROM m GROUP BY company) f ON m.company = f.company""",
    f"""m AS (SELECT id, title, search_role, job_level, company, CASE WHEN {FIRST_BOARD} THEN city
         WHEN location = '' THEN 'DKI Jakarta' ELSE {PLACE_CASE} END AS location,
       CASE WHEN NOT {FIRST_BOARD} THEN salary_avg END AS salary_avg, skills_count, job_url FROM jobs)""",
    "s AS (SELECT *, trim(split_part(location, ',', 1)) AS city FROM m)", *SPARSE_TABLES[1:]))
def _(spark, d):
    table = market.analysis_table(*_boards(spark, d), keep_source=True)
    return by_origin(table, "title", "search_role", "job_level", "company", "location", "skills_count", "job_url",
                     "company_hiring_freq", "company_size_proxy", "title_seniority")


@query("dashboard_table", over_jobs(f"""
SELECT id, skills_count, salary_avg / 1e6::DOUBLE AS salary_avg_jt, company_hiring_freq,
       {bands_case_sql('company_hiring_freq', vocab.COMPANY_SIZE_BANDS)} AS company_size_proxy
FROM (SELECT *, count(*) OVER (PARTITION BY company) AS company_hiring_freq FROM jobs)
WHERE search_role IN ('Data Scientist', 'Other') AND salary_avg / 1e6::DOUBLE BETWEEN 2.5 AND 60"""))
def _(spark, d):
    raw = jobs(spark, d).select(
        F.col("id").alias("ID"), F.col("company").alias("Company "), F.col("job_level").alias("job_leevl"),
        F.col("search_role").alias("Search Role"), F.col("salary_avg").cast("string").alias("Salary Avg"),
        text.format_list(F.col("extracted_skills")).alias("extracted_skills"))
    _, paid = dashboard.select(dashboard.load(raw), {"search_role": ["Data Scientist", "Other"], "job_level": []}, 2.5, 60.0)
    return paid.select("id", "skills_count", "salary_avg_jt", "company_hiring_freq", "company_size_proxy")
