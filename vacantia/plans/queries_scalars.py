"""Queries on classification, parsing, features and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, salary, similarity, skills, text, vocab
from ..operators import impute, lookups, reports, vectors
from ..operators.skew import per_distinct
from .queries_filters import CASCADE_SQL, SPARSE, _sparse, lexicon_sql
from .queries_reports import sized, SIZED_SQL
from .registry import (bands_case_sql, patterns_case_sql, query, r4, values_sql, words_case_sql)
from .tables import jobs, over_jobs, table

# ---------------------------------------------------------------- roles


@query("sc_role_keyword", over_jobs(
    f"SELECT id, {words_case_sql('lower(title)', vocab.ROLE_KEYWORDS, 'NULL')} AS role FROM jobs"))
def _(spark, d):
    return jobs(spark, d).select("id", rules.role_by_keyword(F.col("title")).alias("role"))


def tfidf_sql(source: str) -> str:
    """Nearest role of each distinct title, straight from the definition:
    one corpus of the role documents plus the title."""
    docs = similarity.role_term_counts()
    rows = [(i, role, term, float(c)) for i, (role, counts) in enumerate(docs) for term, c in counts.items()]
    n = len(docs) + 1
    return f"""
role_terms AS (SELECT * FROM {values_sql(rows, 'pos, role, term, c')}),
titles AS (SELECT DISTINCT title FROM {source}),
words AS (SELECT title, regexp_extract_all(lower(title), '\\b\\w\\w+\\b') AS w FROM titles),
q AS (SELECT title, term, count(*)::DOUBLE AS c FROM (
    SELECT title, unnest(w) AS term FROM words
    UNION ALL SELECT title, w[i] || ' ' || w[i + 1] FROM words, unnest(range(1, len(w))) AS g(i)) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM role_terms GROUP BY term),
-- role terms with the weight they get in the title's corpus
pairs AS (
    SELECT t.title, r.pos, r.role, r.c, coalesce(q.c, 0) AS qc,
           pow(ln({1 + n}.0::DOUBLE / (1 + d.df + CASE WHEN q.c IS NULL THEN 0 ELSE 1 END)) + 1, 2) AS w
    FROM titles t CROSS JOIN role_terms r JOIN dfs d USING (term)
    LEFT JOIN q ON q.title = t.title AND q.term = r.term),
lens AS (
    SELECT title, sum(q.c * q.c * pow(ln({1 + n}.0::DOUBLE / (2 + coalesce(d.df, 0))) + 1, 2)) AS len2
    FROM q LEFT JOIN dfs d USING (term) GROUP BY title),
sims AS (
    SELECT title, pos, role, sum(qc * c * w) / sqrt(sum(c * c * w) * any_value(len2)) AS sim
    FROM pairs JOIN lens USING (title) GROUP BY ALL),
near AS (
    SELECT title, role, sim FROM sims
    QUALIFY row_number() OVER (PARTITION BY title ORDER BY round(sim, 12) DESC, pos) = 1)"""


@query("sc_role_tfidf", over_jobs(f"""
SELECT id, CASE WHEN sim >= {vocab.ROLE_SIMILARITY_FLOOR} THEN role ELSE 'Other' END AS similar_role,
       round(coalesce(sim, 0), 6) AS similarity,
       coalesce({words_case_sql('lower(title)', vocab.ROLE_KEYWORDS, 'NULL')},
                CASE WHEN sim >= {vocab.ROLE_SIMILARITY_FLOOR} THEN role ELSE 'Other' END) AS standardized_role
FROM jobs LEFT JOIN near USING (title)""", tfidf_sql("jobs").strip()))
def _(spark, d):
    # Titles repeat: each is scored once.
    df = per_distinct(jobs(spark, d).select("id", "title"), ["title"], lambda titles: similarity.with_standard_role(
        similarity.with_role_by_similarity(titles, "title"), "title"))
    return df.select("id", "similar_role", F.round("similarity", 6).alias("similarity"), "standardized_role")


@query("sc_role_regex", over_jobs(f"""
SELECT id, CASE WHEN trim(search_term) = '' THEN 'Other'
           ELSE {patterns_case_sql('lower(search_term)', vocab.ROLE_PATTERNS, "'Other'")} END AS role,
       {patterns_case_sql('lower(title)', vocab.ROLE_PATTERNS, "'Other'")} AS title_role
FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", rules.role_by_pattern(F.col("search_term")).alias("role"),
                                 rules.role_by_pattern(F.col("title")).alias("title_role"))


# ---------------------------------------------------------------- places, levels

PLACE_CASE = patterns_case_sql("lower(location)", vocab.LOCATION_PATTERNS, f"'{vocab.UNMAPPED_LOCATION}'")


@query("sc_location", over_jobs(f"""
SELECT id, CASE WHEN trim(location) IN ('', 'Tidak Disebutkan') OR location IS NULL THEN 'Tidak Disebutkan'
           ELSE {PLACE_CASE} END AS place FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", rules.place(F.col("location")).alias("place"))


@query("sc_level_text", over_jobs(f"""
SELECT id, {patterns_case_sql("lower(title || ' ' || job_description)", vocab.LEVEL_PATTERNS,
                              "'Tidak Disebutkan'")} AS level FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", rules.level_from_text(F.col("title"), F.col("job_description")).alias("level"))


@query("sc_seniority_title", over_jobs(
    f"SELECT id, {words_case_sql('lower(title)', vocab.SENIORITY_WORDS, chr(39) + 'Mid-level' + chr(39))} AS seniority FROM jobs"))
def _(spark, d):
    return jobs(spark, d).select("id", rules.seniority(F.col("title")).alias("seniority"))


LOWERED = [(label, [w.lower() for w in words]) for label, words in vocab.TITLE_SENIORITY_WORDS]


@query("sc_title_seniority_map", over_jobs(f"""
SELECT id, CASE WHEN title IS NULL THEN 'Tidak Disebutkan'
           ELSE {words_case_sql('lower(title)', LOWERED, "'Tidak Disebutkan'")} END AS seniority
FROM (SELECT id, nullif(title, '') AS title FROM jobs)"""))
def _(spark, d):
    return jobs(spark, d).select("id", rules.title_seniority(F.nullif(F.col("title"), F.lit(""))).alias("seniority"))


@query("sc_level_map_regex", over_jobs("""
SELECT id, CASE raw_level WHEN 'Intern' THEN 'Junior' WHEN 'Mid' THEN 'Mid-level'
           WHEN 'Managerial' THEN 'Manager/Head' ELSE raw_level END AS level,
       CASE job_level WHEN 'Mid-level' THEN 'Mid-level-level' ELSE job_level END AS again FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", rules.level_map_regex(F.col("raw_level")).alias("level"),
                                 rules.level_map_regex(F.col("job_level")).alias("again"))


@query("sc_level_map_exact", over_jobs(
    "SELECT id, CASE raw_level WHEN 'Intern' THEN 'Junior' ELSE raw_level END AS level FROM jobs"))
def _(spark, d):
    return jobs(spark, d).select("id", rules.level_map_exact(F.col("raw_level")).alias("level"))


# ---------------------------------------------------------------- salary

# Texts in five styles made from a known amount, and the numbers they mean.
def salary_text():
    n = F.col("amount")

    def grouped(x, mark):
        return F.translate(F.format_number(x, 0), ",", mark)

    return (F.when(F.col("priority") == "1-URGENT", F.concat(
                F.lit("Rp "), grouped(n * 1000, "."), F.lit(" - Rp "), grouped(n * 1500, ".")))
            .when(F.col("priority") == "2-HIGH", F.concat(
                F.lit("Rp "), grouped(n * 10, ","), F.lit(" per month")))
            .when(F.col("priority") == "3-MEDIUM", F.concat(
                F.floor(n / 1000 + 4).cast("string"), F.lit(",5JT - "), F.floor(n / 1000).cast("string"), F.lit(" juta")))
            .when(F.col("priority") == "4-NOT SPECIFIED", "  ")
            .otherwise("Tidak Disebutkan"))


def _dots(expr: str) -> str:
    return f"replace(format('{{:,}}', ({expr})::BIGINT), ',', '.')"


SALARY_SQL = f"""sal AS (
  SELECT id, lo::BIGINT AS salary_min, hi::BIGINT AS salary_max,
    CASE WHEN lo IS NULL THEN 'Tidak Disebutkan'
         WHEN priority = '2-HIGH' THEN 'Rp ' || {_dots('lo')}
         ELSE 'Rp ' || {_dots('lo')} || ' – Rp ' || {_dots('hi')} END AS salary_display
  FROM (SELECT id, priority,
    CASE priority WHEN '1-URGENT' THEN amount * 1000
      WHEN '2-HIGH' THEN CASE WHEN amount * 10 >= 100000 THEN amount * 10 END
      WHEN '3-MEDIUM' THEN (amount // 1000) * 1000000 END AS lo,
    CASE priority WHEN '1-URGENT' THEN amount * 1500
      WHEN '2-HIGH' THEN CASE WHEN amount * 10 >= 100000 THEN amount * 10 END
      WHEN '3-MEDIUM' THEN (amount // 1000) * 1000000 + 4500000 END AS hi FROM jobs))"""


def _salaries(spark, d):
    return (jobs(spark, d).select("id", "city", salary.parse(salary_text()).alias("s")).select("id", "city", "s.*"))


@query("sc_salary_parse", over_jobs("SELECT id, salary_min, salary_max FROM sal", SALARY_SQL))
def _(spark, d):
    return _salaries(spark, d).drop("city", "salary_display")


@query("sc_salary_mid", over_jobs("""
SELECT id, CASE WHEN city < 'M' THEN salary_max::DOUBLE WHEN city > 'P' THEN salary_min::DOUBLE
           ELSE (salary_min + salary_max) / 2.0::DOUBLE END AS salary_avg FROM sal JOIN jobs USING (id)""", SALARY_SQL))
def _(spark, d):
    # Either end is unknown for some places.
    low = F.when(F.col("city") >= "M", F.col("salary_min"))
    high = F.when(F.col("city") <= "P", F.col("salary_max"))
    return _salaries(spark, d).select("id", salary.midpoint(low, high).alias("salary_avg"))


@query("sc_salary_display", over_jobs("SELECT id, salary_display FROM sal", SALARY_SQL))
def _(spark, d):
    return _salaries(spark, d).select("id", "salary_display")


@query("sc_salary_source", over_jobs("""
SELECT id, CASE WHEN salary_avg IS NULL THEN 'missing' ELSE 'actual' END AS salary_source FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", salary.source_flag(F.col("salary_avg")).alias("salary_source"))


# ---------------------------------------------------------------- skills, features

# Words that stand in the documents, besides the default list.
TEXT_WORDS = [*vocab.SKILLS_FULL, "license", "the", "de", "der", "la", "mit license", "è"]


@query("sc_skills_word", f"""
SELECT doc_id, array_to_string({lexicon_sql('lower(text)', TEXT_WORDS)}, ',') AS found FROM documents""")
def _(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.array_join(skills.whole_words(F.col("text"), TEXT_WORDS), ",").alias("found"))


SUB_WORDS = [*vocab.SKILLS_SHORT_WITH_LARAVEL, "gin", "mid", "er t"]


@query("sc_skills_substring", "SELECT doc_id, array_to_string(list_sort(list_filter(["
       + ", ".join(f"CASE WHEN contains(lower(text), '{s}') THEN '{s}' END" for s in SUB_WORDS)
       + "], lambda x: x IS NOT NULL)), ',') AS found FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.array_join(skills.substrings(F.col("text"), SUB_WORDS), ",").alias("found"))


@query("sc_skills_count", over_jobs("SELECT id, len(extracted_skills)::INTEGER AS skills_count FROM jobs"))
def _(spark, d):
    return jobs(spark, d).select("id", F.size("extracted_skills").alias("skills_count"))


@query("sc_text_length", "SELECT doc_id, length(text)::INTEGER AS jd_length FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length("text").alias("jd_length"))


@query("sc_bucket", over_jobs(f"""
SELECT id, {bands_case_sql('skills_count', vocab.SKILL_COUNT_BANDS)} AS bucket FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", rules.band(F.col("skills_count"), vocab.SKILL_COUNT_BANDS).alias("bucket"))


@query("sc_company_size", over_jobs("SELECT id, freq, size_band FROM sized", SIZED_SQL))
def _(spark, d):
    return sized(spark, d).select("id", "freq", "size_band")


@query("sc_skill_vector", over_jobs("""
SELECT id, array_to_string(list_transform((SELECT list(skill ORDER BY n DESC, skill) FROM (
    SELECT skill, count(*) AS n FROM (SELECT unnest(extracted_skills) AS skill FROM jobs) GROUP BY skill
    ORDER BY n DESC, skill LIMIT 50)),
  lambda s: list_contains(extracted_skills, s)::INTEGER), '') AS bits FROM jobs"""))
def _(spark, d):
    df = reports.skill_vector(jobs(spark, d))
    return df.select("id", F.array_join(F.col("skill_vector").cast("array<string>"), "").alias("bits"))


@query("sc_work_type", over_jobs("""
SELECT id, CASE WHEN location LIKE '%(On-site)%' THEN 'On-site' WHEN location LIKE '%(Remote)%' THEN 'Remote'
           WHEN location LIKE '%(Hybrid)%' THEN 'Hybrid' ELSE 'Unknown' END AS work_type FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", F.coalesce(text.work_type(F.col("location")), F.lit("Unknown")).alias("work_type"))


@query("sc_city", over_jobs("SELECT city, count(*) AS n FROM jobs GROUP BY city"))
def _(spark, d):
    cities = jobs(spark, d).select(text.city(F.col("location")).alias("city"))
    return lookups.key_counts(cities, ["city"])


# ---------------------------------------------------------------- models

@query("ml_label_encode", over_jobs("""
SELECT id, (dense_rank() OVER (ORDER BY coalesce(location, 'nan')) - 1) AS location_code,
       (dense_rank() OVER (ORDER BY coalesce(level, 'nan')) - 1) AS level_code
FROM (SELECT id, location, CASE WHEN job_level <> 'Senior' THEN job_level END AS level FROM jobs)"""))
def _(spark, d):
    df = jobs(spark, d).select("id", "location", F.when(F.col("job_level") != "Senior", F.col("job_level")).alias("level"))
    return impute.label_encode(df, ["location", "level"]).select("id", "location_code", "level_code")


SPARSE_TABLES = (
    f"s AS (SELECT id, search_role, job_level, city, CASE WHEN {SPARSE} THEN salary_avg END AS salary_avg FROM jobs)",
    "k AS (SELECT * FROM s WHERE salary_avg IS NOT NULL)", CASCADE_SQL,
    "sup AS (SELECT search_role, true AS supported FROM k WHERE search_role IS NOT NULL GROUP BY ALL HAVING count(*) >= 30)")

FILLED_SQL = over_jobs("""
SELECT s.id, round(CASE WHEN s.salary_avg IS NULL AND sup.supported IS NULL
                        THEN coalesce(g3.m, g2.m, g1.m, g0.m) ELSE s.salary_avg END, 4) AS salary_avg,
       CASE WHEN s.salary_avg IS NOT NULL THEN 'actual' WHEN sup.supported IS NULL THEN 'estimated_median'
            ELSE 'missing' END AS salary_source
FROM s LEFT JOIN g3 USING (search_role, job_level, city) LEFT JOIN g2 USING (search_role, job_level)
LEFT JOIN g1 USING (search_role) CROSS JOIN g0 LEFT JOIN sup USING (search_role)""", *SPARSE_TABLES)


@query("ml_median_impute", FILLED_SQL)
def _(spark, d):
    df = impute.median_impute(_sparse(spark, d), ["search_role", "job_level", "city"])
    return df.select("id", r4("salary_avg").alias("salary_avg"), "salary_source")


def _features(spark, d):
    return _sparse(spark, d).join(jobs(spark, d).select("id", "skills_count"), "id")


# A forest's numbers cannot come from SQL: its rows are compared by origin and bounds, all others by value.
IN_BOUNDS = f"salary_avg BETWEEN {vocab.SALARY_LOW} AND {vocab.SALARY_HIGH}"


def by_origin(df, *more: str):
    forest = F.col("salary_source") == "estimated_rf"
    return df.select("id", "salary_source", r4(F.when(~forest, F.col("salary_avg"))).alias("exact"),
                     F.when(forest, F.expr(IN_BOUNDS)).alias("in_bounds"), *more)


def origin_sql(rest: str, median: str) -> str:
    """Origin, exact value and bounds of each row; ``rest`` is the origin of rows that no forest fills."""
    return f"""
SELECT s.id, CASE WHEN s.salary_avg IS NOT NULL THEN 'actual' WHEN sup.supported THEN 'estimated_rf' ELSE '{rest}' END AS salary_source,
       round(CASE WHEN s.salary_avg IS NULL AND sup.supported IS NULL THEN {median} ELSE s.salary_avg END, 4) AS exact,
       CASE WHEN s.salary_avg IS NULL AND sup.supported THEN true END AS in_bounds
FROM s LEFT JOIN g3 USING (search_role, job_level, city) LEFT JOIN g2 USING (search_role, job_level)
LEFT JOIN g1 USING (search_role) CROSS JOIN g0 LEFT JOIN sup USING (search_role)"""


@query("ml_rf_impute", over_jobs(origin_sql("missing", "NULL"), *SPARSE_TABLES))
def _(spark, d):
    return by_origin(impute.forest_impute(_features(spark, d)))


@query("ml_hybrid_impute", over_jobs(origin_sql("estimated_median", "coalesce(g3.m, g2.m, g1.m, g0.m)"), *SPARSE_TABLES))
def _(spark, d):
    return by_origin(impute.hybrid_impute(_features(spark, d)))


@query("ml_feature_importance", """
SELECT unnest(['search_role', 'job_level', 'city', 'skills_count']) AS feature, true AS in_range, 1.0::DOUBLE AS total""")
def _(spark, d):
    found = impute.feature_importance(_features(spark, d))
    total = found.agg(F.round(F.sum("importance"), 6)).scalar()
    return found.select("feature", F.col("importance").between(0, 1).alias("in_range"), total.alias("total"))


@query("ml_cv_scores", over_jobs("""
SELECT fold::VARCHAR AS fold, (SELECT count(*) FROM t) - count(*) AS trained, count(*) AS tested, true AS plausible FROM t GROUP BY fold
UNION ALL SELECT 'mean', 4 * count(*), count(*), true FROM t""", *SPARSE_TABLES,
    "t AS (SELECT id % 5 AS fold FROM k JOIN sup USING (search_role))"))
def _(spark, d):
    scores = impute.cv_scores(_features(spark, d), ["id"], fold=F.col("id") % 5)
    finite = (F.col("mae") >= 0) & (F.col("mae") < float("inf")) & (F.col("r2") <= 1)
    return scores.select("fold", "trained", "tested", finite.alias("plausible"))


HISTOGRAM_SQL = over_jobs("""
SELECT salary_source, bin, n, source_rows, round(source_rows * 100.0::DOUBLE / (SELECT count(*) FROM v), 4) AS source_pct
FROM (SELECT salary_source, bin, count(*) AS n FROM (
        SELECT salary_source, CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * 40), 39) ELSE 0 END::INTEGER AS bin
        FROM v JOIN b USING (salary_source)) GROUP BY ALL) JOIN b USING (salary_source)""",
    *SPARSE_TABLES[:3],
    """v AS (SELECT coalesce(s.salary_avg, g3.m, g2.m, g1.m, g0.m) / 1e6::DOUBLE AS x,
       CASE WHEN s.salary_avg IS NULL THEN 'estimated_median' ELSE 'actual' END AS salary_source
       FROM s LEFT JOIN g3 USING (search_role, job_level, city) LEFT JOIN g2 USING (search_role, job_level)
       LEFT JOIN g1 USING (search_role) CROSS JOIN g0)""",
    "b AS (SELECT salary_source, min(x) AS lo, max(x) AS hi, count(*) AS source_rows FROM v GROUP BY ALL)")


@query("ml_impute_validation", HISTOGRAM_SQL)
def _(spark, d):
    # Without a supported role every missing value is filled by a median.
    filled = impute.median_impute(_sparse(spark, d), ["search_role", "job_level", "city"], min_support=1 << 62)
    return impute.source_histogram(filled).withColumn("source_pct", r4("source_pct"))


@query("ml_cosine_topk", """
SELECT e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.v), 6) AS similarity
FROM embeddings e, (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0) q
ORDER BY list_cosine_similarity(e.embedding::DOUBLE[], q.v) DESC, vec_id LIMIT 10""")
def _(spark, d):
    vectors = table(spark, d, "embeddings")
    query_vector = vectors.filter("vec_id = 0").select("embedding").scalar()
    best = similarity.nearest(vectors, "embedding", query_vector, 10, ["vec_id"])
    return best.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query("ml_cosine_topk_many", """
SELECT q.vec_id AS query_id, e.vec_id, (row_number() OVER (PARTITION BY q.vec_id ORDER BY
       round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 12) DESC, e.vec_id))::INT AS rank,
       round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS similarity
FROM embeddings e, (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 50 = 0) q QUALIFY rank <= 10""")
def _(spark, d):
    """The nearest ten of every fiftieth vector, by clusters."""
    table_ = table(spark, d, "embeddings")
    rows, clusters = vectors.index(table_, ["vec_id"], "embedding")
    queries = table_.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    best, _ = vectors.nearest(queries, ["query_id"], "embedding", rows, clusters, ["vec_id"], 10)
    return best.withColumn("similarity", F.round("similarity", 6))
