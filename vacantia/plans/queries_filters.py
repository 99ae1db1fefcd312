"""Queries on filters, look-ups, windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, skills, text, vocab
from ..operators import dedup, filters, lookups, phrases, ranking, reports
from .registry import contains_sql, query, r4, values_sql, words_case_sql
from .tables import jobs, over_jobs, table


@query("filt_noise_keywords", over_jobs(f"""
SELECT id, title FROM jobs WHERE NOT {contains_sql('lower(title)', vocab.NOISE_TITLES)}"""))
def _(spark, d):
    return filters.drop_noise(jobs(spark, d)).select("id", "title")


@query("filt_domain_keywords", f"""
SELECT doc_id FROM documents WHERE {contains_sql('lower(text)', vocab.DOMAIN_WORDS)}""")
def _(spark, d):
    return filters.keep_domain(table(spark, d, "documents"), "text").select("doc_id")


@query("filt_required_nonempty", over_jobs(
    "SELECT id FROM jobs WHERE title <> '' AND company <> '' AND location <> ''"))
def _(spark, d):
    return filters.required(jobs(spark, d), "title", "company", "location").select("id")


@query("filt_dropna_subset", over_jobs(
    "SELECT id FROM jobs WHERE salary_avg IS NOT NULL AND location IS NOT NULL"))
def _(spark, d):
    return filters.dropna_subset(jobs(spark, d), "salary_avg", "location").select("id")


@query("filt_min_length", "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 200")
def _(spark, d):
    return filters.min_length(table(spark, d, "documents"), "text").select("doc_id", "n_chars")


@query("filt_outlier_to_null", over_jobs("""
SELECT id, CASE WHEN raw_salary BETWEEN 1e6 AND 1e8 THEN raw_salary END AS salary FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", filters.outlier_to_null(F.col("raw_salary")).alias("salary"))


@query("filt_isin_multi", over_jobs("""
SELECT id, search_role, job_level FROM jobs
WHERE search_role IN ('Data Scientist', 'Data Engineer') AND job_level IN ('Senior', 'Junior', 'Mid-level')"""))
def _(spark, d):
    chosen = {"search_role": ["Data Scientist", "Data Engineer"], "location": [],
              "job_level": ["Senior", "Junior", "Mid-level"]}
    return filters.facets(jobs(spark, d), chosen).select("id", "search_role", "job_level")


@query("filt_range", over_jobs("SELECT id, salary_avg FROM jobs WHERE salary_avg BETWEEN 5e6 AND 4e7"))
def _(spark, d):
    return filters.in_range(jobs(spark, d), "salary_avg", 5e6, 4e7).select("id", "salary_avg")


@query("filt_facet_domain", over_jobs("""
SELECT facet, value, low, high FROM (
  SELECT 'search_role' AS facet, search_role AS value FROM jobs UNION SELECT 'job_level', job_level FROM jobs
  UNION SELECT 'location', location FROM jobs) t
CROSS JOIN (SELECT min(salary_avg) AS low, max(salary_avg) AS high FROM jobs) b WHERE value IS NOT NULL"""))
def _(spark, d):
    df = jobs(spark, d)
    bounds = filters.facet_bounds(df, "salary_avg").select(F.struct("low", "high")).scalar()
    return (filters.facet_domain(df, "search_role", "job_level", "location")
            .withColumn("_b", bounds).select("facet", "value", "_b.low", "_b.high"))


@query("filt_percentile_trim", over_jobs("""
SELECT id, salary_avg FROM jobs
WHERE salary_avg <= (SELECT quantile_cont(salary_avg, 0.99) FROM jobs)"""))
def _(spark, d):
    return filters.percentile_trim(jobs(spark, d), "salary_avg").select("id", "salary_avg")


@query("filt_stop_skill", over_jobs("""
SELECT id, array_to_string(list_filter(extracted_skills, lambda s: s <> 'r'), ',') AS skills FROM jobs"""))
def _(spark, d):
    kept = filters.without_stop_skill(F.col("extracted_skills"))
    return jobs(spark, d).select("id", F.array_join(kept, ",").alias("skills"))


@query("filt_cap_per_key", over_jobs("""
SELECT id, search_role FROM jobs
QUALIFY row_number() OVER (PARTITION BY search_role ORDER BY scraped_at, id) <= 2000"""))
def _(spark, d):
    return filters.cap_per_key(jobs(spark, d).select("id", "search_role", "scraped_at"),
                               "search_role", ["scraped_at", "id"], 2000).select("id", "search_role")


@query("join_freq_map", over_jobs("""
SELECT id, company, company_hiring_freq
FROM jobs JOIN (SELECT company, count(*) AS company_hiring_freq FROM jobs GROUP BY company) USING (company)"""))
def _(spark, d):
    return lookups.with_group_size(jobs(spark, d).select("id", "company"), "company")


CASCADE_SQL = """
g3 AS (SELECT search_role, job_level, city, median(salary_avg) AS m FROM k
       WHERE search_role IS NOT NULL AND job_level IS NOT NULL AND city IS NOT NULL GROUP BY ALL),
g2 AS (SELECT search_role, job_level, median(salary_avg) AS m FROM k
       WHERE search_role IS NOT NULL AND job_level IS NOT NULL GROUP BY ALL),
g1 AS (SELECT search_role, median(salary_avg) AS m FROM k WHERE search_role IS NOT NULL GROUP BY ALL),
g0 AS (SELECT median(salary_avg) AS m FROM k)
"""
# Cheap, small places leave groups without a known value at every level.
SPARSE = "(priority NOT IN ('3-MEDIUM') OR raw_salary > 9e7) AND search_role <> 'Other' AND city > 'M'"


def _sparse(spark, d):
    df = jobs(spark, d).select("id", "search_role", "job_level", "city", "priority", "raw_salary", "salary_avg")
    return df.withColumn("salary_avg", F.when(F.expr(SPARSE), F.col("salary_avg")))


@query("join_median_cascade", over_jobs("""
SELECT s.id, round(coalesce(g3.m, g2.m, g1.m, g0.m), 4) AS median
FROM s LEFT JOIN g3 USING (search_role, job_level, city) LEFT JOIN g2 USING (search_role, job_level)
LEFT JOIN g1 USING (search_role) CROSS JOIN g0""",
    f"s AS (SELECT id, search_role, job_level, city, CASE WHEN {SPARSE} THEN salary_avg END AS salary_avg FROM jobs)",
    "k AS (SELECT * FROM s WHERE salary_avg IS NOT NULL)", CASCADE_SQL))
def _(spark, d):
    df = lookups.with_median_cascade(_sparse(spark, d), "salary_avg", ["search_role", "job_level", "city"])
    return df.select("id", r4("median").alias("median"))


@query("join_semi_min_support", over_jobs("""
SELECT id, company FROM jobs
WHERE company IN (SELECT company FROM jobs WHERE salary_avg IS NOT NULL GROUP BY company HAVING count(*) >= 8)"""))
def _(spark, d):
    return lookups.semi_min_support(jobs(spark, d).select("id", "company", "salary_avg"),
                                    "company", "salary_avg", 8).select("id", "company")


ORDERED = [("one", ["nation_1"]), ("ten", ["nation_10", "nation_2"]), ("rest", ["nation"])]


@query("join_ordered_rules", f"""
SELECT c_custkey, {words_case_sql('lower(n_name)', ORDERED, "'none'")} AS label
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(spark, d):
    nation = table(spark, d, "nation")
    df = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return df.select("c_custkey", rules.classify_words(F.col("n_name"), ORDERED, "none").alias("label"))


def lexicon_sql(expr: str, lexicon: list[str]) -> str:
    """Sorted skills found by word, one test per skill."""
    w = r"[\p{L}\p{N}_]"
    tests = []
    for s in lexicon:
        body = "".join("\\" + c if c in "+#/.-" else c for c in s)
        head = r"(^|[^\p{L}\p{N}_])" if s[0].isalnum() else w
        tail = r"($|[^\p{L}\p{N}_])" if s[-1].isalnum() else w
        tests.append(f"CASE WHEN regexp_matches({expr}, '{head}{body}{tail}') THEN '{s}' END")
    return f"list_sort(list_filter([{', '.join(tests)}], lambda x: x IS NOT NULL))"


@query("join_lexicon", over_jobs(f"""
SELECT id, array_to_string({lexicon_sql('lower(job_description)', vocab.SKILLS_FULL)}, ',') AS found FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select(
        "id", F.array_join(skills.whole_words(F.col("job_description")), ",").alias("found"))


# Phrases of one to three words as the first sentences of the benchmark have them, and the skills.
PIECES_SQL = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+')"


def windows_sql(source: str, key: str) -> str:
    """Windows of one to three words, with what stands between the words."""
    return f"""
SELECT DISTINCT {key}, array_to_string(p[i:i + 2 * n - 2], '') AS phrase
FROM (SELECT {key}, p, unnest(range(1, len(p) + 1)) AS i FROM (
  SELECT {key}, {PIECES_SQL.format('lower(text)')} AS p FROM {source})), (VALUES (1), (2), (3)) AS v(n)
WHERE regexp_matches(p[i], '^[\\p{{L}}\\p{{N}}_]') AND i + 2 * n - 2 <= len(p)"""


LEXICON_SQL = f"""
lexicon AS (SELECT phrase, min(item_id) AS number, max(item_id) AS last FROM ({windows_sql('benchmark', 'item_id')}) GROUP BY phrase),
inside AS (SELECT doc_id, phrase FROM ({windows_sql('documents', 'doc_id')}) WHERE phrase IN (SELECT phrase FROM lexicon))"""


def _lexicon(spark, d):
    items = table(spark, d, "benchmark")
    return (phrases.windows(items, ["item_id"], "text", [1, 2, 3]).groupBy(F.col("core").alias("phrase"))
            .agg(F.min("item_id").alias("number"), F.max("item_id").alias("last")))


@query("join_lexicon_table", f"""
WITH {LEXICON_SQL}
SELECT phrase, count(*) AS n_docs, min(doc_id) AS first_doc FROM inside GROUP BY phrase""")
def _(spark, d):
    found = phrases.phrases_in(table(spark, d, "documents"), ["doc_id"], "text", _lexicon(spark, d), "phrase")
    return found.groupBy("phrase").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query("join_rules_table", f"""
WITH {LEXICON_SQL}
SELECT doc_id, coalesce(label, 'none') AS label FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN (
  SELECT doc_id, arg_min('item ' || number, (number, phrase)) AS label FROM inside JOIN (SELECT phrase, number FROM lexicon WHERE number = last) USING (phrase)
  GROUP BY doc_id) USING (doc_id)""")
def _(spark, d):
    """The first benchmark item of which a phrase that no other item has stands in the document."""
    rules_ = _lexicon(spark, d).filter("number = last").withColumn("label", F.concat(F.lit("item "), F.col("number").cast("string")))
    return phrases.first_rule(table(spark, d, "documents"), ["doc_id"], "text", rules_, "phrase", "label", "number", "none")


@query("join_role_profile", over_jobs("""
SELECT b.search_role, n, round(n * 100.0::DOUBLE / (SELECT count(*) FROM jobs), 4) AS pct, skill AS top_skill,
       job_level AS top_level, round(mean, 4) AS mean
FROM (SELECT search_role, count(*) AS n, avg(salary_avg) AS mean FROM jobs GROUP BY ALL) b
LEFT JOIN (SELECT search_role, skill FROM (SELECT search_role, unnest(extracted_skills) AS skill FROM jobs)
           WHERE skill <> 'r' GROUP BY search_role, skill
           QUALIFY row_number() OVER (PARTITION BY search_role ORDER BY count(*) DESC, skill) = 1) USING (search_role)
LEFT JOIN (SELECT search_role, job_level FROM jobs GROUP BY search_role, job_level
           QUALIFY row_number() OVER (PARTITION BY search_role ORDER BY count(*) DESC, job_level) = 1)
     USING (search_role)"""))
def role_profile(spark, d):
    df = reports.role_profile(jobs(spark, d))
    return df.withColumns({"pct": r4("pct"), "mean": r4("mean")})


@query("win_group_size", over_jobs(
    "SELECT id, count(*) OVER (PARTITION BY company) AS company_hiring_freq FROM jobs"))
def _(spark, d):
    return lookups.with_group_size(jobs(spark, d).select("id", "company"), "company").drop("company")


@query("win_share_of_total", over_jobs("""
SELECT location, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 4) AS pct
FROM (SELECT location, count(*) AS n FROM jobs GROUP BY location)"""))
def _(spark, d):
    return reports.share_of_total(lookups.key_counts(jobs(spark, d), ["location"]), digits=4)


@query("win_topn_per_group", over_jobs("""
SELECT location, company, n, rank FROM (
  SELECT location, company, count(*) AS n,
         row_number() OVER (PARTITION BY location ORDER BY count(*) DESC, company)::INTEGER AS rank
  FROM jobs GROUP BY location, company) WHERE rank <= 3"""))
def _(spark, d):
    counts = lookups.key_counts(jobs(spark, d), ["location", "company"])
    return ranking.top_per_group(counts, ["location"], [F.desc("n"), "company"], 3, "rank")


for _name, _direction, _fn in (("win_keep_last", "DESC", dedup.keep_last), ("win_keep_first", "ASC", dedup.keep_first)):
    @query(_name, over_jobs(f"""
SELECT id, company, title FROM jobs
QUALIFY row_number() OVER (PARTITION BY company ORDER BY scraped_at {_direction}, id {_direction}) = 1"""))
    def _(spark, d, fn=_fn):
        rows = jobs(spark, d).select("id", "company", "title", "scraped_at")
        return fn(rows, ["company"], ["scraped_at", "id"]).drop("scraped_at")


@query("topk_by_count", over_jobs(
    "SELECT title, count(*) AS n FROM jobs GROUP BY title ORDER BY n DESC, title LIMIT 15"))
def _(spark, d):
    return ranking.top_by_count(jobs(spark, d), "title", 15)


@query("sort_by_metric", over_jobs(
    "SELECT location, round(avg(salary_avg), 4) AS mean FROM jobs GROUP BY location ORDER BY mean DESC"))
def _(spark, d):
    means = jobs(spark, d).groupBy("location").agg(r4(F.avg("salary_avg")).alias("mean"))
    return ranking.sort_by_metric(means, "mean", "location")


@query("sort_fixed_order", over_jobs(f"""
SELECT search_role, coalesce(n, 0) AS n, position FROM
{values_sql(list(enumerate(vocab.ROLE_ORDER)), 'position, search_role')}
LEFT JOIN (SELECT search_role, count(*) AS n FROM jobs GROUP BY ALL) USING (search_role) ORDER BY position"""))
def _(spark, d):
    counts = lookups.key_counts(jobs(spark, d), ["search_role"])
    return ranking.sort_fixed_order(counts, "search_role", vocab.ROLE_ORDER, True, {"n": 0})


@query("array_sort_unique", """
SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))), ' ') AS words
FROM documents""")
def _(spark, d):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    return table(spark, d, "documents").select("doc_id", F.array_join(skills.sorted_unique(words), " ").alias("words"))


@query("setop_union_by_name", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, NULL AS brand FROM customer
UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part
UNION ALL SELECT s_suppkey, s_name, NULL, NULL FROM supplier""")
def _(spark, d):
    return dedup.union_by_name(
        table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                           F.col("c_mktsegment").alias("segment")),
        table(spark, d, "part").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"),
                                       F.col("p_partkey").alias("key")),
        table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))


# A tenth of the lines has no id; the others share the order's id.
LINE_ID = "CASE WHEN l_quantity <= 5 THEN CASE WHEN l_linestatus = 'O' THEN '' END ELSE CAST(l_orderkey AS {0}) END"
LINE_COLS = ("l_partkey AS title, l_suppkey AS company, l_extendedprice, l_shipdate, l_orderkey, "
             "l_linenumber, l_quantity, l_discount, l_tax")


@query("setop_dedup_key", f"""
WITH p AS (SELECT {LINE_ID.format('VARCHAR')} AS id, {LINE_COLS} FROM lineitem)
SELECT id, title, company, l_extendedprice FROM (
  SELECT *, coalesce(id, '') <> '' AS has_id FROM p)
QUALIFY CASE WHEN has_id THEN
    row_number() OVER (PARTITION BY has_id, id ORDER BY l_shipdate DESC, l_extendedprice DESC, title DESC, company DESC,
                       l_discount DESC, l_tax DESC) = 1
  ELSE row_number() OVER (PARTITION BY has_id, title, company ORDER BY l_shipdate DESC, l_extendedprice DESC,
                       title DESC, company DESC, l_discount DESC, l_tax DESC, id DESC NULLS LAST) = 1 END""")
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(f"{LINE_ID.format('STRING')} AS id", *LINE_COLS.split(", "))
    order = ["l_shipdate", "l_extendedprice", "title", "company", "l_discount", "l_tax", "id"]
    return dedup.dedup_key(rows, order).select("id", "title", "company", "l_extendedprice")


@query("setop_dedup_subset", """
SELECT doc_id, source FROM documents
QUALIFY row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) = 1""")
def _(spark, d):
    return dedup.dedup_subset(table(spark, d, "documents"), ["doc_id"], ["lang", "text"]).select("doc_id", "source")


@query("setop_dedup_url", """
SELECT page_id, url FROM (SELECT page_id, url FROM pages UNION ALL SELECT page_id + 1000000, url FROM pages WHERE page_id % 3 = 0)
QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id DESC) = 1""")
def _(spark, d):
    # A third of the pages was collected twice; the later copy comes first here.
    pages = table(spark, d, "pages").select("page_id", "url")
    again = pages.filter("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 1_000_000)
    order = pages.union(again).withColumn("age", -F.col("page_id"))
    return dedup.dedup_url(order, ["age"], "url").drop("age")


@query("setop_seen_ids", """
WITH e AS (SELECT *, CASE event_type WHEN 'signup' THEN NULL WHEN 'view' THEN 'v' || user_id
                     ELSE user_id::VARCHAR END AS key FROM events)
SELECT event_id, event_type FROM e WHERE key IS NULL
UNION ALL SELECT event_id, event_type FROM (
  SELECT * FROM e WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts, event_id) = 1)""")
def _(spark, d):
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    ident = F.when(~kind.isin("signup", "view"), user).otherwise("")
    url = F.when(kind == "view", F.concat(F.lit("v"), user))
    return dedup.drop_seen(table(spark, d, "events"), ["ts", "event_id"],
                           text.identity_key(ident, url)).select("event_id", "event_type")


OWN_SKILLS = ["python", "sql", "r", "git"]


@query("setop_missing_skills", over_jobs(f"""
SELECT id, array_to_string(list_sort(list_filter(extracted_skills, lambda x: x NOT IN ({', '.join(repr(s) for s in OWN_SKILLS)}))), ',')
  AS missing FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", F.array_join(dedup.missing_skills(F.col("extracted_skills"), OWN_SKILLS), ",").alias("missing"))


@query("setop_skill_gap", """
SELECT DISTINCT word AS skill FROM (
  SELECT lang, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)
WHERE lang = 'en' AND word NOT IN (
  SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) FROM documents WHERE lang = 'de')""")
def _(spark, d):
    docs = table(spark, d, "documents").select(
        "lang", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("words"))
    return dedup.skill_gap(docs, "lang", "words", "en", "de")

