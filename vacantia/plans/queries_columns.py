"""Queries on projections, cleaning and page fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html, text, vocab
from ..operators import columns
from .registry import query
from .tables import jobs, over_jobs, table

CORE = ["id", "title", "company", "absent", "location"]


@query("proj_select_existing", over_jobs("SELECT id, title, company, location FROM jobs"))
def _(spark, d):
    return columns.select_existing(jobs(spark, d), CORE)


@query("proj_reorder", over_jobs("SELECT company, id, city, priority FROM jobs"))
def _(spark, d):
    return columns.reorder(jobs(spark, d).select("id", "city", "company", "priority"), ["company", "absent", "id"])


@query("proj_rename", over_jobs(
    "SELECT id, priority AS job_level, search_role AS standardized_role, city AS location FROM jobs"))
def _(spark, d):
    names = {"priority": "job_level", "search_role": "standardized_role", "city": "location", "job_leevl": "x"}
    return columns.rename(jobs(spark, d).select("id", "priority", "search_role", "city"), names)


@query("proj_drop_ignore", over_jobs("SELECT id, company FROM jobs"))
def _(spark, d):
    return columns.drop_ignore(jobs(spark, d).select("id", "company", "city", "title"), "city", "title", "absent")


@query("proj_normalise_headers", "SELECT o_orderkey AS order_key, o_orderstatus AS status FROM orders")
def _(spark, d):
    df = table(spark, d, "orders").select(F.col("o_orderkey").alias(" Order Key "), F.col("o_orderstatus").alias("STATUS"))
    return columns.normalise_headers(df)


@query("proj_keep_raw_copy", over_jobs("""
SELECT id, location AS location_raw, search_term AS search_term_raw, upper(location) AS location,
       lower(search_term) AS search_term FROM jobs"""))
def _(spark, d):
    df = columns.keep_raw_copy(jobs(spark, d).select("id", "location", "search_term"), "location", "search_term")
    return df.withColumns({"location": F.upper("location"), "search_term": F.lower("search_term")})


@query("proj_default_column", over_jobs("SELECT id, skills_count, title, 'board' AS source FROM jobs"))
def _(spark, d):
    df = jobs(spark, d).select("id", "extracted_skills", "title")
    df = columns.default_column(df, "skills_count", F.size("extracted_skills"))
    df = columns.default_column(df, "title", F.lit("unused"))
    return columns.default_column(df, "source", F.lit("board")).drop("extracted_skills")


@query("clean_trim_strings", """
SELECT c_custkey, c_name AS name, c_mktsegment AS segment, c_acctbal FROM customer""")
def _(spark, d):
    # Blanks, a no-break space, a tab and a line break around the values.
    df = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("  \t"), "c_name", F.lit("  ")).alias("name"),
        F.concat(F.lit("\n"), "c_mktsegment", F.lit("\r\n")).alias("segment"), "c_acctbal")
    return columns.trim_strings(df)


@query("clean_fill_sentinel", over_jobs("""
SELECT id, CASE WHEN location IS NULL OR location = '' THEN 'Tidak Disebutkan' ELSE location END AS location,
       CASE WHEN title = '' THEN '?' ELSE title END AS title FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", text.fill_sentinel(F.col("location")).alias("location"),
                                 text.fill_sentinel(F.col("title"), "?").alias("title"))


@query("clean_replace_value", over_jobs("""
SELECT job_level, count(*) AS n, (SELECT count(*) FROM jobs WHERE job_level = 'Tidak Disebutkan') AS replaced
FROM (SELECT CASE WHEN job_level = 'Tidak Disebutkan' THEN 'Mid-level' ELSE job_level END AS job_level FROM jobs)
GROUP BY 1"""))
def _(spark, d):
    df, count = columns.replace_and_count(jobs(spark, d), "job_level", vocab.NOT_STATED, "Mid-level")
    return df.groupBy("job_level").agg(F.count(F.lit(1)).alias("n")).withColumn("replaced", count.scalar())


@query("clean_to_numeric", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_retailprice END AS price FROM part""")
def _(spark, d):
    raw = (F.when(F.col("p_type") == "SMALL", F.concat(F.lit(" "), F.col("p_retailprice").cast("string")))
           .when(F.col("p_type") == "PROMO", F.concat(F.lit("Rp "), F.col("p_retailprice").cast("string")))
           .otherwise(F.col("p_retailprice").cast("string")))
    return table(spark, d, "part").select("p_partkey", text.to_number(raw).alias("price"))


@query("clean_to_timestamp", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS at
FROM events""")
def _(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = F.when(F.col("event_type") == "error", "not a date").otherwise(iso)
    parsed = text.to_time(raw)
    return table(spark, d, "events").select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"))


@query("clean_unit_scale", over_jobs("SELECT id, salary_avg / 1e6::DOUBLE AS salary_avg_jt FROM jobs"))
def _(spark, d):
    return jobs(spark, d).select("id", text.scale(F.col("salary_avg")).alias("salary_avg_jt"))


@query("clean_clip", over_jobs("""
SELECT id, least(greatest(raw_salary, 1e6::DOUBLE), 1e8::DOUBLE) AS clipped,
       CASE WHEN salary_avg IS NOT NULL THEN least(greatest(salary_avg, 2e7::DOUBLE), 5e7::DOUBLE) END AS narrow
FROM jobs"""))
def _(spark, d):
    return jobs(spark, d).select("id", text.clip(F.col("raw_salary")).alias("clipped"),
                                 text.clip(F.col("salary_avg"), 2e7, 5e7).alias("narrow"))


@query("clean_parse_list_literal", """
SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN '' ELSE p_brand || '|' || p_name END AS joined,
       CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 0 ELSE 2 END AS n FROM part""")
def _(spark, d):
    kind = F.col("p_type")
    raw = (F.when(kind == "ECONOMY", F.concat(F.lit("['"), "p_brand", F.lit("', '"), "p_name", F.lit("']")))
           .when(kind == "LARGE", F.concat(F.lit('["'), "p_brand", F.lit('", "'), "p_name", F.lit('"]')))
           .when(kind.isin("MEDIUM", "STANDARD"), F.concat(F.lit("['"), "p_brand", F.lit("','"), "p_name", F.lit("']")))
           .when(kind == "PROMO", F.lit("nan")))
    df = table(spark, d, "part").select("p_partkey", text.parse_list(raw).alias("items"))
    return df.select("p_partkey", F.array_join("items", "|").alias("joined"), F.size("items").alias("n"))


@query("clean_parse_list_mixed", """
SELECT p_partkey, 'it''s ' || p_name || CASE WHEN p_size % 2 = 0 THEN '|' || p_size || '|?|True' ELSE '' END AS joined,
       CASE WHEN p_size % 2 = 0 THEN 4 ELSE 1 END AS n FROM part""")
def _(spark, d):
    """Tuples, lists with numbers, names and missing items, trailing commas, escapes and joined strings."""
    text_ = F.concat(F.lit("'it\\'s '  \""), "p_name", F.lit('"'))
    raw = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("["), text_, F.lit(", "), F.col("p_size").cast("string"), F.lit(", None, True]"))).otherwise(
        F.concat(F.lit("("), text_, F.lit(",)")))
    df = table(spark, d, "part").select("p_partkey", text.parse_list(raw).alias("items"))
    return df.select("p_partkey", F.array_join("items", "|", "?").alias("joined"), F.size("items").alias("n"))


@query("clean_parse_list_lenient", """
SELECT p_partkey, p_brand || '|' || p_name AS joined FROM part""")
def _(spark, d):
    raw = F.concat(F.lit("[ '"), "p_brand", F.lit("', , \""), "p_name", F.lit("\" ,]"))
    return table(spark, d, "part").select(
        "p_partkey", F.array_join(text.parse_list_lenient(raw), "|").alias("joined"))


@query("clean_split_city", over_jobs("SELECT id, city FROM jobs"))
def _(spark, d):
    return jobs(spark, d).select("id", text.city(F.col("location")).alias("city"))


STRIP_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace({0},
  '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->', ' ', 'g'),
  '(?s)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"""


@query("clean_strip_html", f"SELECT page_id, {STRIP_SQL.format('html')} AS content FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", text.strip_html(F.col("html")).alias("content"))


@query("clean_url_canonical", """
SELECT page_id,
  CASE WHEN url LIKE 'https:%' THEN split_part(url, '?', 1) WHEN contains(url, '.com/')
       THEN 'https://board.example/item/' || page_id ELSE '' END AS url
FROM pages""")
def _(spark, d):
    raw = (F.when(F.col("url").startswith("https:"), F.col("url"))
           .when(F.col("url").contains(".com/"), F.concat(F.lit("/item/"), F.col("page_id").cast("string"), F.lit("?a=1")))
           .otherwise(F.concat(F.lit("ftp:"), "url")))
    return table(spark, d, "pages").select("page_id", text.canonical_url(raw, "https://board.example").alias("url"))


@query("extract_url_id", over_jobs("SELECT id, id::VARCHAR AS url_id, '' AS none FROM jobs"))
def _(spark, d):
    return jobs(spark, d).select("id", text.url_id(F.col("job_url")).alias("url_id"),
                                 text.url_id(F.col("title")).alias("none"))


def inner_sql(name):
    return STRIP_SQL.format(f"regexp_extract(html, '(?is)<{name}\\b[^>]*>(.*?)</{name}>', 1)")


@query("extract_html_field", "SELECT page_id, coalesce(" + ", ".join(
    f"nullif({inner_sql(n)}, '')" for n in ("h3", "h1", "title")) + ", '') AS heading FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", html.first_text(F.col("html"), ["h3", "h1", "title"]).alias("heading"))


# A paragraph that is not closed ends where the next begins, or with the article.
LONGEST_SQL = f"""
WITH b AS (
  SELECT page_id, list_transform(regexp_extract_all(html, '(?is)<div\\b[^>]*>(.*?)</div>', 1), lambda x: {STRIP_SQL.format('x')}) AS blocks,
         list_transform(list_concat(
           regexp_extract_all(html, '(?is)<li\\b[^>]*>(.*?)</li>', 1),
           list_transform(string_split(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'), '<p')[2:],
                          lambda x: regexp_extract(x, '(?s)^[^>]*>(.*?)(?:</p|</article|$)', 1))), lambda x: {STRIP_SQL.format('x')}) AS pieces
  FROM pages),
c AS (
  SELECT page_id, list_filter(blocks, lambda x: length(x) > 50) AS long_ones,
         array_to_string(list_filter(pieces, lambda x: x <> ''), chr(10)) AS joined FROM b)
SELECT page_id, CASE
  WHEN len(long_ones) > 0 THEN long_ones[list_position(list_transform(long_ones, lambda x: length(x)),
                                                       list_max(list_transform(long_ones, lambda x: length(x))))]
  WHEN length(joined) > 100 THEN joined ELSE '' END AS block
FROM c"""


@query("extract_longest_block", LONGEST_SQL)
def _(spark, d):
    return table(spark, d, "pages").select("page_id", html.longest_text(F.col("html"), ["div"], "p, li").alias("block"))


@query("extract_nested_block", f"""
SELECT page_id, 'before ' || {STRIP_SQL.format('html')} || ' after' AS panel, {STRIP_SQL.format('html')} AS description,
       'short' AS field, {inner_sql('h1')} AS heading
FROM pages""")
def _(spark, d):
    """Every page inside two more levels of the elements that it holds itself."""
    page = F.concat(F.lit('<div class="wide panel">before '), F.lit("<div id='FEA_VJOBS_1'>"), "html",
                    F.lit("</div> after</div><div>short</div>"))
    found = table(spark, d, "pages").select("page_id", page.alias("page"))
    return found.select(
        "page_id", html.longest_text(F.col("page"), ['[data-automation="jobAdDetails"]', "div.panel", 'div[id*="FEA_VJOBS"]'], "p").alias("panel"),
        html.longest_text(F.col("page"), ["section div", 'div.panel div[id*="FEA_VJOBS"]', "div"], "p").alias("description"),
        html.first_text(F.col("page"), ["h4", "div:not([id]):not([class])"]).alias("field"),
        html.first_text(F.col("page"), ["#FEA_VJOBS_1 article h1"]).alias("heading"))


LINK = r"(?is)<a\b[^>]*>(.*?)</a>"


@query("join_multi_values", f"""
SELECT page_id, array_to_string(list_filter(list_transform(regexp_extract_all(html, $${LINK}$$, 1),
       lambda x: {STRIP_SQL.format('x')}), lambda x: x <> ''), ', ') AS links
FROM pages""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", text.join_matches(F.col("html"), LINK).alias("links"))


@query("clean_dedup_key", over_jobs("""
SELECT id, CASE priority WHEN '5-LOW' THEN job_url WHEN '1-URGENT' THEN NULL ELSE id::VARCHAR END AS key
FROM jobs"""))
def _(spark, d):
    job_id = F.when(F.col("priority").isin("5-LOW", "1-URGENT"), "").otherwise(F.col("id").cast("string"))
    url = F.when(F.col("priority") != "1-URGENT", F.col("job_url")).otherwise("")
    return jobs(spark, d).select("id", text.identity_key(job_id, url).alias("key"))
