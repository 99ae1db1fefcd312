"""Queries on readers and writers: the given tables are written to the shared
folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import reports
from ..shared import new_path
from ..sources import readers, writers
from .queries_reports import SUMMARY_SQL, KEYED_SQL, _flat_summary, keyed
from .registry import query
from .tables import jobs, over_jobs, table

HEADER = ["id", "title", "company", "note"]


def _lines(spark, d):
    """One raw record per part: some with a field too many, some too short,
    some with quoted separators, quotes and line breaks."""
    key = F.col("p_partkey").cast("string")
    quoted = F.concat(F.lit('"a ""b"";\n'), "p_name", F.lit('"'))
    title = F.when(F.col("p_size") > 25, quoted).otherwise(F.col("p_name"))
    tail = (F.when(F.col("p_type") == "PROMO", F.concat(F.lit(";"), "p_type", F.lit(";surplus")))
            .when(F.col("p_type") == "SMALL", F.lit(""))
            .otherwise(F.concat(F.lit(";"), "p_type")))
    return table(spark, d, "part").select("p_partkey", F.concat_ws(";", key, title, "p_brand").alias("head"), tail.alias("tail"))


def _delimited(spark, d):
    """Files of those records, each starting with a byte order mark and the header."""
    path = new_path(spark, "delimited")
    # The row number inside the partition, which becomes one file.
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    head = F.when(within == 0, F.lit(writers.BOM + ";".join(HEADER) + "\n")).otherwise("")
    _lines(spark, d).select(F.concat(head, "head", "tail").alias("value")).write.text(path)
    return path


TITLE_SQL = """CASE WHEN p_size > 25 THEN 'a "b";' || chr(10) || p_name ELSE p_name END"""


@query("src_csv_delim", f"""
SELECT p_partkey::VARCHAR AS id, {TITLE_SQL} AS title, p_brand AS company,
       CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_type END AS note
FROM part WHERE p_type <> 'PROMO'""")
def _(spark, d):
    return readers.read_delimited(spark, _delimited(spark, d), HEADER)


@query("src_malformed_audit", f"""
SELECT CASE WHEN p_type = 'PROMO' THEN 5 ELSE 3 END AS n_fields, row_number() OVER (ORDER BY p_partkey) + 1 AS line_no,
       p_partkey::VARCHAR || '|' || {TITLE_SQL} || '|' || p_brand || CASE WHEN p_type = 'PROMO' THEN '|PROMO|surplus' ELSE '' END AS preview
FROM part QUALIFY p_type IN ('PROMO', 'SMALL')""")
def _(spark, d):
    audit = readers.audit_delimited(spark, _delimited(spark, d))
    return audit.select("n_fields", "line_no", F.array_join("preview", "|").alias("preview"))


FLAT = ["id", "title", "search_role", "company", "location", "salary_avg", "extracted_skills",
        "skills_count", "job_description", "scraped_at"]
FLAT_SCHEMA = ("id bigint, title string, search_role string, company string, location string, salary_avg double, "
               "extracted_skills string, skills_count int, job_description string, scraped_at timestamp_ntz")
FLAT_SQL = over_jobs("""
SELECT id, nullif(title, '') AS title, search_role, company, nullif(location, '') AS location, salary_avg,
       array_to_string(extracted_skills, '|') AS skills, skills_count, job_description,
       strftime(scraped_at, '%Y-%m-%d') AS day FROM jobs""")


def _read_back(df):
    """Texts and lists as they were written."""
    return df.select(
        "id", F.nullif(F.col("title"), F.lit("")).alias("title"), "search_role", "company",
        F.nullif(F.col("location"), F.lit("")).alias("location"), "salary_avg",
        F.array_join(text.parse_list(F.col("extracted_skills")), "|").alias("skills"),
        "skills_count", "job_description", F.date_format("scraped_at", "yyyy-MM-dd").alias("day"))


@query("src_csv_plain", FLAT_SQL)
def _(spark, d):
    path = new_path(spark, "plain")
    writers.write_csv(jobs(spark, d).select(*FLAT), path, bom=False)
    return _read_back(readers.read_plain(spark, path, FLAT_SCHEMA))


@query("sink_csv_full", FLAT_SQL)
def _(spark, d):
    path = new_path(spark, "full")
    writers.write_csv(jobs(spark, d).select(*FLAT), path)
    return _read_back(readers.read_plain(spark, path, FLAT_SCHEMA, multi_line=False))


@query("src_csv_glob_union", """
SELECT o_orderkey::VARCHAR AS id, o_orderstatus AS title, NULL AS company FROM orders
UNION ALL SELECT c_custkey::VARCHAR, NULL, c_name FROM customer""")
def _(spark, d):
    base = new_path(spark, "glob")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("title"))
    buyers = table(spark, d, "customer").select(F.col("c_name").alias("company"), F.col("c_custkey").alias("id"))
    writers.write_csv(orders, f"{base}/checkpoint_a")
    writers.write_csv(buyers, f"{base}/checkpoint_b")
    return readers.read_glob(spark, f"{base}/checkpoint_*/*.csv").select("id", "title", "company")


@query("sink_csv_projected", over_jobs("""
SELECT id, nullif(title, '') AS title, standardized_role, company, nullif(location, '') AS location, seniority,
       job_description, array_to_string(extracted_skills, '|') AS skills, skills_count, job_url, search_role
FROM keyed""", KEYED_SQL))
def _(spark, d):
    path = new_path(spark, "projected")
    writers.write_projected(keyed(spark, d), path)
    schema = ("id bigint, title string, standardized_role string, company string, location string, seniority string, "
              "job_description string, skills string, skills_count int, job_url string, search_role string")
    back = readers.read_plain(spark, path, schema)
    return back.withColumns({"title": F.nullif(F.col("title"), F.lit("")),
                             "location": F.nullif(F.col("location"), F.lit("")),
                             "skills": F.array_join(text.parse_list(F.col("skills")), "|")})


@query("sink_csv_slim", over_jobs("""
SELECT id, standardized_role, company, seniority, skills_count, job_url FROM keyed""", KEYED_SQL))
def _(spark, d):
    path = new_path(spark, "slim")
    writers.write_slim(keyed(spark, d), path)
    schema = ", ".join(f"{c} {'bigint' if c == 'id' else 'int' if c == 'skills_count' else 'string'}"
                       for c in writers.SLIM_COLUMNS)
    return readers.read_plain(spark, path, schema).select(
        "id", "standardized_role", "company", "seniority", "skills_count", "job_url")


RECORD_SQL = over_jobs("""
SELECT id, title, company, location, salary_avg, array_to_string(extracted_skills, '|') AS skills, false AS described
FROM jobs""")


@query("sink_json_light", RECORD_SQL)
def _(spark, d):
    path = new_path(spark, "light")
    writers.write_records_light(jobs(spark, d).select(*FLAT), path)
    back = spark.read.json(path)
    return back.select("id", "title", "company", "location", "salary_avg",
                       F.array_join("extracted_skills", "|").alias("skills"),
                       F.lit("job_description" in back.columns).alias("described"))


@query("src_json_records", """
SELECT p_brand AS brand, p_partkey::VARCHAR AS id, p_name AS title, p_size AS size FROM part""")
def _(spark, d):
    # Every line is an array of one record; a reader of arrays yields records.
    path = new_path(spark, "records")
    record = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"),
                                F.col("p_brand").alias("brand"), F.col("p_size").alias("size")))
    table(spark, d, "part").select(F.concat(F.lit("["), record, F.lit("]")).alias("value")).write.text(path)
    return readers.read_records(spark, path, "id string, title string, brand string, size int", multi_line=False)


@query("sink_summary_json", SUMMARY_SQL)
def _(spark, d):
    path = new_path(spark, "summary")
    writers.write_summary(reports.run_summary(keyed(spark, d), "20260531_183706"), path)
    schema = ("generated_at string, total_jobs bigint, unique_companies bigint, avg_skills_per_job double, "
              "role_distribution map<string,bigint>, seniority_distribution map<string,bigint>, "
              "skills_per_role map<string,map<string,bigint>>")
    return _flat_summary(spark.read.schema(schema).json(path))


@query("sink_checkpoint_per_key", over_jobs("""
SELECT search_role, count(*) AS n, min(id) AS low, max(id) AS high FROM jobs GROUP BY search_role"""))
def _(spark, d):
    target = writers.write_per_key(jobs(spark, d).select("id", "search_role", "title"),
                                   new_path(spark, "per-key"), "20260531_183706")
    return (spark.read.parquet(target).groupBy(F.col("search_role").cast("string").alias("search_role"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high")))
