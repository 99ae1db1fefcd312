"""Postings derived from the test tables, as a DataFrame and as SQL.

An order is a posting: its customer is the company, the customer's market
segment the role, its priority the level, its price the salary and the words
of its parts' names the skills.  Words are recoded to job vocabulary, so that
the default rule tables have something to match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derived postings.
TITLE_HEAD = {
    "blue": "Senior", "cold": "Junior", "hot": "Lead", "large": "Head of",
    "new": "Fresh Graduate", "old": "Sr.", "red": "Staff", "small": "Associate",
}
TITLE_TAIL = {
    "anvil": "Data Scientist", "bolt": "Backend Developer", "gear": "Analytics Engineer",
    "gizmo": "AI Specialist", "plate": "IT Support", "ring": "Full Stack Developer",
    "rod": "Finance Intern", "widget": "Cloud Platform Consultant",
}
SKILL = {
    "blue": "python", "cold": "sql", "hot": "r", "large": "aws",
    "new": "docker", "old": "java", "red": "react", "small": "git",
    "anvil": "tableau", "bolt": "power bi", "gear": "spark", "gizmo": "kafka",
    "plate": "pandas", "ring": "react native", "rod": "c++", "widget": "linux",
}
ROLE = {
    "HOUSEHOLD": "Data Scientist", "FURNITURE": "Backend Developer", "MACHINERY": "Data Engineer",
    "BUILDING": "Other", "AUTOMOBILE": "Frontend Developer",
}
TERM = {
    "HOUSEHOLD": "data scientist", "FURNITURE": "Back-End programmer", "MACHINERY": "Data  Engineer",
    "BUILDING": "office clerk", "AUTOMOBILE": " ",
}
RAW_LEVEL = {
    "1-URGENT": "Senior", "2-HIGH": "Managerial", "3-MEDIUM": "Mid",
    "4-NOT SPECIFIED": "Tidak Disebutkan", "5-LOW": "Intern",
}
LEVEL = {
    "1-URGENT": "Senior", "2-HIGH": "Manager/Head", "3-MEDIUM": "Mid-level",
    "4-NOT SPECIFIED": "Tidak Disebutkan", "5-LOW": "Junior",
}
PLACE = {
    "NATION_0": "Jakarta Selatan, DKI Jakarta (Hybrid)", "NATION_1": "Kota Bandung, Jawa Barat",
    "NATION_2": "Alam Sutera, Banten (On-site)", "NATION_3": "Yogyakarta (Remote)",
    "NATION_4": "Sleman, D.I. Yogyakarta", "NATION_5": "Surabaya, Jawa Timur",
    "NATION_6": "Medan", "NATION_7": "Palembang", "NATION_8": "Kepulauan Riau",
    "NATION_9": "Batam", "NATION_10": "Padang", "NATION_11": "Banda Aceh",
    "NATION_12": "Bandar Lampung", "NATION_13": "Balikpapan", "NATION_14": "Pontianak",
    "NATION_15": "Makassar", "NATION_16": "Manado", "NATION_17": "Denpasar, Bali",
    "NATION_18": "Kupang", "NATION_19": "Ambon", "NATION_20": "Work from Home",
    "NATION_21": "Singapore", "NATION_22": "Kuala Lumpur", "NATION_23": "", "NATION_24": "Tokyo, Japan",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def recode(c: Column, values: dict) -> Column:
    """Look a value up in a constant map."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), c)


def recode_sql(expr: str, values: dict[str, str]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
HEADS, TAILS = list(TITLE_HEAD), list(TITLE_TAIL)
SKILLS = sorted(SKILL.values())


def _position(c: Column, values: list[str]) -> Column:
    return recode(c, {v: i for i, v in enumerate(values)})


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: the first line's part as a number, and its skills as bits.

    Numbers keep the aggregation in hash maps; lists and structs of strings
    would have to be sorted.
    """
    head, tail = (F.split_part("p_name", F.lit(" "), F.lit(i)) for i in (1, 2))
    title = (_position(head, HEADS) * len(TAILS) + _position(tail, TAILS)) * len(KINDS) + _position(F.col("p_type"), KINDS)
    bit = {word: 1 << SKILLS.index(skill) for word, skill in SKILL.items()}
    part = table(spark, sf_dir, "part").select(
        "p_partkey", title.alias("title"), recode(head, bit).bitwiseOR(recode(tail, bit)).alias("bits"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    order = F.col("l_linenumber").cast("bigint") * 10**12 + F.col("l_partkey")
    return (lines.join(part, lines["l_partkey"] == part["p_partkey"])
            .groupBy("l_orderkey")
            .agg((F.min(order * 1000 + F.col("title")) % 1000).cast("int").alias("title_no"),
                 F.bit_or("bits").alias("bits")))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per order.

    The optimiser drops the join with the lines where neither title nor
    skills are used, because the lines are unique per order by then.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lines = _lines(spark, sf_dir)
    number = F.col("title_no")

    def word(values: list[str], at: Column) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.floor(at).cast("int"))

    title = F.concat_ws(
        " ", word(list(TITLE_HEAD.values()), number / (len(TAILS) * len(KINDS))),
        word(list(TITLE_TAIL.values()), (number / len(KINDS)) % len(TAILS)),
        F.lit("-"), word(KINDS, number % len(KINDS)))
    bits = F.coalesce("bits", F.lit(0))
    skills = F.array_except(
        F.array(*[F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(v)) for i, v in enumerate(SKILLS)]),
        F.array(F.lit(None).cast("string")))
    place = recode(F.col("n_name"), PLACE)
    return (orders
            .join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
            .join(nation, F.col("c_nationkey") == nation["n_nationkey"], "left")
            .join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
            .select(
                F.col("o_orderkey").alias("id"),
                F.when(number.isNull(), "").otherwise(title).alias("title"),
                recode(F.col("c_mktsegment"), ROLE).alias("search_role"),
                recode(F.col("c_mktsegment"), TERM).alias("search_term"),
                recode(F.col("o_orderpriority"), RAW_LEVEL).alias("raw_level"),
                recode(F.col("o_orderpriority"), LEVEL).alias("job_level"),
                F.col("c_name").alias("company"),
                place.alias("location"),
                F.trim(F.split_part(place, F.lit(","), F.lit(1))).alias("city"),
                (F.col("o_totalprice") * 250.0).alias("raw_salary"),
                F.when((F.col("o_totalprice") * 250.0).between(1e6, 1e8),
                       F.col("o_totalprice") * 250.0).alias("salary_avg"),
                skills.alias("extracted_skills"),
                F.size(skills).alias("skills_count"),
                F.concat(F.lit("Requirements: "), F.array_join(skills, ", "),
                         F.lit(" experience.")).alias("job_description"),
                F.concat(F.lit("https://jobs.example.com/jobs/view/"), F.col("o_orderkey").cast("string"),
                         F.lit("?ref="), "o_orderstatus").alias("job_url"),
                F.col("o_orderdate").alias("scraped_at"),
                F.col("o_orderpriority").alias("priority"),
                F.floor("o_totalprice").alias("amount")))


JOBS_SQL = f"""
named AS (
  SELECT l_orderkey, l_linenumber, l_partkey, p_type,
         split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2
  FROM lineitem JOIN part ON l_partkey = p_partkey),
heads AS (
  SELECT DISTINCT l_orderkey, first_value(w1) OVER w AS w1, first_value(w2) OVER w AS w2,
         first_value(p_type) OVER w AS p_type
  FROM named WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey)),
skill_rows AS (
  SELECT l_orderkey, {recode_sql('w1', SKILL)} AS skill FROM named
  UNION SELECT l_orderkey, {recode_sql('w2', SKILL)} FROM named),
skill_lists AS (
  SELECT l_orderkey, list(skill ORDER BY skill) AS skills FROM skill_rows GROUP BY l_orderkey),
jobs AS (
  SELECT o.o_orderkey AS id,
    CASE WHEN h.w1 IS NULL THEN '' ELSE {recode_sql('h.w1', TITLE_HEAD)} || ' '
         || {recode_sql('h.w2', TITLE_TAIL)} || ' - ' || h.p_type END AS title,
    {recode_sql('c_mktsegment', ROLE)} AS search_role,
    {recode_sql('c_mktsegment', TERM)} AS search_term,
    {recode_sql('o_orderpriority', RAW_LEVEL)} AS raw_level,
    {recode_sql('o_orderpriority', LEVEL)} AS job_level,
    c_name AS company,
    {recode_sql('n_name', PLACE)} AS location,
    trim(split_part({recode_sql('n_name', PLACE)}, ',', 1)) AS city,
    o_totalprice * 250.0::DOUBLE AS raw_salary,
    CASE WHEN o_totalprice * 250.0::DOUBLE BETWEEN 1e6 AND 1e8
         THEN o_totalprice * 250.0::DOUBLE END AS salary_avg,
    coalesce(s.skills, []::VARCHAR[]) AS extracted_skills,
    coalesce(len(s.skills), 0)::INTEGER AS skills_count,
    'Requirements: ' || coalesce(array_to_string(s.skills, ', '), '') || ' experience.' AS job_description,
    'https://jobs.example.com/jobs/view/' || o.o_orderkey || '?ref=' || o_orderstatus AS job_url,
    o_orderdate AS scraped_at, o_orderpriority AS priority, floor(o_totalprice)::BIGINT AS amount
  FROM orders o LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN heads h ON h.l_orderkey = o.o_orderkey
  LEFT JOIN skill_lists s ON s.l_orderkey = o.o_orderkey)
"""


def over_jobs(body: str, *extra: str) -> str:
    """A DuckDB query whose first common table is ``jobs``."""
    return "WITH " + ",\n".join([JOBS_SQL, *extra]) + "\n" + body
