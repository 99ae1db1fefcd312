"""Operators on small tables, against literal values or brute force."""

import random
import re
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vacantia.functions import text, vocab
from vacantia.operators import columns, dedup, filters, impute, lookups, quality, ranking, reports, skew
from vacantia.operators import quantiles
from vacantia.operators.quantiles import exact_quantiles, in_ranges


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


# ---------------------------------------------------------------- quantiles

@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False, width=32), st.sampled_from([0.0, -1.0, 5e6])),
                min_size=1, max_size=40))
def test_quantiles_equal_sorting(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.99, 1.0]).first()
    for g, p in zip(got, [0.0, 0.25, 0.5, 0.99, 1.0]):
        assert g == pytest.approx(quantile(values, p), rel=1e-12, abs=1e-12)


def test_grouped_quantiles_with_a_hot_group(spark):
    rng = random.Random(7)
    data = [("hot", 5e6 if rng.random() < .5 else rng.uniform(1e6, 1e8)) for _ in range(3000)]
    data += [(f"k{i % 50}", rng.lognormvariate(15, 2)) for i in range(2000)] + [(None, 3.0), (None, 5.0), ("hot", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r["k"]: (r["q0"], r["q1"]) for r in exact_quantiles(df, "v", [0.5, 0.9], ["k"]).collect()}
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert got.keys() == groups.keys()
    for k, vs in groups.items():
        assert got[k] == pytest.approx((statistics.median(vs), quantile(vs, 0.9)), rel=1e-12)


def test_quantiles_of_close_values(spark):
    """Values that lie close together are dealt out all the same."""
    df = spark.range(200_000).select((F.col("id") / 2e9).alias("v"), F.lit("g").alias("k"))
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("_n")).cache()
    parts = in_ranges(counts, ["k", "v"]).groupBy("k", "_part").count().agg(F.max("count"), F.count("*")).first()
    assert parts[0] <= 65_536 and parts[1] > 5
    assert exact_quantiles(df, "v", [0.25], ["k"]).first()["q0"] == pytest.approx(49_999.75 / 2e9, rel=1e-12)


@pytest.mark.parametrize("buckets", [4, 1024])
def test_quantiles_of_groups_cut_by_sketches(spark, monkeypatch, buckets):
    """Large and small groups, equal values and weights; the buckets never change the result."""
    monkeypatch.setattr(quantiles, "PART_ROWS", 50)
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    rng = random.Random(3)
    data = [("hot", rng.choice([5.0, rng.gauss(0, 1e6)]), rng.randrange(1, 9)) for _ in range(4000)]
    data += [(None, rng.random(), 1) for _ in range(300)] + [(f"k{i % 40}", rng.random(), 2) for i in range(400)] + [("hot", None, 1), ("one", 7.0, 3)]
    df = spark.createDataFrame(data, "k string, v double, w int")
    probs = [0.0, 0.1, 0.5, 0.999, 1.0]
    groups = {}
    for k, v, w in data:
        if v is not None:
            groups.setdefault(k, []).extend([v] * w)
    got = {r["k"]: list(r)[1:] for r in exact_quantiles(df, "v", probs, ["k"], "w").collect()}
    assert got == {k: pytest.approx([quantile(vs, p) for p in probs], rel=1e-12, abs=1e-9) for k, vs in groups.items()}
    every = [v for vs in groups.values() for v in vs]
    assert list(exact_quantiles(df, "v", probs, weight="w").first()) == pytest.approx([quantile(every, p) for p in probs], rel=1e-12, abs=1e-9)


def test_numbering_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "PART_ROWS", 50)
    labels = spark.range(1000).select(F.format_string("%05d", F.col("id") * 7 % 1000).alias("c")).cache()
    got = dict(rows(quantiles.numbered(labels, "c", "n")))
    assert got == {f"{i:05d}": i for i in range(1000)}


def test_percentile_trim_keeps_the_limit(spark):
    df = spark.range(1, 102).withColumn("v", F.col("id").cast("double"))
    assert filters.percentile_trim(df, "v").count() == 100


def test_percentile_trim_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert filters.percentile_trim(df, "v").count() == 0


# ---------------------------------------------------------------- skewed look-ups

def test_lookup_deals_out_hot_keys(spark):
    n = 6000
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), F.col("id").cast("string")))
    df = spark.range(n).select("id", key.alias("k"))
    out = lookups.with_group_size(df, "k", "n").cache()
    assert out.count() == n and out.select("id").distinct().count() == n
    got = {r["k"]: r["n"] for r in out.filter("k = 'hot' or k is null").distinct().select("k", "n").distinct().collect()}
    assert got == {"hot": 2000, None: None}
    assert out.filter("k like 'k%'").agg(F.min("n"), F.max("n")).first() == (1, 1)


def test_hot_rows_spread_evenly(spark):
    """A third of the rows has one key; the shuffle of the look-up deals them out like all others."""
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    spread = (df.withColumn("s", F.when(F.col("k") == "hot", skew.row_hash(df)).otherwise(F.xxhash64("k")))
              .repartition(8, "k", "s").groupBy(F.spark_partition_id()).count().collect())
    assert max(r["count"] for r in spread) < 1.2 * 30_000 / 8
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = lookups.with_group_size(df, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"hashpartitioning\(k#\d+, _spread#\d+", plan)


def test_lookup_with_nested_maps_and_hot_misses(spark):
    df = spark.range(500).select("id", F.lit("x").alias("k"), F.array(F.create_map(F.lit("a"), "id")).alias("m"))
    some = spark.createDataFrame([("y", 1)], "k string, w int")
    assert skew.lookup(df, some, ["k"]).filter("w IS NULL").count() == 500


def test_null_safe_lookup(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "i int, k string")
    table = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert rows(skew.lookup(df, table, ["k"], null_safe=True).select("i", "w"), "i") == [(1, 10), (2, 20), (3, None)]
    assert rows(skew.lookup(df, table, ["k"]).select("i", "w"), "i") == [(1, None), (2, 20), (3, None)]


def test_support(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", 1.0), ("b", None), (None, 1.0), (None, 2.0)],
                               "r string, v double")
    assert rows(lookups.supported_keys(df, "r", "v", 2)) == [("a",)]
    assert lookups.semi_min_support(df, "r", "v", 2).count() == 3
    assert rows(impute.coverage(df, "v", "r", 2).select("method", "n")) == [("actual", 5), ("forest", 1), ("median", 1)]


def test_median_cascade_hits_every_level(spark):
    data = [(1, "r", "l", "c", 10.0), (2, "r", "l", "c", 20.0), (3, "r", "l", "d", 50.0), (4, "r", "m", "c", 90.0),
            (5, "s", "l", "c", 1000.0),
            (6, "r", "l", "c", None), (7, "r", "l", "x", None), (8, "r", "x", "c", None), (9, "x", "l", "c", None),
            (10, "r", "l", None, None), (11, None, None, None, None)]
    df = spark.createDataFrame(data, "i int, role string, level string, city string, v double")
    got = dict(rows(lookups.with_median_cascade(df, "v", ["role", "level", "city"]).select("i", "median")))
    assert got[6] == 15.0 and got[7] == 20.0 and got[8] == 35.0 and got[9] == 50.0
    assert got[10] == 20.0 and got[11] == 50.0
    filled = dict((r["i"], (r["v"], r["salary_source"])) for r in
                  impute.median_impute(df, ["role", "level", "city"], "v", "role", 30).collect())
    assert filled[1] == (10.0, "actual") and filled[9] == (50.0, "estimated_median")


# ---------------------------------------------------------------- columns and filters

def test_columns(spark):
    df = spark.createDataFrame([(1, " a ", "b")], "Id int, ` Job Level ` string, c string")
    df = columns.normalise_headers(df)
    assert df.columns == ["id", "job_level", "c"]
    assert columns.reorder(df, ["c", "zz"]).columns == ["c", "id", "job_level"]
    assert columns.select_existing(df, ["c", "zz", "id"]).columns == ["c", "id"]
    assert columns.default_column(df, "c", F.lit("x")).first()["c"] == "b"
    assert columns.default_column(df, "d", F.lit("x")).first()["d"] == "x"
    assert columns.trim_strings(df).first()["job_level"] == "a"
    assert columns.rename(df, {"c": "d", "zz": "y"}).columns == ["id", "job_level", "d"]
    assert columns.drop_ignore(df, "c", "zz").columns == ["id", "job_level"]
    assert columns.keep_raw_copy(df, "c").columns[-1] == "c_raw"


def test_filters(spark):
    df = spark.createDataFrame([(1, " Nurse ", "x"), (2, "Developer", "We use Python"), (3, None, None), (4, "", "web")],
                               "i int, title string, job_description string")
    assert rows(filters.drop_noise(df).select("i"), "i") == [(2,), (3,), (4,)]
    assert rows(filters.keep_domain(df).select("i"), "i") == [(2,), (4,)]
    assert rows(filters.required(df, "title", "job_description").select("i"), "i") == [(1,), (2,)]
    assert filters.facets(df, {"title": [], "i": [1, 3]}).count() == 2
    assert filters.facets(df, {"title": []}).count() == 4
    assert filters.min_length(df, "title", 7).count() == 2
    assert rows(filters.facet_domain(df, "title")) == [("title", ""), ("title", " Nurse "), ("title", "Developer")]


def test_outliers_and_ranges(spark):
    df = spark.createDataFrame([(5e5,), (1e6,), (1e8,), (2e8,), (None,)], "v double")
    assert [r[0] for r in df.select(filters.outlier_to_null(F.col("v"))).collect()] == [None, 1e6, 1e8, None, None]
    assert filters.in_range(df, "v", 1e6, 1e8).count() == 2 and filters.in_range(df, "v").count() == 4
    assert rows(reports.range_counts(df, "v")) == [(1, 1, 1, 4)]


def test_stop_skill(spark):
    df = spark.createDataFrame([(["r", "R", "rust"],)], "s array<string>")
    assert df.select(filters.without_stop_skill(F.col("s"))).first()[0] == ["rust"]
    assert df.select(filters.without_stop_skill(F.col("s"), any_case=False)).first()[0] == ["R", "rust"]


@pytest.mark.parametrize("n", [3, 1500])
def test_top_per_group(spark, n):
    df = spark.range(6000).select("id", F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("k"),
                                  F.create_map(F.lit("a"), "id").alias("m"))
    got = ranking.top_per_group(df, ["k"], [F.desc("id")], n).groupBy("k").agg(F.count("*"), F.min("id"), F.max("id"))
    assert rows(got, "k") == [("cold", min(n, 2000), 6000 - min(n, 2000), 5999), ("hot", n, 4000 - n, 3999)]


def test_fixed_order(spark):
    df = spark.createDataFrame([("b", 2), ("z", 9)], "k string, n bigint")
    assert rows(ranking.sort_fixed_order(df, "k", ["a", "b"])) == [("b", 2, 1)]
    assert rows(ranking.sort_fixed_order(df, "k", ["a", "b"], True)) == [("a", None, 0), ("b", 2, 1)]
    assert rows(ranking.sort_fixed_order(df, "k", ["a", "b"], True, {"n": 0})) == [("a", 0, 0), ("b", 2, 1)]


# ---------------------------------------------------------------- dedup

POSTINGS = [("1", "a", "x", 1), ("1", "b", "y", 2), ("", "a", "x", 3), (None, "a", "x", 4), (" ", None, "x", 5),
            (None, None, "x", 6), ("2", "a", "x", 7)]


def test_dedup_key(spark):
    df = spark.createDataFrame(POSTINGS, "id string, title string, company string, at int")
    want = [("1", "b", "y", 2), (None, "a", "x", 4), (None, None, "x", 6), ("2", "a", "x", 7)]
    once = dedup.dedup_key(df, ["at"])
    assert rows(once, "at") == want
    assert rows(dedup.dedup_key(df.repartition(7), ["at"]), "at") == want
    assert rows(dedup.dedup_key(once, ["at"]), "at") == want


def test_dedup_key_of_a_table_without_ids(spark):
    df = spark.createDataFrame(POSTINGS, "id string, title string, company string, at int").drop("id")
    assert rows(dedup.dedup_key(df, ["at"]).select("at"), "at") == [(2,), (6,), (7,)]


def test_dedup_subset_keeps_first(spark):
    df = spark.createDataFrame(POSTINGS, "id string, title string, company string, at int")
    assert rows(dedup.dedup_subset(df, ["at"], ["title", "company"]).select("at"), "at") == [(1,), (2,), (5,)]


def test_seen(spark):
    df = spark.createDataFrame([(1, "7", "u"), (2, "7", "v"), (3, "", "u"), (4, "", "u"), (5, "", ""), (6, None, None)],
                               "at int, id string, url string")
    key = text.identity_key(F.col("id"), F.col("url"))
    assert rows(dedup.drop_seen(df, ["at"], key).select("at"), "at") == [(1,), (3,), (5,), (6,)]
    seen = spark.createDataFrame([("7",), (None,)], "k string")
    assert rows(dedup.drop_already_collected(df, seen, key).select("at"), "at") == [(3,), (4,), (5,), (6,)]


def test_skill_gap(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("a", ["z"]), ("b", ["y"]), ("b", [])], "r string, s array<string>")
    assert rows(dedup.skill_gap(df, "r", "s", "a", "b")) == [("x",), ("z",)]
    assert df.select(dedup.missing_skills(F.col("s"), ["y"])).first()[0] == ["x"]
    assert df.select(dedup.missing_skills(F.col("s"), [])).first()[0] == ["x", "y"]


# ---------------------------------------------------------------- reports

JOBS = [
    (1, "A", "Junior", "c1", 10.0, ["python", "r", "sql"], "t1"), (2, "A", "Senior", "c1", 20.0, ["python"], "t1"),
    (3, "A", "Senior", "c2", None, [], "t2"), (4, "B", "Odd", "c1", 40.0, ["sql", "R"], "t3"), (5, "C", "Odd", None, None, [], "t4"),
]


@pytest.fixture
def jobs(spark):
    df = spark.createDataFrame(JOBS, "id int, search_role string, job_level string, company string, salary_avg double, "
                                     "extracted_skills array<string>, title string")
    return df.withColumn("skills_count", F.size("extracted_skills"))


def test_role_share(jobs):
    assert rows(reports.role_share(jobs)) == [("A", 3, 60.0), ("B", 1, 20.0), ("C", 1, 20.0)]


def test_value_counts_leave_nulls_out(jobs):
    assert rows(reports.value_counts(jobs, "company")) == [("c1", 3), ("c2", 1)]


def test_top_skills(jobs):
    assert rows(reports.top_skills(jobs)) == [("python", 2, 40.0), ("sql", 2, 40.0), ("R", 1, 20.0), ("r", 1, 20.0)]
    assert rows(reports.top_skills_per_role(jobs), "search_role", "rank") == [
        ("A", "python", 2, 1), ("A", "sql", 1, 2), ("B", "R", 1, 1), ("B", "sql", 1, 2)]
    assert rows(reports.top_skills_per_role(jobs, stop=None, n=1, skip_role="B"), "search_role") == [("A", "python", 2, 1)]
    assert rows(reports.top_skills_selected(jobs, "B")) == [("sql", 1)]


def test_skill_matrix_counts_all_rows_of_a_role(jobs):
    got = rows(reports.skill_role_matrix(jobs, n=2), "search_role", "position")
    assert got == [("A", 0, "python", 66.7), ("A", 1, "sql", 33.3), ("B", 0, "python", 0.0), ("B", 1, "sql", 100.0),
                   ("C", 0, "python", 0.0), ("C", 1, "sql", 0.0)]


def test_levels(jobs):
    assert rows(reports.level_crosstab(jobs, levels=["Junior", "Senior"]), "search_role") == [("A", 1, 2), ("B", 0, 0), ("C", 0, 0)]
    share = rows(reports.level_share(jobs, levels=["Junior", "Senior"]), "search_role")
    assert share[0] == ("A", pytest.approx(100 / 3), pytest.approx(200 / 3)) and share[1] == ("B", None, None)


def test_kpi(jobs, spark):
    got = reports.kpi(jobs).first()
    assert tuple(got) == (5, 3, pytest.approx(70 / 3), 2, 60.0, 1.2)
    assert tuple(reports.kpi(jobs.filter("id > 9")).first()) == (0, 0, 0.0, 0, 0.0, 0.0)


def test_profile_card_and_dominant(jobs):
    got = rows(reports.role_profile(jobs), "search_role")
    assert got == [("A", 3, 60.0, "python", "Senior", 15.0), ("B", 1, 20.0, "sql", "Odd", 40.0), ("C", 1, 20.0, None, "Odd", None)]
    cards = rows(reports.role_card(jobs), "search_role")
    assert cards == [("A", ["python", "r", "sql"], 3), ("B", ["R", "sql"], 1), ("C", [], 1)]


def test_summary_adds_up(jobs):
    df = jobs.withColumnsRenamed({"search_role": "standardized_role", "job_level": "seniority"})
    got = reports.run_summary(df, "now").first()
    assert got["total_jobs"] == sum(got["role_distribution"].values()) == sum(got["seniority_distribution"].values()) == 5
    assert got["unique_companies"] == 2 and got["avg_skills_per_job"] == 1.2
    assert got["skills_per_role"]["A"] == {"python": 2, "r": 1, "sql": 1} and got["skills_per_role"]["C"] == {}
    more = reports.extended_summary(df.withColumn("work_type", F.lit("Remote")), "work_type", "title").first()
    assert more["work_type_distribution"] == {"Remote": 5} and more["top_cities"]["t1"] == 2


def test_size_salary_volume(jobs):
    df = jobs.withColumn("company_size_proxy", F.when(F.col("id") < 4, "Small (1–2)"))
    got = rows(reports.size_salary_volume(df))
    assert got[0] == ("Small (1–2)", 0, 15.0, 2, 3)
    assert [r[0] for r in got] == [b[2] for b in vocab.COMPANY_SIZE_BANDS] and got[3][2:] == (None, 0, 0)


def test_profiles(jobs, spark):
    assert rows(reports.null_profile(jobs.select("company", "salary_avg"))) == [("company", 1), ("salary_avg", 2)]
    assert rows(reports.schema_info(jobs.select("company"))) == [("company", 4, "string")]
    d = reports.describe(jobs, "salary_avg").first()
    assert (d["count"], d["min"], d["q25"], d["q50"], d["q75"], d["max"]) == (3, 10.0, 15.0, 20.0, 30.0, 40.0)
    twice = jobs.unionByName(jobs.limit(2))
    assert reports.duplicate_count(twice).first()[0] == 2


def test_duplicates_of_one_fingerprint_are_compared_by_value(spark):
    """Forced collisions, nulls, and a row that repeats very often."""
    data = [("a", 1), ("b", 1), ("a", 1), (None, 2), (None, 2), ("a", None), ("", None)] + [("hot", 5)] * 500
    df = spark.createDataFrame(data, "s string, n int")
    for fingerprint in (reports.row_fingerprint, lambda columns: (F.length(F.coalesce("s", F.lit(""))), F.lit(0))):
        assert reports.duplicate_count(df, fingerprint).first()[0] == len(data) - len(set(data))
    assert reports.duplicate_count(df.limit(0)).first()[0] == 0


def test_steps(jobs):
    steps = reports.step_counts(jobs, [("paid", F.col("salary_avg").isNotNull()), ("c1", F.col("company") == "c1")])
    assert rows(steps) == [(1, "paid", 5, 3, 2), (2, "c1", 3, 3, 0)]
    log = reports.step_log([("all", jobs), ("some", jobs.filter("id > 2"))])
    assert rows(log, "position") == [(0, "all", 5, 0), (1, "some", 3, 2)]


def test_skill_vector(jobs):
    got = reports.skill_vector(jobs, n=2).select("id", "skill_vector")
    assert dict(rows(got)) == {1: [1, 1], 2: [1, 0], 3: [0, 0], 4: [0, 1], 5: [0, 0]}
    wide = reports.skill_columns(jobs, n=2)
    assert wide.columns[-2:] == ["skill_python", "skill_sql"] and wide.agg(F.sum("skill_sql")).first()[0] == 2


def test_other_titles(spark):
    df = spark.createDataFrame([("Other", "a")] * 2 + [("X", "b")] * 18, "role string, title string")
    assert reports.other_titles(df, "role").count() == 0
    assert rows(reports.other_titles(df, "role", limit_pct=9.0)) == [("a", 2)]
    assert tuple(quality.other_share_gate(df, "role").first()) == (10.0, False)


def test_release_gate(jobs):
    df = jobs.select(F.col("search_role").alias("standardized_role"), F.lit(" ").alias("job_description"), "extracted_skills")
    got = {r["check"]: r["passed"] for r in quality.release_gate(df).collect()}
    assert got == {"min_rows": False, "blank_descriptions": False, "missing_roles": True, "other_pct": True, "skills_are_lists": True}


# ---------------------------------------------------------------- models

@pytest.fixture(scope="module")
def salaries(spark):
    rng = random.Random(3)
    data = []
    for i in range(400):
        role = rng.choice(["A", "A", "B", "C"]) if i else "Z"
        level = rng.choice(["Junior", "Senior", None])
        value = (3e6 if role == "A" else 9e6) * (2 if level == "Senior" else 1) * rng.uniform(.9, 1.1)
        known = rng.random() < (.6 if role in "AB" else .1)
        data.append((i, role, level, f"{rng.choice(['Bali', 'Medan'])}, ID", rng.randint(0, 9), value if known else None))
    return spark.createDataFrame(data, "id int, search_role string, job_level string, location string, skills_count int, salary_avg double")


def test_label_encode(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("z",), ("b",)], "c string")
    assert sorted(rows(impute.label_encode(df, ["c"])), key=str) == sorted(
        [("a", 0), ("b", 1), ("b", 1), (None, 2), ("z", 3)], key=str)


def test_hybrid_impute(salaries):
    spec = impute.ForestSpec(trees=20)
    out = impute.hybrid_impute(salaries, spec).cache()
    assert out.count() == 400 and out.filter("salary_avg is null").count() == 0
    before = {r["id"]: r["salary_avg"] for r in salaries.filter("salary_avg is not null").collect()}
    after = {r["id"]: r["salary_avg"] for r in out.filter("salary_source = 'actual'").collect()}
    assert before == after
    kinds = {(r["search_role"], r["salary_source"]) for r in out.collect()}
    assert ("A", "estimated_rf") in kinds and ("C", "estimated_median") in kinds and ("A", "estimated_median") not in kinds
    low, high = out.filter("salary_source = 'estimated_rf'").agg(F.min("salary_avg"), F.max("salary_avg")).first()
    assert low >= 1e6 and high <= 1e8
    again = impute.hybrid_impute(salaries, spec).agg(F.sum("salary_avg")).first()[0]
    assert again == pytest.approx(out.agg(F.sum("salary_avg")).first()[0])
    assert reports.value_counts(out, "city").count() == 2


def test_impute_without_support(salaries):
    """No role has enough known values: nothing is trained, medians fill the rest."""
    spec = impute.ForestSpec(trees=5, min_support=10_000)
    out = impute.hybrid_impute(salaries, spec)
    assert out.filter("salary_avg is null").count() == 0
    assert {r[0] for r in out.select("salary_source").distinct().collect()} == {"actual", "estimated_median"}
    same = impute.forest_impute(salaries, spec)
    assert same.filter("salary_avg is null").count() == salaries.filter("salary_avg is null").count()


def test_forest_does_not_depend_on_the_partitions(salaries):
    spec = impute.ForestSpec(trees=5)
    one, many = (dict(rows(impute.forest_impute(salaries.repartition(n), spec).select("id", "salary_avg"))) for n in (1, 13))
    assert one == many


def test_forest_only_fills_supported_roles(salaries):
    out = impute.forest_impute(salaries, impute.ForestSpec(trees=10))
    got = {r[0] for r in out.filter("salary_avg is null").select("search_role").distinct().collect()}
    assert got <= {"C", "Z"} and "C" in got


def test_scores(salaries):
    spec = impute.ForestSpec(trees=10)
    scores = {r["fold"]: r for r in impute.cv_scores(salaries, ["id"], spec).collect()}
    assert set(scores) == {"0", "1", "2", "3", "4", "mean"} and scores["mean"]["r2"] > 0.8
    assert all(scores[f]["trained"] + scores[f]["tested"] == scores["mean"]["tested"] for f in "01234")
    imp = rows(impute.feature_importance(salaries, spec))
    assert sum(x for _, x in imp) == pytest.approx(1.0) and [x for _, x in imp] == sorted(x for _, x in imp)


def test_histogram(spark):
    df = spark.createDataFrame([(float(i) * 1e6, "a") for i in range(41)] + [(7e6, "b")], "salary_avg double, salary_source string")
    got = impute.source_histogram(df).collect()
    a = [r for r in got if r["salary_source"] == "a"]
    assert sum(r["n"] for r in a) == 41 and len(a) == 40 and a[-1]["bin"] == 39 and a[-1]["n"] == 2
    assert [(r["bin"], r["n"]) for r in got if r["salary_source"] == "b"] == [(0, 1)]


def test_columns_of_the_user_survive_the_seen_filters(spark):
    df = spark.createDataFrame([("a", 1, "mine"), ("a", 2, "yours"), (None, 3, "ours"), ("b", 4, "theirs")], "id string, at int, _key string")
    first = dedup.drop_seen(df, ["at"], F.col("id"))
    assert sorted((r["at"], r["_key"]) for r in first.collect()) == [(1, "mine"), (3, "ours"), (4, "theirs")]
    fresh = dedup.drop_already_collected(df, spark.createDataFrame([("b",), (None,)], "k string"), F.col("id"))
    assert fresh.columns == df.columns and sorted((r["at"], r["_key"]) for r in fresh.collect()) == [(1, "mine"), (2, "yours"), (3, "ours")]


def test_equal_training_rows_are_repeated_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(impute, "TRAINING_PART", 1000)
    df = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 1001), ("d", 25_500)], "x string, _cell bigint")
    got = impute._copies(df, 27_502).groupBy("x").agg(F.count("*").alias("n"), F.count_distinct("_copy").alias("kinds"), F.min("_copy").alias("low"), F.max("_copy").alias("high"))
    assert sorted(map(tuple, got.collect())) == [(x, n, n, 1, n) for x, n in (("a", 1), ("b", 1000), ("c", 1001), ("d", 25_500))]


def test_many_training_rows_become_weighted_points(spark, monkeypatch):
    """Above the limit the points are bounded by the combinations of features; counts and sums stay those of all rows."""
    monkeypatch.setattr(impute, "MOST_ROWS", 100)
    spec = impute.ForestSpec(trees=3, min_leaf=2)
    data = [(0, 0, 0, 1, 2e6 + i % 700, 1 + i % 3) for i in range(2000)] + [(1, 0, 0, 1, 5e6 + i, 1) for i in range(7)] + [(2, 0, 0, 1, 9e6, 100_000)]
    df = spark.createDataFrame(data, "search_role_code long, job_level_code long, city_code long, skills_count int, salary_avg double, _cell long")
    total = sum(r[-1] for r in data)
    got = impute._points(df, total, spec).collect()
    for role in range(3):
        points, rows_ = [r for r in got if r["search_role_code"] == role], [r for r in data if r[0] == role]
        assert len(points) == (7 if role == 1 else impute.MOST_POINTS)
        assert sum(r["_weight"] for r in points) == sum(r[-1] for r in rows_)
        assert sum(r["_weight"] * r["salary_avg"] for r in points) == pytest.approx(sum(r[-1] * r[-2] for r in rows_))
    model = impute._forest(spec).fit(impute.training_rows(df, spec))
    assert [round(r["_predicted"], -5) for r in model.transform(df.dropDuplicates(["search_role_code"]).orderBy("search_role_code")).collect()] == [2e6, 5e6, 9e6]
