"""Figures from cells and threshold top-k, compared with direct counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vacantia.operators import cells, frequent
from vacantia.operators.filters import facets
from vacantia.operators.reports import kpi

SCHEMA = "search_role string, job_level string, company string, title string, salary_avg double, skills_count int"


def postings(spark, n, seed):
    r = random.Random(seed)
    rows = [(r.choice(["A", "B", "C", None]), r.choice(["Senior", "Junior", "Mid", None]), r.choice([None, *(f"c{i}" for i in range(40))]),
             f"t{r.randrange(60)}", r.choice([None, 1e6, 5e6, 7.5e6, 9e7, 2e8]), r.choice([None, 0, 1, 5])) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("n, seed", [(0, 0), (1, 1), (400, 2)])
def test_cells_answer_any_selection(spark, n, seed):
    df = postings(spark, n, seed)
    stored = cells.build(df, ["search_role", "job_level"], ["search_role", "company", "title"])
    r = random.Random(seed + 10)
    for _ in range(4):
        chosen = {"search_role": r.sample(["A", "B", "C", "D"], r.randrange(3)), "job_level": r.sample(["Senior", "Junior", "Mid"], r.randrange(3))}
        low, high = r.choice([(None, None), (5e6, 9e7), (None, 7.5e6)])
        wanted = kpi(facets(df, chosen), low=low, high=high).first().asDict()
        assert cells.kpi(stored, chosen, low, high).first().asDict() == pytest.approx(wanted)
        titles = {x["search_role"]: x["n"] for x in cells.distinct_counts(stored, "title", chosen, ["search_role"]).collect()}
        direct = facets(df, chosen).groupBy("search_role").agg(F.count_distinct("title").alias("n")).collect()
        assert titles == {x["search_role"]: x["n"] for x in direct}


def test_cells_of_more_numbers_than_a_bitmap(spark):
    df = spark.range(100_000).select(F.lit("A").alias("search_role"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("job_level"),
                                     (F.col("id") % 70_001).cast("string").alias("company"), F.lit(1.0).alias("salary_avg"), F.lit(1).alias("skills_count"))
    stored = cells.build(df, ["job_level"], ["search_role", "company"])
    assert cells.kpi(stored, {}).first()["companies"] == 70_001
    wanted = df.filter("job_level = 'x'").select("company").distinct().count()
    assert cells.distinct_counts(stored, "company", {"job_level": ["x"]}).first()["n"] == wanted


def test_a_selection_reads_cells_only(spark):
    df = postings(spark, 50, 3)
    stored = cells.build(df, ["job_level"], ["search_role", "company"])
    plan = cells.kpi(stored, {"job_level": ["Mid"]})._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and "Relation" in plan


def shuffled_records(spark, work):
    """Rows written to shuffles by all jobs of ``work``."""
    store = spark.sparkContext._jsc.sc().statusStore()

    gateway = spark.sparkContext._gateway
    nothing = gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList()

    def total():
        stages = store.stageList(None, False, False, *nothing)
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (stages.apply(i) for i in range(stages.size()))}

    before = total()
    result = work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return result, sum(n for k, n in total().items() if k not in before)


def values(spark, distinct, heavy=6):
    """``heavy`` values of 9,000 rows and more, two of them equally frequent, and so many values of one row."""
    common = spark.range(heavy * 10_000).select(F.concat(F.lit("h"), F.least(F.col("id") % heavy, F.lit(heavy - 1))).alias("v"))
    return common.unionByName(spark.range(distinct).select(F.concat(F.lit("s"), "id").alias("v")))


def test_threshold_top_counts_shuffle_little(spark):
    seen = {}
    for distinct in (20_000, 200_000):
        df = values(spark, distinct)
        got, seen[distinct] = shuffled_records(spark, lambda df=df: frequent.top_counts(df, "v", 4, buckets=1024).collect())
        assert [tuple(r) for r in got] == [(f"h{i}", 10_000) for i in range(4)]
    assert seen[200_000] < 2 * seen[20_000] and seen[200_000] < 20_000


@pytest.mark.parametrize("buckets", [1, 3, 64, 65_536])
def test_threshold_top_counts_are_exact(spark, buckets):
    """Many equal counts, fewer values than asked for, nulls, groups of their own."""
    r = random.Random(buckets)
    rows = [(r.choice(["x", "y", None]), r.choice([None, *map(str, range(r.choice([3, 30, 300])))])) for _ in range(3000)]
    rows += [("z", str(i)) for i in range(200)] + [("w", "only")]
    df = spark.createDataFrame(rows, "g string, v string").withColumn("_value", F.lit("clash"))
    got = frequent.top_counts(df, "v", 7, by=["g"], buckets=buckets, rank="place").collect()
    for g in ("x", "y", "z", "w"):
        counts = Counter(v for a, v in rows if a == g and v is not None)
        wanted = sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:7]
        assert sorted((x["place"], x["v"], x["n"]) for x in got if x["g"] == g) == [(i + 1, v, n) for i, (v, n) in enumerate(wanted)]
    assert {x["g"] for x in got} == {"x", "y", "z", "w"}
    assert frequent.top_counts(df.limit(0), "v", 7, buckets=buckets).count() == 0
