"""Every registered query against its SQL, and what its plan must not do."""

import os
import re

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from vacantia.plans import catalog

SF = os.environ.get("ORACLE_SF", "0.001")
SF_DIR = f"/root/testdata/sf{SF}"
QUERIES, SQL = catalog.QUERIES, catalog.SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_registry():
    assert set(SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    assert compare(df, con, SQL[name]) is None


@pytest.mark.parametrize("name", ["win_keep_last", "win_keep_first", "win_topn_per_group", "agg_top_skills_per_role",
                                  "setop_dedup_key", "setop_dedup_subset", "setop_seen_ids"])
def test_groups_shrink_before_the_shuffle(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name, pattern, most", [
    ("sc_salary_parse", "regexp_extract_all", 2), ("board_b_table", r"regexp_extract_all\(lambda", 2),
    ("sc_skills_word", r"regexp_extract_all\(", 1), ("board_a_table", r"regexp_extract_all\(lambda", 1)])
def test_texts_are_parsed_once(spark, name, pattern, most):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= len(re.findall(pattern, plan)) <= most


@pytest.mark.parametrize("name", ["ml_rf_impute", "ml_hybrid_impute", "market_table"])
def test_imputation_reads_the_base_a_few_times(spark, name):
    """The stored counts stand between the raw tables and all else: what is left reads them for the filling only."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[o_orderkey", plan)) <= 2


def test_board_b_reads_its_base_once(spark):
    """Both copies of a posting come from one reading, and repeats go in one exchange by their key."""
    plan = QUERIES["board_b_table"](spark, SF_DIR)._jdf.queryExecution()
    assert len(re.findall(r"Relation \[o_orderkey", plan.optimizedPlan().toString())) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(_id", plan.executedPlan().toString())) == 1


def test_filter_reaches_the_scan(spark):
    plan = QUERIES["filt_range"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line and "o_totalprice" in line][0]
    assert "lineitem" not in plan and "o_orderstatus" not in scan
