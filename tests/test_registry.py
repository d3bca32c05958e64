import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, _normal

SF_DIR = "/root/testdata/sf0.001"
# One or two of each kind; compare.py runs them all.
COMPARED = [
    "binary_balance", "clean_market_data", "min_rows_filter", "prepared_features",
    "prepared_legacy", "numeric_quantiles", "column_summary", "label_distribution",
    "history_coverage", "eligible_symbols", "auc_exact", "results_leaderboard", "file_audit",
    "load_coherent_bars", "eligible_roundtrip", "moving_averages", "glr_line", "gbt_classifier_sides",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _normal(got) == _normal(want)
    assert len(got)


def test_every_sql_belongs_to_a_query_and_plans(con):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for sql in entry.oracle_sql().values():
        con.execute(f"EXPLAIN {sql}")


def test_entry(spark):
    assert [r["split"] for r in entry.entry(spark).orderBy("split").collect()] == [
        "test", "train", "validation"]


def test_no_query_joins_without_keys_or_ranks_everything_in_one_task(spark):
    """Plans have no Cartesian product and no window without a partition."""
    for name in ("numeric_quantiles", "column_summary", "history_coverage", "majority_baseline",
                 "top_symbols_by_split", "auc_exact", "symbol_overlap"):
        plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Exchange SinglePartition" not in plan or "Window" not in plan.split(
            "Exchange SinglePartition")[0], name


def test_top_lists_are_limited_before_the_shuffle(spark):
    plan = entry.queries()["top_symbols_by_split"](spark, SF_DIR)._jdf.queryExecution(
    ).executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_windows_run_once(spark):
    """Label and score reports read one stored frame: no window is left in their plans twice."""
    for name in ("label_distribution", "label_summary_table", "auc_exact", "results_leaderboard",
                 "best_per_model"):
        plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lead(") <= 1 and plan.count("stddev") <= 3, name
