"""Every named query against its SQL on DuckDB, and the plans of the main ones."""

import os
import re

import pytest

import __spark_entry__ as entry_points
import parity
from tidemark.catalog.oracles import ORACLES
from tidemark.catalog.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return parity.connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF)
    assert parity.compare(df, duck, entry_points.oracle_sql()[name]) is None


def test_comparison_sees_differences(spark, duck):
    sql = entry_points.oracle_sql()["error_counts"]
    df = entry_points.queries()["error_counts"](spark, SF)
    assert "differences" in parity.compare(df, duck, sql.replace("count(*) AS errors", "count(*) + 1 AS errors"))
    assert "row counts" in parity.compare(df, duck, f"SELECT * FROM ({sql}) WHERE errors > 1000")


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "temp_avg" in df.columns


# Streams and operators that write a batch first run when they are called.
EAGER = {
    "stream_silver", "stream_daily", "silver_load_rows", "stored_months", "stored_years", "stored_once",
    "stored_weeks", "stored_seasons", "stored_bronze", "hourly_run_silver", "hourly_run_forecasts", "hourly_run_daily",
    "hourly_run_watermark", "rollup_run_weekly", "rollup_run_state", "rollup_run_monthly", "rollup_run_seasonal",
    "rollup_run_yearly", "rollup_after_late_days", "dual_sink_events", "dual_sink_repair", "bronze_files", "stored_five_day",
    "stream_late_rows", "profile_by_day", "bronze_uploads",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_query_has_a_cross_join_or_python_worker(spark, name):
    plan = entry_points.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEvalPython|MapInPandas", plan)


def plan_of(spark, name):
    return entry_points.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "missing_partitions")
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == {"l_shipdate:timestamp_ntz"}
    plan = plan_of(spark, "monthly_rollup")
    columns = [set(re.findall(r"(l_\w+)#", found)) for found in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
    needed = {"l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"}
    # The rows are scanned once; the gate scans their date alone.
    assert sorted(columns, key=len) == [{"l_shipdate"}, needed]


def test_rollups_combine_before_the_shuffle(spark):
    plan = plan_of(spark, "weekly_rollup")
    assert "partial_max" in plan and "partial_avg" in plan
    # The gate sends one row per task and period.
    assert "partial_bit_or" in plan


def test_parsing_scans_bronze_once_without_a_shuffle(spark):
    plan = plan_of(spark, "parse_mixed")
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_cleaning_is_one_projection(spark):
    plan = plan_of(spark, "cleaned_silver")
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
