"""Physical plans: pruning and pushdown reach the scan, no Python in the plan, one
exchange for the batch reductions, broadcast of the small cell table."""

import re

from pyspark.sql import functions as F

from conftest import SF001, SF01
from sensorlytics.operators import reductions as R
from sensorlytics.plans import jobs as J
from sensorlytics.sources import fixtures as X
from sensorlytics.sources import ingest as I


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_scan_reads_only_needed_columns(spark):
    txt = formatted(J.outliers_level1(X.readings(spark, SF001), "1 day"))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", txt)
    assert schemas
    for s in schemas:
        assert "props" not in s and "user_id" not in s


def test_filter_pushed_to_scan(spark):
    df = J.batch_reductions(X.readings(spark, SF001).where(F.col("urn") == "click"), 60)
    txt = formatted(df)
    assert re.search(r"PushedFilters: \[[^\]]*event_type", txt)


def test_reductions_one_exchange_with_partial_aggregate(spark):
    p = plan(J.batch_reductions(X.readings_parts(spark, SF001), 60))
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in p and "partial_min" in p


def test_small_cell_table_is_broadcast(spark):
    # sf0.01, 1-day cells: 150 cells of ~67 readings -> broadcast
    p = plan(J.outliers_level1(X.readings(spark, SF01), "1 day"))
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p
    # JOB1: the readings are shuffled once, by the final count per cell
    assert p.count("Exchange hashpartitioning") == 1


def test_no_python_in_plans(spark):
    dfs = [J.outliers_level1(X.readings(spark, SF001), "1 day"),
           J.iqr_summary_raw_vs_clean(X.readings(spark, SF001), "1 day"),
           R.window_int_mean(X.readings_signed(spark, SF001), "1 day")]
    for df in dfs:
        p = plan(df)
        assert "EvalPython" not in p and "InPandas" not in p and "InArrow" not in p


def test_tiny_cells_join_the_frozen_table_without_broadcast(spark):
    # sf0.001, 1-day cells average < 8 readings: broadcasting their table does not pay
    p = plan(J.outliers_level1(X.readings(spark, SF001), "1 day"))
    assert "SortMergeJoin" in p and "Window" not in p


def _plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[-1]


def test_raw_and_clean_summaries_read_the_readings_once(spark):
    r = X.readings(spark, SF01)
    for job in (J.iqr_summary_raw_vs_clean, J.std_summary_raw_vs_clean):
        assert _plan(job(r, "1 day")).count("FileScan parquet") == 1  # and once before, for sizes or thresholds


def test_a_line_is_split_once(spark):
    lines = X.lines_bad(spark, SF01)
    for strict in (True, False):
        for out in I.parse_readings(lines, "uvt", strict=strict):
            plan = _plan(out)
            assert plan.count("split(") == 1 and "rlike" not in plan.lower() and "regexp" not in plan.lower()


def test_pairwise_fold_needs_no_ranks(spark):
    plan = _plan(R.pairwise_avg(X.readings(spark, SF01), "1 day"))
    assert "Window" not in plan and "row_number" not in plan and plan.count("rangepartitioning") == 1
