"""Plans: no nested loops, no whole table in one partition, filters and columns at the scan."""

import re

import pytest

from callweave.catalog import QUERIES

ROOT = "/root/testdata/sf0.001"
SMALL_RESULT = {"max_mark", "global_summary", "uniqueness_check", "count_reconcile", "staging_counts"}
WRITES = {"replace_slice", "append_slice", "upsert_sensor", "high_water_mark"}
LAZY = sorted(n for n in QUERIES if not n.startswith("job_") and n not in WRITES)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("name", LAZY)
def test_plan_holds_for_large_tables(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, ROOT))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in SMALL_RESULT:
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", ["job_followup", "job_router_match"])
def test_job_plans(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, ROOT))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "SinglePartition" not in plan


def test_followup_passes_share_one_shuffle(spark):
    plan = plan_of(QUERIES["job_followup"](spark, ROOT))
    by_key = re.findall(r"Exchange hashpartitioning\(CB_key#\d+, \d+\)", plan)
    assert plan.count("Window [") == 2 and len(by_key) == 1


def test_rows_without_key_go_round_the_windows(spark):
    plan = plan_of(QUERIES["job_followup"](spark, ROOT))
    assert "isnotnull" in plan.lower() and "Union" in plan


def test_stored_sensor_opens_the_days_of_its_window_only(spark):
    days = {re.search(r"slice_day=([0-9-]+)", f)[1]
            for f in QUERIES["job_stored_sensor"](spark, ROOT).inputFiles()}
    assert days and min(days) >= "2024-01-08" and max(days) <= "2024-01-21"


def test_interval_match_is_one_pass_over_one_line(spark):
    plan = plan_of(QUERIES["match_last_differing"](spark, ROOT))
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_scan_is_pruned_and_filtered(spark):
    plan = plan_of(QUERIES["scan_window"](spark, ROOT))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    schema = plan.split("ReadSchema:")[1]
    assert "props" not in schema and "value" not in schema


def test_best_row_is_limited_before_the_shuffle(spark):
    for name in ("first_per_group", "keep_best", "job_router_match", "unpivot_priority"):
        assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, ROOT)), name
