"""Data-quality sensors over stored facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.operators.lookups import left_join_known
from callweave.operators.metrics import mean_gap_seconds, rate_report, sum0
from callweave.plans.params import DialerParams, RunWindow
from callweave.sources.tables import time_slice

# Sensor table key; the source declares none, so this is an assumption.
SENSOR_KEY = ["Sensors_Date", "ProgramID", "CustomGroup1", "CustomGroup2", "Sensors_Name"]


def time_gap_sensor(combined: DataFrame, router: DataFrame, params: DialerParams) -> DataFrame:
    """Mean gap between call start and routed answer per day of the dialer.

    The start bound tests the call start and the end bound the call end, so calls that run
    over the end of the window are left out. The router side is not filtered.
    """
    lo, hi = (F.lit(str(v)).cast("timestamp_ntz") for v in (params.window.start, params.window.end))
    calls = combined.where((F.col("START_TS") >= lo) & (F.col("END_TS") < hi)
                           & (F.col("switch_name") == params.dialer_tag)) \
        .select("START_TS", "CallGUID")
    routes = router.select(F.col("CallGUID").alias("_guid"), "answtime")
    return left_join_known(calls, routes, [("CallGUID", "_guid")]) \
        .groupBy(F.to_date("START_TS").alias("Sensors_Date")) \
        .agg(mean_gap_seconds(F.col("START_TS"), F.col("answtime")).alias("Sensors_Value_Num")) \
        .select("Sensors_Date", F.lit(params.program_id).alias("ProgramID"),
                F.lit("").alias("CustomGroup1"), F.lit("").alias("CustomGroup2"),
                F.lit("Time_Difference").alias("Sensors_Name"), "Sensors_Value_Num")


def stored_fact_sensor(stored: DataFrame, window: RunWindow, mark: str = "echi_segstart") -> DataFrame:
    """Global disposition and save rates of the stored fact in a window."""
    rows = time_slice(stored, mark, window.start, window.end)
    both = (F.col("isInScopeSkill") == 1) & (F.col("isJoined") == 1)
    return rate_report(rows, [], {
        "calls_count_inScope": sum0(F.col("isInScopeSkill")),
        "calls_count_isJoined": F.count_if(both),
        "calls_count_isSaved": sum0(F.col("isSaved")),
    }, {
        "disposition_rate": ("calls_count_isJoined", "calls_count_inScope"),
        "save_Rate": ("calls_count_isSaved", "calls_count_inScope"),
    })
