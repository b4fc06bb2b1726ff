"""Linked fact rows, their checks, summary and output layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.functions.tags import flag
from callweave.operators.lookups import join_suffix
from callweave.operators.metrics import sum0, text_list, unique_check
from callweave.operators.shape import without
from callweave.plans.fixed_values import DERIVED_COLUMNS, GROUP_COLUMNS, LISTED_COLUMNS

CALL_PREFIX, OUTCOME_PREFIX = "echi_", "outcomes_"


def linked_facts(calls: DataFrame, outcomes: DataFrame, steps: DataFrame) -> DataFrame:
    """Every answered call with its outcome; a call without outcome counts as saved."""
    mapped = join_suffix(calls, steps, [("calls_rn", "calls_rn")])
    outcome_id = outcomes.withColumnRenamed("outcomes_rn", "_rn")
    rows = join_suffix(mapped, outcome_id, [("outcomes_rn", "_rn")], around=True)
    joined = F.col("outcomes_rn").isNotNull()
    return rows.withColumns({
        "isJoined": flag(joined),
        "isSaved": F.when(joined, F.col("isSaved")).otherwise(1),
    })


def fact_checks(facts: DataFrame) -> DataFrame:
    return unique_check(facts, {"calls": "calls_rn", "outcomes": "outcomes_rn"})


def in_scope(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("isInScopeSkill") == 1)


def fact_summary(facts: DataFrame) -> DataFrame:
    """One row per call with its outcomes as lists."""
    order = [F.col("DH_ABT_OCOR"), F.col("outcomes_rn")]
    return in_scope(facts).groupBy(*GROUP_COLUMNS).agg(
        F.count("*").alias("outcomes_count"),
        sum0(F.col("is_cancelled")).alias("number_of_cancels"),
        *[text_list(F.col(c), order).alias(f"{c}_concat") for c in LISTED_COLUMNS],
    )


def with_agent_login(facts: DataFrame, active: DataFrame) -> DataFrame:
    """One outcome login per agent-day, and whether there is one."""
    one = active.groupBy("call_dt", "anslogin").agg(F.min("LOGIN_NET").alias("LOGIN_NET"))
    return join_suffix(facts, one, [("call_dt", "call_dt"), ("anslogin", "anslogin")]) \
        .withColumn("isAgentMapped", flag(F.col("LOGIN_NET").isNotNull()))


def output_layout(
    facts: DataFrame, active: DataFrame, call_columns: list[str], outcome_columns: list[str],
    audit_columns: list[str],
) -> DataFrame:
    """In-scope calls in the stored column order: call columns, outcome columns, derived."""
    rows = with_agent_login(in_scope(facts), active)
    return rows.select(
        *[F.col(c).alias(CALL_PREFIX + c) for c in without(call_columns, audit_columns)],
        *[F.col(c).alias(OUTCOME_PREFIX + c) for c in without(outcome_columns, audit_columns)],
        *DERIVED_COLUMNS,
    )
