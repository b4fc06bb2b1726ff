"""Daily disposition, save and match rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.operators.lookups import join_suffix
from callweave.operators.metrics import rate_report, sum0


def _on(name: str):
    return F.col(name) == 1


def call_rates(facts: DataFrame) -> DataFrame:
    """Per day of in-scope calls: disposition rate, by step, and three save rates.

    ``facts`` are the in-scope rows.
    """
    joined = _on("isJoined")
    counts = {
        "calls_count_inScope": F.count("*"),
        "calls_count_isJoined": sum0(F.col("isJoined")),
        "calls_count_inScope_isJoined": F.count_if(_on("isInScopeSkill") & joined),
        "step_1": F.count_if(joined & (F.col("join_step") == 1)),
        "step_2": F.count_if(joined & (F.col("join_step") == 2)),
        "calls_count_isSaved": sum0(F.col("isSaved")),
        "calls_count_isSaved_conservative":
            F.count_if(_on("isInScopeSkill") & joined & _on("isSaved")),
    }
    calls = "calls_count_inScope"
    return rate_report(facts, ["call_dt"], counts, {
        "disposition_rate": ("calls_count_isJoined", calls),
        "disposition_rate_step_1": ("step_1", calls),
        "disposition_rate_step_2": ("step_2", calls),
        "save_Rate": ("calls_count_isSaved", calls),
        "save_Rate_conservative": ("calls_count_isSaved_conservative", calls),
        "save_rate_conservative_dispositioned_only":
            ("calls_count_isSaved_conservative", "calls_count_inScope_isJoined"),
    }).drop("step_1", "step_2")


def outcome_rates(outcomes: DataFrame, steps: DataFrame) -> DataFrame:
    """Per day of in-scope outcomes: match rate, in total and by step."""
    rows = join_suffix(outcomes, steps, [("outcomes_rn", "outcomes_rn")])
    matched = _on("is_in_scope_outcome") & F.col("calls_rn").isNotNull()
    counts = {
        "outcomes_count_inScope": sum0(F.col("is_in_scope_outcome")),
        "outcomes_count_isJoined": F.count_if(matched),
        **{f"outcomes_count_isJoined_step_{s}": F.count_if(matched & (F.col("join_step") == s))
           for s in (1, 2, 3)},
    }
    whole = "outcomes_count_inScope"
    return rate_report(rows, ["call_dt"], counts, {
        "match_rate": ("outcomes_count_isJoined", whole),
        **{f"match_rate_step_{s}": (f"outcomes_count_isJoined_step_{s}", whole) for s in (1, 2, 3)},
    })
