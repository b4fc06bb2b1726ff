"""Link calls to outcomes in three steps of falling strength."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.functions.dates import add_seconds, ceil_day
from callweave.functions.nulls import is_true, least_strict
from callweave.functions.tags import in_list
from callweave.operators.intervals import match_last
from callweave.operators.lookups import anti, left_join_known, scd_lookup_last
from callweave.operators.ordered import first_per_group, with_next
from callweave.operators.skew import find_hot
from callweave.plans.calls import AGENT_DAY
from callweave.plans.customers import CustomerLinks
from callweave.plans.params import RetentionParams
from callweave.session import materialise

CONTRACT_LENGTH = 12
VALID = ["valid", "valid_lookup"]
SAME_CUSTOMER = ["call_dt", "anslogin", "contract_final", "calling_pty_final"]


def linked_calls(calls: DataFrame, links: CustomerLinks) -> DataFrame:
    """Calls with final contract, person key and the ends of their match intervals."""
    phone = links.by_phone.withColumnRenamed("btn", "_btn")
    rows = left_join_known(calls, phone, [("calling_pty_final", "_btn")]).drop("_btn")
    rows = rows.withColumn(
        "contract", F.when(F.col("contract_string_status") == "valid", F.col("contract")))
    # A missing contract without a looked-up one leaves the test, and so the status, unknown.
    filled = F.col("contract").isNull() & (F.length("contract_lookup") == CONTRACT_LENGTH)
    rows = rows.withColumns({
        "contract_final": F.when(filled, F.col("contract_lookup")).otherwise(F.col("contract")),
        "contract_string_status": F.when(filled, F.lit("valid_lookup"))
        .when(~filled, F.col("contract_string_status")),
    })
    person = links.by_person.withColumnRenamed("contract_lookup", "_contract")
    rows = left_join_known(rows, person, [("contract_final", "_contract")]).drop("_contract")
    rows = rows.withColumn("weak_end", least_strict(
        add_seconds(F.col("next_talk_start_tm"), 2 * 60), add_seconds(F.col("talk_end_tm"), 5 * 60)))
    # A customer group is part of an agent-day: without a large agent-day none is large.
    large_day = find_hot(calls, AGENT_DAY)
    hot = find_hot(rows, SAME_CUSTOMER) if large_day else None
    rows = with_next(rows, SAME_CUSTOMER, ["segstart", "calls_rn"],
                     {"strong_end": "talk_start_tm"}, hot=hot)
    return rows.withColumn("strong_end", F.coalesce("strong_end", ceil_day(F.col("segstart"))))


def linked_outcomes(outcomes: DataFrame, links: CustomerLinks) -> DataFrame:
    person = links.by_person.withColumnRenamed("contract_lookup", "_contract")
    return left_join_known(outcomes, person, [("contract_outcome", "_contract")]) \
        .drop("_contract")


def cascade(
    calls: DataFrame, outcomes: DataFrame, agents: DataFrame, params: RetentionParams
) -> DataFrame:
    """Map (calls_rn, outcomes_rn, join_step): each call and each outcome at most once.

    Step 1 asks for agent, day and contract inside the strong interval; step 2 for agent,
    day and person with another contract; step 3, for calls without contract, for agent and
    day inside the weak interval. An outcome keeps its last call, a call its lowest step. A
    step-2 outcome that loses its call to step 1 stays unmatched, it is not tried again.
    """
    probe = outcomes.select("outcomes_rn", "call_dt", "CD_LOGIN_USUARIO", "contract_outcome",
                            "crm_key", "DH_ABT_OCOR")
    with_agent = scd_lookup_last(
        probe, agents, [("CD_LOGIN_USUARIO", "LOGIN_NET")], "call_dt", "Startdate", "Enddate",
        ["LOGIN_TELEFONIA"], closed_end=True, window=params.window.bounds)
    right = materialise(with_agent.select(
        "outcomes_rn", F.col("call_dt").alias("_day"), F.col("LOGIN_TELEFONIA").alias("_agent"),
        F.col("contract_outcome").alias("_contract"), F.col("crm_key").alias("_person"),
        F.col("DH_ABT_OCOR").alias("_at")).distinct(), "cascade-outcomes")
    left = calls.select("calls_rn", "call_dt", "anslogin", "contract_final", "crm_key", "segstart",
                        "contract_string_status", "talk_start_tm", "talk_start_tm_with_buffer",
                        "strong_end", "weak_end")
    # All three steps match within an agent-day: one count of those covers their finer keys.
    days = left.select("call_dt", "anslogin", "segstart").unionAll(
        right.select("_day", "_agent", "_at")).dropna()
    opts = {"may_be_hot": find_hot(days, AGENT_DAY) is not None}
    has_contract = in_list(F.col("contract_string_status"), VALID)
    on = [("call_dt", "_day"), ("anslogin", "_agent")]

    strong = match_last(left.where(has_contract), right, [*on, ("contract_final", "_contract")],
                        "talk_start_tm", "strong_end", "_at", "outcomes_rn", **opts)
    step_1 = materialise(_one_call(strong, 1), "cascade-1")

    open_2 = anti(right, step_1, [("outcomes_rn", "outcomes_rn")]) \
        .where(F.col("_person").isNotNull())
    person = match_last(left.where(has_contract & F.col("crm_key").isNotNull()), open_2,
                        [*on, ("crm_key", "_person")], "talk_start_tm", "strong_end", "_at",
                        "outcomes_rn", differ=("contract_final", "_contract"), **opts)
    step_2 = materialise(_one_call(person, 2), "cascade-2")

    done = step_1.select("outcomes_rn").unionByName(step_2.select("outcomes_rn"))
    open_3 = anti(right, done, [("outcomes_rn", "outcomes_rn")])
    weak = match_last(left.where(~has_contract), open_3, on, "talk_start_tm_with_buffer",
                      "weak_end", "_at", "outcomes_rn", **opts)
    step_3 = _one_call(weak, 3)

    steps = step_1.unionByName(step_2).unionByName(step_3)
    return first_per_group(steps, ["calls_rn"], [F.asc("join_step"), F.asc("outcomes_rn")])


def _one_call(matched: DataFrame, step: int) -> DataFrame:
    """The last call of each outcome."""
    best = first_per_group(matched.where(F.col("outcomes_rn").isNotNull()), ["outcomes_rn"],
                           [F.desc("segstart"), F.desc("calls_rn")])
    return best.select("calls_rn", "outcomes_rn", F.lit(step).alias("join_step"))
