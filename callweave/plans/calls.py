"""Answered calls and the agents active on a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.functions.dates import add_seconds, parse_day, parse_timestamp
from callweave.functions.nulls import is_true
from callweave.functions.tags import flag, in_list, tag_by_list
from callweave.functions.text import contains_ci, contract_key, first_alnum, key_status, strip
from callweave.operators.identity import with_stable_id
from callweave.operators.lookups import scd_lookup
from callweave.operators.ordered import with_next_or_max
from callweave.operators.skew import find_hot
from callweave.plans.params import RetentionParams

FULL_PHONE = 9   # longer numbers are complete
SHORT_PHONE = 7  # numbers without area code
AGENT_DAY = ["anslogin", "call_dt"]


def with_ids(df: DataFrame, name: str, source: str | None) -> DataFrame:
    return with_stable_id(df, name) if source is None else df.withColumn(name, F.col(source))


def first_phones(legs: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """(_callid, _segment, _phone) of the first leg with a complete number of each call;
    ``earlier`` holds these of calls that began in a window before."""
    found = legs.where(F.length("calling_pty") > FULL_PHONE).select(
        F.col("callid").alias("_callid"), F.col("segment").alias("_segment"),
        F.col("calling_pty").alias("_phone"))
    if earlier is not None:
        found = found.unionByName(earlier)
    first = F.struct("_segment", "_phone")
    return found.groupBy("_callid").agg(F.min(first).alias("_first")).select("_callid", "_first.*")


def phones_left(legs: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """What the next window needs of this one: first phones of the calls with a leg in it, since
    each of them may go on after its end."""
    seen = legs.select(F.col("callid").alias("_seen")).dropna().distinct()
    phones = first_phones(legs, earlier)
    return phones.join(seen, F.col("_callid") == F.col("_seen"), "left_semi")


def answered_calls(
    legs: DataFrame, params: RetentionParams, earlier_phones: DataFrame | None = None,
) -> DataFrame:
    """Answered legs with a usable phone, talk times, contract status and scope tags.

    The phone of the first leg with a complete number is aggregated per call (map-side
    combined) and joined to the answered legs; that leg may lie before the window
    (``earlier_phones``, see ``phones_left``).
    """
    first_phone = first_phones(legs, earlier_phones).drop("_segment")
    answered = with_ids(legs.where(F.col("disposition") == 2), "calls_rn", params.call_id)
    start = parse_timestamp(F.col("segstart").cast("string"))
    contract = contract_key(F.col("ASAIUUI"))
    status = key_status(contract)
    calls = answered.join(first_phone, answered["callid"] == first_phone["_callid"], "left") \
        .withColumns({
            "calling_pty_final": F.when(
                is_true((F.length("calling_pty") == SHORT_PHONE) & F.col("_phone").isNotNull()),
                F.col("_phone")).otherwise(F.col("calling_pty")),
            "segstart": start,
            "segstop": parse_timestamp(F.col("segstop").cast("string")),
            "call_dt": F.to_date(start),
            "call_mn": F.month(start),
            "talk_start_tm": add_seconds(start, F.col("disptime")),
            "talk_start_tm_with_buffer": add_seconds(start, F.col("disptime") + 2 * 60),
            "talk_end_tm": add_seconds(
                start, F.col("disptime") + F.col("talktime") + F.col("ansholdtime")),
            "isInScopeSkill": flag(in_list(F.col("dispsplit"), params.in_scope)),
            "contract": contract,
            "contract_string_status": status,
            "is_contract_originally_populated": flag(status == "valid"),
            "retention_type": tag_by_list(F.col("dispsplit"), params.skills),
        }).drop("_callid", "_phone")
    times = answered.select("anslogin", start.alias("segstart"), F.to_date(start).alias("call_dt"))
    hot = find_hot(times, AGENT_DAY)
    return with_next_or_max(calls, AGENT_DAY, ["segstart", "calls_rn"], "talk_start_tm",
                            "talk_end_tm", "INTERVAL '5' MINUTE", "next_talk_start_tm", hot=hot)


def agent_map(agents: DataFrame, params: RetentionParams) -> DataFrame:
    """Usable agent map rows of the site; the last valid day is one day before Enddate."""
    login = F.col("LOGIN_TELEFONIA").cast("string")
    net = strip(first_alnum(F.col("LOGIN_NET").cast("string")))
    return agents.where(contains_ci(F.col("TERCEIRA"), params.site_name)).select(
        login.alias("LOGIN_TELEFONIA"), net.alias("LOGIN_NET"),
        parse_day(F.col("Startdate").cast("string")).alias("Startdate"),
        F.date_sub(parse_day(F.col("Enddate").cast("string")), 1).alias("Enddate"),
    ).where((F.col("LOGIN_TELEFONIA") != "0") & (F.length("LOGIN_TELEFONIA") > 1)
            & (F.length("LOGIN_NET") > 1))


def agent_days(calls: DataFrame, agents: DataFrame, params: RetentionParams) -> DataFrame:
    """Agent-days with an in-scope call and the outcome logins valid that day.

    The end day is exclusive here, so the last valid day finds no login.
    """
    active = calls.where(F.col("isInScopeSkill") == 1).select("call_dt", "anslogin").distinct()
    return scd_lookup(
        active, agents, [("anslogin", "LOGIN_TELEFONIA")], "call_dt", "Startdate", "Enddate",
        window=params.window.bounds,
    ).select("call_dt", "anslogin", "LOGIN_NET").distinct()
