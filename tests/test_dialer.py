import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from callweave.plans.combined import DIALER_ONLY, LAYOUT
from callweave.plans.dialer import Dialer
from callweave.plans.fixed_values import CALLBACK_TYPE, FOLLOWUP_COLUMNS
from callweave.plans.followup import CALL_COLUMNS, followup, run_days
from callweave.plans.params import DialerParams, RunWindow
from callweave.plans.router import all_routes, answered_routes, router_match
from callweave.plans.sensors import time_gap_sensor
from callweave.session import scratch_path
from callweave.sources.sinks import read_slices
from frames import at, frame, rows

PARAMS = DialerParams(RunWindow.of("2024-01-01", "2024-03-01"), "e1", "p1", "%DOWN%")
SALE = "x Venda confirmada y"
TYPES = {"dt_chamada": "timestamp_ntz", "LoadDate": "timestamp_ntz",
         "UpdateDate": "timestamp_ntz", "duracao": "int"}
CALL_SCHEMA = ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in CALL_COLUMNS)


def call(call_id, when, kind="P", key="1", status="-", **over):
    base = dict.fromkeys(CALL_COLUMNS) | {
        "id_call_ayty": call_id, "dt_chamada": at(when), "telefone": key, "login_telefonia": "ag",
        "tipo_de_ligao": {"P": "Preditivo", "C": CALLBACK_TYPE, None: None}[kind], "status": status,
        "id_call_ipbx": f"s{call_id}", "LoadDate": at("2024-02-20"),
        "UpdateDate": at("2024-02-21"), "duracao": 60, "ddd": "11", "grupo_de_atendimento": "g",
    }
    return tuple((base | over)[c] for c in CALL_COLUMNS)


def run(spark, *calls):
    return followup(frame(spark, CALL_SCHEMA, *calls), PARAMS)


def links(df):
    return rows(df, "id_call_ayty", "id_call_ayty_CallBack", "is_Sale_final", "time_difference")


def test_bounds_of_the_gap_are_open(spark, key_size):
    df = run(spark, call("1", "2024-01-05 10:00:00"), call("2", "2024-01-05 12:00:00"),
             call("a", "2024-01-05 10:00:00", "C", status=SALE),
             call("b", "2024-01-05 12:00:00", "C", status=SALE),
             call("c", "2024-01-05 11:00:00", "C", status=SALE),
             call("d", "2024-01-05 11:30:00", "C", status=SALE),
             call("e", "2024-01-05 11:40:00", "C"))
    assert links(df) == sorted([
        ("1", "c", 1, 3600), ("1", "d", 1, 5400), ("2", None, 0, None),
        ("a", None, 1, None), ("b", None, 1, None), ("c", None, 1, None), ("d", None, 1, None),
        ("e", None, 0, None)], key=repr)


def test_last_gap_ends_with_the_month(spark, key_size):
    df = run(spark, call("1", "2024-01-31 23:00:00"), call("a", "2024-01-31 23:30:00", "C", status=SALE),
             call("b", "2024-02-01 00:00:00", "C", status=SALE))
    assert ("1", "a", 1, 1800) in links(df)
    assert len(links(df)) == 3


def test_ties_order_by_id_and_empty_gaps_match_nothing(spark, key_size):
    df = run(spark, call("1", "2024-01-05 10:00:00"), call("2", "2024-01-05 10:00:00"),
             call("a", "2024-01-05 10:00:01", "C", status=SALE))
    assert links(df) == sorted([("1", None, 0, None), ("2", "a", 1, 1), ("a", None, 1, None)], key=repr)


def test_missing_type_and_missing_key(spark, key_size):
    df = run(spark, call("1", "2024-01-05 10:00:00", None), call("2", "2024-01-05 10:00:00", key=None),
             call("a", "2024-01-05 11:00:00", "C", key=None, status=SALE))
    assert links(df) == sorted([("2", None, 0, None), ("a", None, 1, None)], key=repr)


def test_update_time_of_predictive_rows_is_their_load_time(spark):
    df = run(spark, call("1", "2024-01-05 10:00:00"), call("a", "2024-01-05 11:00:00", "C"))
    assert rows(df, "id_call_ayty", "UpdateDate") == [("1", at("2024-02-20")), ("a", at("2024-02-21"))]


def test_exact_copies_collapse(spark):
    assert run(spark, *[call("a", "2024-01-05 11:00:00", "C")] * 3).count() == 1


ROUTER_SCHEMA = (
    "CallID string, CallRouteRepeat int, BTN string, callTime timestamp_ntz, "
    "agentID string, on_off int, EngineID string, CallGUID string, abandon int, "
    "skill string, LastRouteResponse string, NOTRouteReason string, "
    "SwitchError string, reason string, CalledNumber string, agentExt string, "
    "answtime timestamp_ntz")


def route(call_id, guid, reason="ok", abandoned=0, engine="e1", agent="ag"):
    return (call_id, 0, "b", at("2024-01-05 10:00:05"), agent, 1, engine, guid, abandoned, "s", "r",
            None, None, reason, "num", None, at("2024-01-05 10:00:30"))


ROUTES = [route("s1", "g1"), route("s1", "g2", None), route("s1", "g3", "is DOWN"),
          route("s1", "g4", "ok", 1), route("s1", "g5", engine="e2")]


def test_the_two_router_readings_differ(spark):
    df = frame(spark, ROUTER_SCHEMA, *ROUTES)
    assert rows(answered_routes(df, PARAMS), "CallGUID") == [("g1",), ("g2",)]
    assert rows(all_routes(df, PARAMS), "CallGUID") == [("g1",), ("g4",)]


def test_best_row_per_switch_call_and_all_rows_without_one(spark):
    dialer = run(spark, call("1", "2024-01-05 10:00:00", id_call_ipbx="s1"),
                 call("2", "2024-01-06 10:00:00", "C", status=SALE, id_call_ipbx="s1"),
                 call("3", "2024-01-07 10:00:00", id_call_ipbx=None),
                 call("4", "2024-01-08 10:00:00", id_call_ipbx=None))
    got = router_match(dialer, frame(spark, ROUTER_SCHEMA, *ROUTES), PARAMS)
    # Calls 1 and 2 share a switch id; both end as final sales, 2 has the newer update time.
    assert rows(got, "id_call_ayty", "CallGUID") == [("2", "g1"), ("3", None), ("4", None)]


def sources(spark):
    calls = frame(spark, CALL_SCHEMA, call("1", "2024-01-05 10:00:00", id_call_ipbx="s1", login_telefonia="7"))
    router = frame(spark, ROUTER_SCHEMA, route("s1", "g1", agent="7"))
    own = [f for f in LAYOUT.fields if f.name not in DIALER_ONLY and f.name != "switch_name"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own)
    value = lambda f: {"START_TS": at("2024-01-06"), "Agent_Login_ID": "000000007"}.get(f.name)
    other = frame(spark, schema, tuple(value(f) for f in own))
    agents = frame(
        spark, "fornecedor string, idcodusuario string, cpf string, "
        "scd_start timestamp_ntz, scd_end timestamp_ntz",
        ("DIALER", "7", "00000000799", at("2023-01-01"), at("2024-02-01")),
        ("DIALER", "7", "00000000799", at("2023-01-01"), at("2024-02-01")),
        ("DIALER", "8", "00000000899", at("2023-01-01"), at("2024-02-01")),
        ("ELSE", "7", "x", at("2023-01-01"), at("2024-02-01")))
    return calls, router, other, agents


def combined(spark, params=PARAMS):
    return Dialer(*sources(spark), params).combined


def test_a_rerun_from_mid_month_adds_nothing(spark):
    paths = [scratch_path(spark, n) for n in ("m", "c", "s")]
    Dialer(*sources(spark), PARAMS).store(*paths)
    first = [rows(read_slices(spark, p)) for p in paths]
    for window in (RunWindow.of("2024-01-05 12:00:00", "2024-02-01"), PARAMS.window):
        Dialer(*sources(spark), replace(PARAMS, window=window)).store(*paths)
        assert [len(rows(read_slices(spark, p))) for p in paths] == [len(f) for f in first] == [1, 2, 1]
    assert [rows(read_slices(spark, p)) for p in paths] == first


def test_each_switch_looks_up_by_its_own_key(spark):
    got = rows(combined(spark), "switch_name", "Agent_Login_ID", "short_cpf_combined", "login_telefonia_combined")
    assert got == [("DIALER", "7", "000000007", "7"), ("OTHER", "000000007", "000000007", "7")]


def test_update_over_every_row(spark):
    got = rows(combined(spark, replace(PARAMS, literal_update=True)),
               "switch_name", "short_cpf_combined", "login_telefonia_combined")
    assert got == [("DIALER", "7", None), ("OTHER", "000000007", "7")]


def test_case_is_left_aside_in_every_text_test(spark):
    calls, router, other, agents = sources(spark)
    loud = replace(PARAMS, ignore_case=True, engine_id="E1", callback_type=CALLBACK_TYPE.upper())
    named = agents.withColumn("fornecedor", F.lower("fornecedor"))
    quiet = Dialer(calls, router, other, agents, PARAMS).combined
    assert rows(Dialer(calls, router, other, named, loud).combined) == rows(quiet)


def test_unmatched_agents_per_day(spark):
    calls, router, other, agents = sources(spark)
    run = Dialer(calls, router, other, agents.where("idcodusuario = '8'"), PARAMS)
    assert rows(run.unmatched_agents) == [(dt.date(2024, 1, 5), 1)]


def test_filler_is_text_or_typed_null(spark):
    other = lambda df: df.where("switch_name = 'OTHER'").first()
    text, typed = combined(spark), combined(spark, replace(PARAMS, filler=None))
    assert other(text)["time_difference"] == "NA" and other(typed)["time_difference"] is None
    assert dict(typed.dtypes)["time_difference"] == "bigint" and dict(text.dtypes)["time_difference"] == "string"
    assert other(text)["AgentExten"] == "NA"


def test_sensor_leaves_out_calls_over_the_end(spark):
    schema = "START_TS timestamp_ntz, END_TS timestamp_ntz, CallGUID string, switch_name string"
    facts = frame(spark, schema, (at("2024-01-05 10:00:00"), at("2024-01-05 10:01:00"), "g1", "DIALER"),
                  (at("2024-01-05 10:01:00"), at("2024-01-05 10:02:00"), "g1", "DIALER"),
                  (at("2024-01-06 10:00:00"), None, "g1", "DIALER"),
                  (at("2024-02-29 10:00:00"), at("2024-03-01"), "g1", "DIALER"),
                  (at("2024-01-07"), at("2024-01-07"), "none", "DIALER"),
                  (at("2024-01-08"), at("2024-01-08"), "g1", "OTHER"))
    got = time_gap_sensor(facts, frame(spark, ROUTER_SCHEMA, route("s1", "g1")), PARAMS)
    # +30 s and -30 s: the absolute value of the mean, not the mean of absolute values.
    assert rows(got, "Sensors_Date", "Sensors_Value_Num") == [
        (dt.date(2024, 1, 5), 0.0), (dt.date(2024, 1, 7), 0.0)]


def test_run_window():
    w = RunWindow.of(as_of=dt.date(2024, 3, 1))
    assert (w.start, w.end) == (dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1))
    assert RunWindow.next_day(dt.date(2024, 3, 1), dt.date(2024, 3, 2)).require_one_day()
    for window in (w, RunWindow.of("2024-01-10", "2024-01-11 12:00:00"),
                   RunWindow.of("2024-01-10", "2024-01-10 12:00:00")):
        with pytest.raises(ValueError):
            window.require_one_day()


def test_daily_runs_give_the_rows_of_one_run(spark, tmp_path):
    """A call stays open over midnight, days without its key and the end of a window."""
    rnd = random.Random(9)
    calls = [call(str(i), f"2024-01-{rnd.randint(1, 10):02d} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00",
                  rnd.choice(["P", "P", "C", None]), rnd.choice(["1", "2", "3", None]),
                  rnd.choice([SALE, "-"])) for i in range(120)]
    calls += [call("x", "2024-01-31 23:00:00", key="9"), call("y", "2024-01-31 23:30:00", "C", "9", SALE),
              call("z", "2024-02-01 00:00:00", "C", "9", SALE)]
    calls = frame(spark, CALL_SCHEMA, *calls)
    for first, last, cuts in (("2024-01-01", "2024-02-01", ()), ("2024-01-28", "2024-02-02", ()), (
            "2024-01-01", "2024-02-01", [at("2024-01-04 12:00:00"), at("2024-01-05")])):
        params = replace(PARAMS, window=RunWindow.of(first, last))
        store = f"{tmp_path}/{first}-{len(cuts)}"
        parts = run_days(calls, store, params, cuts)
        want = rows(followup(calls, params), *FOLLOWUP_COLUMNS)
        assert sorted((r for p in parts for r in rows(p, *FOLLOWUP_COLUMNS)), key=repr) == want
        if cuts:  # a part that is run again gives the same rows, and later parts are not touched
            again = replace(params, window=RunWindow(cuts[0], cuts[1]))
            assert rows(run_days(calls, store, again, [cuts[1]])[0], "id_call_ayty") == rows(
                parts[1], "id_call_ayty")


def test_a_call_without_the_end_of_its_gap_waits(spark, tmp_path):
    calls = frame(spark, CALL_SCHEMA, call("1", "2024-01-05 10:00:00"),
                  call("a", "2024-01-06 09:00:00", "C", status=SALE), call("2", "2024-01-08 10:00:00"))
    day = lambda n: replace(PARAMS, window=RunWindow.of(f"2024-01-{n:02d}", f"2024-01-{n + 1:02d}"))
    found = [links(run_days(calls, f"{tmp_path}/s", day(n))[0]) for n in range(5, 9)]
    assert found == [[], [("1", "a", 1, 82800), ("a", None, 1, None)], [], []]
