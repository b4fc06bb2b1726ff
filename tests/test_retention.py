import datetime as dt
import random

import pytest

from callweave.plans.calls import agent_days, agent_map, answered_calls
from callweave.plans.cascade import cascade, linked_calls
from callweave.plans.customers import CustomerLinks, contract_by_phone, customer_links
from callweave.plans.facts import fact_checks, linked_facts
from callweave.plans.outcomes import clean_outcomes
from callweave.plans.params import RetentionParams, RunWindow
from callweave.plans.reports import call_rates, outcome_rates
from callweave.plans.retention import Retention
from callweave.plans.sensors import stored_fact_sensor
from frames import at, frame, rows

PARAMS = RetentionParams(RunWindow.of("2024-01-10", "2024-01-11"), call_id="no", outcome_id="no")
LEG = ("no int, callid string, segment int, calling_pty string, disposition int, segstart string, "
       "segstop string, disptime int, talktime int, ansholdtime int, dispsplit int, dispvdn int, "
       "anslogin string, ASAIUUI string")


def leg(no, when, callid=None, segment=1, phone="1155500001", disposition=2, split=695, agent="71",
        info="000000000001", talk=100):
    return (no, callid or f"c{no}", segment, phone, disposition, f"2024-01-10 {when}",
            f"2024-01-10 {when}", 10, talk, 5, split, 1, agent, info)


def calls_of(spark, *legs):
    return answered_calls(frame(spark, LEG, *legs), PARAMS)


def test_phone_of_the_first_leg_with_a_full_number(spark):
    got = calls_of(spark, leg(1, "10:00:00", "x", 1, "1234567", 1), leg(2, "10:00:01", "x", 2, "1155500002", 1),
                   leg(3, "10:00:02", "x", 3, "1155500003", 1), leg(4, "10:00:03", "x", 4, "7654321"),
                   leg(5, "10:00:04", "y", 1, "7654321"), leg(6, "10:00:05", "x", 5, "12345678"),
                   leg(7, "10:00:06", "x", 6, None))
    assert rows(got, "calls_rn", "calling_pty_final") == [
        (4, "1155500002"), (5, "7654321"), (6, "12345678"), (7, None)]


def test_next_talk_start_and_default(spark, key_size):
    got = calls_of(spark, leg(1, "10:00:00", talk=9000), leg(2, "10:10:00"), leg(3, "11:00:00", agent="72"),
                   leg(4, "10:20:00"))
    assert rows(got, "calls_rn", "next_talk_start_tm") == [
        (1, at("2024-01-10 10:10:10")), (2, at("2024-01-10 10:20:10")),
        (3, at("2024-01-10 11:06:55")), (4, at("2024-01-10 12:35:15"))]


def test_scope_tags_and_content_ids(spark):
    params = RetentionParams(PARAMS.window)
    legs = frame(spark, LEG, leg(1, "10:00:00", split=529), leg(1, "10:00:00", split=529),
                 leg(2, "10:00:00", split=None))
    got = answered_calls(legs, params)
    assert got.select("calls_rn").distinct().count() == 3
    assert rows(got, "no", "isInScopeSkill", "retention_type") == [
        (1, 1, "retention_transfer"), (1, 1, "retention_transfer"), (2, 0, "other")]


AGENT = "LOGIN_TELEFONIA string, LOGIN_NET string, TERCEIRA string, Startdate string, Enddate string"


def agents_of(spark):
    return agent_map(frame(
        spark, AGENT, ("71", " -net1 x", "my AeC", "2024-01-01", "2024-01-11"),
        ("72", "net2", "aec", "2024-01-01", "2024-01-12"), ("0", "net3", "aec", "2024-01-01", "2025-01-01"),
        ("73", "n", "aec", "2024-01-01", "2025-01-01"), ("74", "net4", "else", "2024-01-01", "2025-01-01"),
        ("75", "net5", "aec", "bad", "2025-01-01")), PARAMS)


def test_agent_map_and_the_lost_last_day(spark):
    agents = agents_of(spark)
    assert rows(agents, "LOGIN_TELEFONIA", "LOGIN_NET", "Enddate")[:2] == [
        ("71", "net1", dt.date(2024, 1, 10)), ("72", "net2", dt.date(2024, 1, 11))]
    calls = calls_of(spark, leg(1, "10:00:00"), leg(2, "10:00:00", agent="72"),
                     leg(3, "10:00:00", agent="79", split=1))
    # 10 January is the last valid day of agent 71, and the end is exclusive here.
    assert rows(agent_days(calls, agents, PARAMS), "anslogin", "LOGIN_NET") == [("71", None), ("72", "net2")]


OUTCOME = ("no int, DH_ABT_OCOR string, NM_TIPO_OCORRENCIA string, CD_OPERADORA int, NR_CONTRATO int, "
           "NM_SUB_INDICADOR_INTELIGENCIA string, NM_VISAO_ANALISE string, NM_INDICADOR_NEGOCIO string, "
           "NM_TIPO_CANCELAMENTO string, NM_SUB_INDICADOR_NEGOCIO string, NM_EPS string, CD_LOGIN_USUARIO string")


def outcome(no, kind="CO2", saved="RETIDO", view="DOMICÍLIO", login="net2", contract=1, lead="LEADS RETENCAO"):
    return (no, "2024-01-10 10:00:00", kind, 1, contract, saved, view, lead, "PRODUTOS", "RETIDO", "AEC", login)


def test_outcome_scope_and_flags(spark):
    active = frame(spark, "call_dt date, anslogin string, LOGIN_NET string",
                   (dt.date(2024, 1, 10), "72", "net2"), (dt.date(2024, 1, 10), "77", "net2"),
                   (dt.date(2024, 1, 10), "78", None))
    got = clean_outcomes(frame(
        spark, OUTCOME, outcome(1, " co15 x"), outcome(2, "co3"), outcome(3, view=None), outcome(4, saved=None),
        outcome(5, login=None), outcome(6, lead="x"), outcome(7, contract=None)), active, PARAMS)
    one = got.where("anslogin = '72'")
    assert rows(one, "outcomes_rn", "threat_type", "isSaved", "is_cancelled", "is_in_scope_outcome") == [
        (1, "co15", 1, 0, 1), (3, "co2", 1, 0, None), (4, "co2", None, None, 1), (7, "co2", 1, 0, 1)]
    assert rows(one, "contract_outcome")[0] == ("001000000001",)
    assert rows(one.where("outcomes_rn = 7"), "contract_outcome") == [("001NA",)]
    assert got.count() == 8  # a login of two agents repeats the outcome


CRM = ("contract string, DAT_MOVIMENTO string, DAT_NASCIMENTO string, NUM_TELEFONE_RESIDENCIAL string, "
       "NUM_TELEFONE_FIXO_NET string, NUM_CELULAR string, NUM_TELEFONE_COMERCIAL string, "
       "NUM_TELEFONE_OUTROS string, startDate date, endDate date")


def crm(contract, home="1140000001", mobile=None, born="1980-01-01 00:00:00", moved="2024-01", net=None,
        end="2025-01-01"):
    return (contract, moved, born, home, net, mobile, None, None, dt.date(2023, 1, 1), dt.date.fromisoformat(end))


LINK_CALL = "contract string, contract_string_status string, calling_pty_final string"


def test_customer_links(spark):
    people = frame(
        spark, CRM, crm("A"), crm("B"), crm("B", moved="2023-01", born="1970-01-01"),
        crm("C", home="1149999999", mobile="1155500001"), crm("D", home="1148888888", net="1155500001"),
        crm("E", home="1147777777"), crm("F", end="2024-01-10"), crm("G", born="2001-01-01 00:00:00"),
        crm("H", home=None, mobile="1155500009"), crm("I", born="2020-05-05"))
    calls = frame(spark, LINK_CALL, ("A", "valid", "1155500001"), ("zz", "zero", "1155500009"),
                  ("G", "valid", "7777777"), ("I", "valid", None), (None, "valid", "1140000001"))
    outs = frame(spark, "contract_outcome string", ("Q",))
    links = customer_links(people, calls, outs, PARAMS)
    # A fixed line outranks a mobile; the home phone of several contracts takes the lowest.
    assert rows(links.by_phone, "btn", "contract_lookup") == [
        ("1140000001", "A"), ("1155500001", "D"), ("1155500009", "H")]
    person = {r["contract_lookup"]: r["crm_key"] for r in links.by_person.collect()}
    assert person["A"] == person["B"] == "1140000001_1980-01-01 00:00:00"
    assert set(person) == {"A", "B", "D"}
    two_way = customer_links(people, calls, outs, RetentionParams(
        PARAMS.window, union_looked_up=False))
    assert {r["contract_lookup"] for r in two_way.by_person.collect()} == {"A", "B"}


def test_phone_ranks_before_newness(spark):
    people = frame(spark, CRM, crm("A", home="1150000000", moved="2020-01"), crm("B", home=None, mobile="1150000000")) \
        .withColumnRenamed("contract", "contract_lookup")
    calls = frame(spark, LINK_CALL, (None, "zero", "1150000000"))
    assert rows(contract_by_phone(people, calls)) == [("1150000000", "A")]


def links_of(spark, phones=(), people=()):
    return CustomerLinks(frame(spark, "btn string, contract_lookup string", *phones),
                         frame(spark, "crm_key string, contract_lookup string", *people))


def test_status_is_unknown_without_contract_and_lookup(spark):
    calls = calls_of(spark, leg(1, "10:00:00", info="0000"), leg(2, "10:00:00", info=" ", phone="1155500002"),
                     leg(3, "10:00:00", info=None, phone="1155500003"), leg(4, "10:00:00", info="123"))
    got = linked_calls(calls, links_of(spark, [("1155500002", "123456789012"), ("1155500003", "short")]))
    assert rows(got, "calls_rn", "contract_final", "contract_string_status") == [
        (1, None, None), (2, "123456789012", "valid_lookup"), (3, None, "valid"), (4, "123", "valid")]


def test_strong_interval_is_per_customer(spark, key_size):
    calls = calls_of(spark, leg(1, "10:00:00", info="A"), leg(2, "11:00:00", info="A"),
                     leg(3, "12:00:00", info="B"), leg(4, "13:00:00", info="A", phone=None),
                     leg(5, "14:00:00", info="A", phone=None))
    got = linked_calls(calls, links_of(spark))
    midnight = at("2024-01-11")
    assert rows(got, "calls_rn", "strong_end") == [
        (1, at("2024-01-10 11:00:10")), (2, midnight), (3, midnight), (4, at("2024-01-10 14:00:10")),
        (5, midnight)]


OUT = ("outcomes_rn int, call_dt date, CD_LOGIN_USUARIO string, contract_outcome string, crm_key string, "
       "DH_ABT_OCOR timestamp_ntz")


def out(no, when, contract="A", person=None, login="net1"):
    return (no, dt.date(2024, 1, 10), login, contract, person, at(f"2024-01-10 {when}"))


def steps_of(spark, legs, outs, people=()):
    calls = linked_calls(calls_of(spark, *legs), links_of(spark, people=people))
    return rows(cascade(calls, frame(spark, OUT, *outs), agents_of(spark), PARAMS),
                "calls_rn", "outcomes_rn", "join_step")


def test_step_one_bounds_and_last_outcome(spark, key_size):
    legs = [leg(1, "10:00:00", info="A"), leg(2, "11:00:00", info="A")]
    assert steps_of(spark, legs, [out(1, "10:00:10"), out(2, "10:30:00"), out(3, "11:00:10"), out(4, "10:00:09")]) \
        == [(1, 2, 1), (2, 3, 1)]


def test_an_outcome_of_two_calls_goes_to_the_last_call(spark, key_size):
    legs = [leg(1, "10:00:00", info="A"), leg(2, "11:00:00", info="A", phone="1155500002")]
    assert steps_of(spark, legs, [out(1, "12:00:00")]) == [(2, 1, 1)]


def test_step_two_needs_another_contract_of_the_person(spark, key_size):
    people = [("p", "A"), ("p", "B")]
    legs = [leg(1, "10:00:00", info="A")]
    assert steps_of(spark, legs, [out(1, "10:30:00", "B", "p")], people) == [(1, 1, 2)]
    assert steps_of(spark, legs, [out(1, "10:30:00", "B", "q")], people) == []


def test_a_step_two_outcome_that_loses_its_call_stays_unmatched(spark, key_size):
    people = [("p", "A"), ("p", "B")]
    legs = [leg(1, "10:00:00", info="A"), leg(2, "10:28:00", info="0000")]
    # Outcome 2 picks call 1 in step 2, which step 1 already holds; call 2 could take it in
    # step 3, but it is not tried again.
    assert steps_of(spark, legs, [out(1, "10:20:00", "A", "p"), out(2, "10:30:30", "B", "p")], people) \
        == [(1, 1, 1)]


def test_step_three_is_tight_and_only_for_calls_without_contract(spark, key_size):
    legs = [leg(1, "10:00:00", info="0000"), leg(2, "12:00:00", info="A")]
    assert steps_of(spark, legs, [out(1, "10:02:09", "Q")]) == []
    assert steps_of(spark, legs, [out(1, "10:02:10", "Q"), out(2, "10:06:54", "Q"), out(3, "10:06:55", "Q")]) \
        == [(1, 2, 3)]
    assert steps_of(spark, legs, [out(1, "12:03:00", "Q")]) == []


def test_the_agent_of_an_outcome_is_valid_on_its_last_day(spark):
    assert steps_of(spark, [leg(1, "10:00:00", info="A")], [out(1, "10:30:00")]) == [(1, 1, 1)]
    assert steps_of(spark, [leg(1, "10:00:00", info="A")], [out(1, "10:30:00", login="none")]) == []


def test_calls_without_outcome_count_as_saved(spark):
    calls = frame(spark, "calls_rn int, call_dt date, isInScopeSkill int", *[(i, dt.date(2024, 1, 10), 1) for i in (1, 2, 3)])
    outs = frame(spark, "outcomes_rn int, call_dt date, isSaved int, is_in_scope_outcome int",
                 (7, dt.date(2024, 1, 10), 0, 1), (8, dt.date(2024, 1, 10), 1, None), (9, dt.date(2024, 1, 11), 1, 0))
    steps = frame(spark, "calls_rn int, outcomes_rn int, join_step int", (1, 7, 1), (2, 8, 2))
    facts = linked_facts(calls, outs, steps)
    assert rows(facts, "calls_rn", "isJoined", "isSaved") == [(1, 1, 0), (2, 1, 1), (3, 0, 1)]
    assert rows(fact_checks(facts)) == [("calls", 3, 3, 1), ("outcomes", 2, 2, 1)]
    rate = call_rates(facts).first()
    assert rate["disposition_rate"] == pytest.approx(200 / 3)
    assert rate["save_Rate"] == pytest.approx(200 / 3)
    assert rate["save_Rate_conservative"] == pytest.approx(100 / 3)
    assert rate["save_rate_conservative_dispositioned_only"] == 50.0
    by_day = {r["call_dt"].day: r for r in outcome_rates(outs, steps).collect()}
    assert (by_day[10]["match_rate"], by_day[10]["match_rate_step_2"]) == (100.0, 0.0)
    assert by_day[11]["match_rate"] is None  # no outcome in scope that day


def test_stored_sensor_over_nothing(spark):
    empty = frame(spark, "echi_segstart timestamp_ntz, isInScopeSkill int, isJoined int, isSaved int",
                  (at("2023-01-01"), 1, 1, 1))
    got = stored_fact_sensor(empty, PARAMS.window).first()
    assert (got["calls_count_inScope"], got["disposition_rate"]) == (0, None)


def test_daily_runs_give_the_rows_of_one_run(spark):
    """Two days as one window and day by day; calls that go on over midnight keep their phone."""
    rnd = random.Random(3)
    legs, outs = [], []
    for i in range(60):
        day, when = rnd.choice([10, 11]), f"{rnd.randint(8, 22):02d}:{rnd.randint(0, 59):02d}:00"
        no, *rest = leg(i, when, info=rnd.choice(["000000000001", "000000000002", "0000"]),
                        phone=rnd.choice(["1155500001", "1155500002"]), agent=rnd.choice(["72", "73"]))
        legs.append((no, *(f"2024-01-{day}{v[10:]}" if str(v).startswith("2024-01-10") else v for v in rest)))
        outs.append((1000 + i, f"2024-01-{day} {when[:3]}{rnd.randint(0, 59):02d}:30", "CO2", 0,
                     rnd.choice([1, 2, 3]), "RETIDO", "DOMICÍLIO", "LEADS RETENCAO", "PRODUTOS", "RETIDO",
                     "AEC", rnd.choice(["net2", "net3"])))
    late = leg(900, "23:59:00", "night", 1, "1155500007", disposition=1)
    later = list(leg(901, "00:01:00", "night", 2, "1234567", agent="72"))
    legs += [late, tuple(v.replace("2024-01-10", "2024-01-11") if isinstance(v, str) else v for v in later)]
    agents = frame(spark, AGENT, ("72", "net2", "aec", "2024-01-01", "2024-02-01"),
                   ("73", "net3", "aec", "2024-01-01", "2024-02-01"))
    people = frame(spark, CRM, crm("000000000001"), crm("000000000002", mobile="1155500001"))
    # Times stay text in the source; the window is a plain comparison of texts there.
    tables = (frame(spark, LEG, *legs), frame(spark, OUTCOME, *outs), agents, people)

    def job(first, last, earlier=None, **more):
        params = RetentionParams(RunWindow.of(first, last), call_id="no", outcome_id="no", **more)
        return Retention(*tables, params, earlier)

    whole = job("2024-01-10", "2024-01-12", many_days=True)
    one = job("2024-01-10", "2024-01-11")
    two = job("2024-01-11", "2024-01-12", one.phones_left)
    want = rows(whole.steps, "calls_rn", "outcomes_rn", "join_step")
    assert len(want) > 5 and {r[2] for r in want} == {1, 2}
    found = [r for j in (one, two) for r in rows(j.steps, "calls_rn", "outcomes_rn", "join_step")]
    assert sorted(found, key=repr) == want
    shown = ("calls_rn", "calling_pty_final", "next_talk_start_tm", "outcomes_rn", "isSaved")
    assert sorted((r for j in (one, two) for r in rows(j.facts, *shown)), key=repr) == sorted(
        rows(whole.facts, *shown), key=repr)
    assert (901, "1155500007") in rows(two.answered, "calls_rn", "calling_pty_final")
    assert (901, "1234567") in rows(job("2024-01-11", "2024-01-12").answered, "calls_rn", "calling_pty_final")


def test_a_single_reader_of_the_facts_needs_no_table_of_them(spark, monkeypatch):
    from callweave import session
    from callweave.catalog import QUERIES
    from callweave.plans import retention

    written = []
    monkeypatch.setattr(retention, "materialise", lambda df, name: (
        written.append(name), session.materialise(df, name))[1])
    for name in ("job_call_rates", "job_fact_summary", "job_fact_checks"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert "link-steps" in written and "facts" not in written


@pytest.fixture
def small_run(spark):
    outs = frame(spark, "no int, DH_ABT_OCOR string, NM_TIPO_OCORRENCIA string, CD_OPERADORA int, NR_CONTRATO int, "
                 "NM_SUB_INDICADOR_INTELIGENCIA string, NM_VISAO_ANALISE string, NM_INDICADOR_NEGOCIO string, "
                 "NM_TIPO_CANCELAMENTO string, NM_SUB_INDICADOR_NEGOCIO string, NM_EPS string, CD_LOGIN_USUARIO string",
                 *[(n, f"2024-01-10 {t}", "CO2", 0, 1, "RETIDO", "DOMICÍLIO", "LEADS RETENCAO", "PRODUTOS", "RETIDO",
                    "AEC", "net1") for n, t in ((1, "10:00:30"), (2, "10:10:30"), (3, "12:00:00"))])
    legs = frame(spark, LEG, leg(1, "10:00:00"), leg(2, "10:10:00", info=None), leg(3, "10:20:00", split=999),
                 leg(4, "10:20:00", split=999))
    agents = frame(spark, AGENT, ("71", "net1", "AEC", "2024-01-01", "2024-02-01"))
    return lambda **options: Retention(legs, outs, agents, frame(spark, CRM, crm("000000000001")), PARAMS, **options)


def written(monkeypatch):
    from callweave.plans import retention
    made, write = {}, retention.materialise
    monkeypatch.setattr(retention, "materialise", lambda df, name: made.setdefault(name, write(df, name)))
    return made


def test_a_run_of_links_writes_only_their_columns(small_run, monkeypatch):
    whole, links = small_run(), small_run(links_only=True)
    steps, rates = whole.steps, outcome_rates(whole.linked_outcomes, whole.steps)
    made = written(monkeypatch)
    assert sorted(links.steps.collect()) == sorted(steps.collect()) != []
    assert outcome_rates(links.linked_outcomes, links.steps).collect() == rates.collect()
    assert "ASAIUUI" not in made["linked-calls"].columns and "NM_EPS" not in made["linked-outcomes"].columns
    assert "ASAIUUI" in whole.linked_calls.columns
    with pytest.raises(ValueError):
        links.facts


def test_checks_and_layout_write_no_wide_facts(small_run, monkeypatch):
    whole, other = small_run(), small_run()
    want = whole.facts and (sorted(whole.count_checks.collect()), rows(whole.stored_rows, "echi_no", "outcomes_no", "isSaved"))
    made = written(monkeypatch)
    assert (sorted(other.count_checks.collect()), rows(other.layout_rows, "echi_no", "outcomes_no", "isSaved")) == want
    assert [r.n_after for r in want[0] if r.check_name == "facts"] == [4] and len(want[1]) == 2
    assert "facts" not in made and made["counted-facts"].columns == ["call_dt", "anslogin", "isInScopeSkill"]
