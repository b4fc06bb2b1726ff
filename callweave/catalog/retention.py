"""The call-to-outcome job over the given tables, stage by stage.

Call legs are the view, click and error events, outcomes the purchase and signup events. The
agent is the customer's nation, a contract is nation and customer key, a person is shared by
the customers of one nation and market segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.catalog.registry import Tables, query, with_tables
from callweave.functions.dates import add_seconds
from callweave.plans import fixed_values as fixed
from callweave.plans.facts import DERIVED_COLUMNS, fact_checks, fact_summary, in_scope
from callweave.plans.params import RetentionParams, RunWindow
from callweave.plans.reports import call_rates, outcome_rates
from callweave.plans.retention import Retention
from callweave.plans.sensors import stored_fact_sensor
from callweave.session import scratch_path
from callweave.sources.sinks import read_slices, replace_slice

PARAMS = RetentionParams(window=RunWindow.of("2024-01-01", "2024-02-01"),
                         call_id="segment", outcome_id="outcome_no", many_days=True)


def _events(t: Tables) -> DataFrame:
    return t.events.join(t.customer, F.col("user_id") == F.col("c_custkey"))


def _text(name: str):
    return F.col(name).cast("string")


def call_legs(t: Tables) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    contract = F.concat(F.lpad(_text("c_nationkey"), 3, "0"), F.lpad(_text("c_custkey"), 9, "0"))
    columns = {
        "callid": F.concat(_text("user_id"), F.lit("-"), F.to_date("ts").cast("string")),
        "segment": F.col("event_id"),
        "calling_pty": F.when(kind == "click", F.lpad(_text("user_id"), 7, "0"))
        .when(value > 3, F.concat(F.lit("11"), F.lpad(_text("user_id"), 8, "0"))),
        "disposition": F.when(kind == "error", 1).otherwise(2),
        "segstart": F.col("ts"),
        "segstop": add_seconds(F.col("ts"), F.floor("value") + 15),
        "disptime": F.lit(10), "talktime": F.floor("value").cast("int"), "ansholdtime": F.lit(5),
        "dispsplit": F.when(value < 2, 999).when(kind == "view", 695).when(value < 30, 529)
        .otherwise(534),
        "dispvdn": F.col("c_nationkey"),
        "anslogin": F.concat(F.lit("7"), F.lpad(_text("c_nationkey"), 3, "0")),
        "ASAIUUI": F.when(value < 5, "000000000000").when(value < 8, "  ").when(value < 10, None)
        .otherwise(F.concat(F.lit("'"), contract, F.lit("999 "))),
        "Filename": F.lit("legs.csv"),
    }
    return _events(t).where(kind.isin("view", "click", "error")) \
        .select(*[c.alias(n) for n, c in columns.items()])


LEGS = """legs AS (
  SELECT user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS callid, event_id AS segment,
    CASE WHEN event_type = 'click' THEN lpad(CAST(user_id AS VARCHAR), 7, '0')
         WHEN value > 3 THEN '11' || lpad(CAST(user_id AS VARCHAR), 8, '0') END AS calling_pty,
    CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS disposition, ts AS segstart,
    ts + INTERVAL 1 SECOND * (CAST(floor(value) AS BIGINT) + 15) AS segstop, 10 AS disptime,
    CAST(floor(value) AS INTEGER) AS talktime, 5 AS ansholdtime,
    CASE WHEN value < 2 THEN 999 WHEN event_type = 'view' THEN 695 WHEN value < 30 THEN 529 ELSE 534 END AS dispsplit,
    c_nationkey AS dispvdn, '7' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS anslogin,
    CASE WHEN value < 5 THEN '000000000000' WHEN value < 8 THEN '  ' WHEN value < 10 THEN NULL
         ELSE '''' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '999 ' END AS ASAIUUI
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type IN ('view', 'click', 'error'))"""


def outcome_rows(t: Tables) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    columns = {
        "outcome_no": F.col("event_id"),
        "DH_ABT_OCOR": F.col("ts"),
        "NM_TIPO_OCORRENCIA": F.when(kind == "purchase", " CO2 - x").when(value < 6, "CO99 y")
        .otherwise("co15-z"),
        "CD_OPERADORA": F.col("c_nationkey"), "NR_CONTRATO": F.col("c_custkey"),
        "NM_SUB_INDICADOR_INTELIGENCIA": F.when(value >= 20, "RETIDO")
        .when(value >= 1, "NAO RETIDO"),
        "NM_VISAO_ANALISE": F.when((kind == "purchase") | (value < 50), fixed.HOUSEHOLD_VIEW)
        .otherwise("INDIVIDUO"),
        "NM_INDICADOR_NEGOCIO": F.lit("LEADS RETENCAO"),
        "NM_TIPO_CANCELAMENTO": F.when(value < 150, "PRODUTOS").otherwise("OUTROS"),
        "NM_SUB_INDICADOR_NEGOCIO": F.when(value >= 20, "RETIDO").otherwise("NAO RETIDO"),
        "NM_EPS": F.lit("AEC"),
        "CD_LOGIN_USUARIO": F.concat(F.lit("net"), _text("c_nationkey")),
        "Filename": F.lit("outcomes.csv"),
    }
    return _events(t).where(kind.isin("purchase", "signup")) \
        .select(*[c.alias(n) for n, c in columns.items()])


OUTCOMES = f"""outcome_rows AS (
  SELECT event_id AS outcome_no, ts AS DH_ABT_OCOR,
    CASE WHEN event_type = 'purchase' THEN ' CO2 - x' WHEN value < 6 THEN 'CO99 y' ELSE 'co15-z' END AS NM_TIPO_OCORRENCIA,
    c_nationkey AS CD_OPERADORA, c_custkey AS NR_CONTRATO,
    CASE WHEN value >= 20 THEN 'RETIDO' WHEN value >= 1 THEN 'NAO RETIDO' END AS NM_SUB_INDICADOR_INTELIGENCIA,
    CASE WHEN event_type = 'purchase' OR value < 50 THEN '{fixed.HOUSEHOLD_VIEW}' ELSE 'INDIVIDUO' END AS NM_VISAO_ANALISE,
    'LEADS RETENCAO' AS NM_INDICADOR_NEGOCIO, CASE WHEN value < 150 THEN 'PRODUTOS' ELSE 'OUTROS' END AS NM_TIPO_CANCELAMENTO,
    CASE WHEN value >= 20 THEN 'RETIDO' ELSE 'NAO RETIDO' END AS NM_SUB_INDICADOR_NEGOCIO, 'AEC' AS NM_EPS,
    'net' || c_nationkey AS CD_LOGIN_USUARIO
  FROM events JOIN customer ON user_id = c_custkey WHERE event_type IN ('purchase', 'signup'))"""


def agent_rows(t: Tables) -> DataFrame:
    nation = _text("n_nationkey")
    row = lambda net, a, b, site: F.struct(
        net.alias("LOGIN_NET"), F.lit(a).alias("Startdate"), F.lit(b).alias("Enddate"),
        site.alias("TERCEIRA"))
    own = F.concat(F.lit("net"), nation, F.lit(" x"))
    later = F.when(F.col("n_regionkey") == 0, F.concat(F.lit("alt"), nation)).otherwise(own)
    site = F.when(F.col("n_nationkey") == 7, "Other").otherwise("Site AeC one")
    rows = F.array(row(own, "2023-12-01", "2024-01-17", site),
                   row(later, "2024-01-15", "2024-01-29", F.lit("AEC two")))
    return t.nation.select(F.concat(F.lit("7"), F.lpad(nation, 3, "0")).alias("LOGIN_TELEFONIA"),
                           F.inline(rows))


AGENTS = """agent_text AS (
  SELECT '7' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS LOGIN_TELEFONIA, 'net' || n_nationkey || ' x' AS LOGIN_NET,
         '2023-12-01' AS Startdate, '2024-01-17' AS Enddate,
         CASE WHEN n_nationkey = 7 THEN 'Other' ELSE 'Site AeC one' END AS TERCEIRA FROM nation
  UNION ALL
  SELECT '7' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0'),
         CASE WHEN n_regionkey = 0 THEN 'alt' || n_nationkey ELSE 'net' || n_nationkey || ' x' END,
         '2024-01-15', '2024-01-29', 'AEC two' FROM nation),
agent_map AS (
  SELECT * FROM (SELECT LOGIN_TELEFONIA, regexp_extract(LOGIN_NET, '[[:alnum:]]+') AS LOGIN_NET,
                        CAST(Startdate AS DATE) AS Startdate, CAST(Enddate AS DATE) - 1 AS Enddate FROM agent_text
                 WHERE TERCEIRA ILIKE '%aec%')
  WHERE LOGIN_TELEFONIA <> '0' AND length(LOGIN_TELEFONIA) > 1 AND length(LOGIN_NET) > 1)"""


def crm_rows(t: Tables) -> DataFrame:
    nation, key, seg = _text("c_nationkey"), _text("c_custkey"), F.col("c_mktsegment")
    born = F.when(seg == "HOUSEHOLD", fixed.PLACEHOLDER_BIRTH_DATES[0]).otherwise(
        F.concat(F.lit("19"), (F.length(seg) + 60).cast("string"), F.lit("-02-03 00:00:00")))
    row = lambda month, birth, mobile: F.struct(
        F.lit(month).alias("DAT_MOVIMENTO"), birth.alias("DAT_NASCIMENTO"),
        mobile.alias("NUM_CELULAR"))
    own = F.concat(F.lit("11"), F.lpad(key, 8, "0"))
    rows = F.array(row("2023-12-01", F.lit("1970-01-01 00:00:00"), own),
                   row("2024-01-01", born, F.when(F.col("c_acctbal") > 8000, None).otherwise(own)))
    return t.customer.select(
        F.concat(F.lpad(nation, 3, "0"), F.lpad(key, 9, "0")).alias("contract"), F.inline(rows),
        F.concat(F.lit("119"), F.lpad(nation, 6, "0")).alias("NUM_TELEFONE_RESIDENCIAL"),
        F.when(F.col("c_acctbal") > 4000, F.concat(F.lit("11"), F.lpad(key, 8, "0")))
        .alias("NUM_TELEFONE_FIXO_NET"),
        F.lit(None).cast("string").alias("NUM_TELEFONE_COMERCIAL"),
        F.lpad(key, 7, "0").alias("NUM_TELEFONE_OUTROS"),
        F.lit("2020-01-01").cast("date").alias("startDate"),
        F.when(F.col("c_acctbal") < 500, "2024-01-10").otherwise("2025-01-01").cast("date")
        .alias("endDate"))


CRM = f"""crm AS (
  SELECT lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS contract, m.movement AS DAT_MOVIMENTO,
    CASE WHEN m.movement = '2023-12-01' THEN '1970-01-01 00:00:00' WHEN c_mktsegment = 'HOUSEHOLD' THEN '{fixed.PLACEHOLDER_BIRTH_DATES[0]}'
         ELSE '19' || (length(c_mktsegment) + 60) || '-02-03 00:00:00' END AS DAT_NASCIMENTO,
    '119' || lpad(CAST(c_nationkey AS VARCHAR), 6, '0') AS NUM_TELEFONE_RESIDENCIAL,
    CASE WHEN c_acctbal > 4000 THEN '11' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS NUM_TELEFONE_FIXO_NET,
    CASE WHEN m.movement = '2023-12-01' OR c_acctbal <= 8000 THEN '11' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS NUM_CELULAR,
    CAST(NULL AS VARCHAR) AS NUM_TELEFONE_COMERCIAL, lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS NUM_TELEFONE_OUTROS,
    DATE '2020-01-01' AS startDate, CASE WHEN c_acctbal < 500 THEN DATE '2024-01-10' ELSE DATE '2025-01-01' END AS endDate
  FROM customer, (SELECT unnest(['2023-12-01', '2024-01-01']) AS movement) m)"""

_LIST = lambda codes: ", ".join(str(c) for c in codes)
ENRICHED = f"""first_phone AS (
  SELECT callid, calling_pty FROM (SELECT callid, calling_pty, row_number() OVER (PARTITION BY callid ORDER BY segment) AS rn
                                   FROM legs WHERE length(calling_pty) > 9) WHERE rn = 1),
timed AS (
  SELECT a.* EXCLUDE (segstop), a.segment AS calls_rn, a.segstop,
    CASE WHEN length(a.calling_pty) = 7 AND b.calling_pty IS NOT NULL THEN b.calling_pty ELSE a.calling_pty END AS calling_pty_final,
    CAST(segstart AS DATE) AS call_dt, CAST(month(segstart) AS INTEGER) AS call_mn,
    segstart + INTERVAL 1 SECOND * disptime AS talk_start_tm,
    segstart + INTERVAL 1 SECOND * (disptime + 120) AS talk_start_tm_with_buffer,
    segstart + INTERVAL 1 SECOND * (disptime + talktime + ansholdtime) AS talk_end_tm,
    CASE WHEN dispsplit IN ({_LIST(PARAMS.in_scope)}) THEN 1 ELSE 0 END AS isInScopeSkill,
    substring(regexp_replace(trim(ASAIUUI), '^''', ''), 1, 12) AS contract,
    CASE WHEN dispsplit IN ({_LIST(fixed.RETENTION_EXTERNAL)}) THEN 'retention_external'
         WHEN dispsplit IN ({_LIST(fixed.RETENTION_TRANSFER)}) THEN 'retention_transfer'
         WHEN dispsplit IN ({_LIST(fixed.RETENTION_INTERNAL)}) THEN 'retention_internal' ELSE 'other' END AS retention_type
  FROM legs a LEFT JOIN first_phone b ON a.callid = b.callid WHERE disposition = 2),
enriched AS (
  SELECT *, CASE WHEN contract_string_status = 'valid' THEN 1 ELSE 0 END AS is_contract_originally_populated,
    coalesce(lead(talk_start_tm) OVER (PARTITION BY anslogin, call_dt ORDER BY segstart, calls_rn),
             max(talk_end_tm) OVER (PARTITION BY anslogin, call_dt) + INTERVAL 5 MINUTE) AS next_talk_start_tm
  FROM (SELECT *, CASE WHEN regexp_matches(contract, '^0+$') THEN 'zero' WHEN length(trim(contract)) = 0 THEN 'blank'
                       ELSE 'valid' END AS contract_string_status FROM timed))"""
DAYS = """agent_days AS (
  SELECT DISTINCT call_dt, anslogin, m.LOGIN_NET
  FROM (SELECT DISTINCT call_dt, anslogin FROM enriched WHERE isInScopeSkill = 1) d
  LEFT JOIN agent_map m ON d.anslogin = m.LOGIN_TELEFONIA AND m.Startdate <= d.call_dt AND m.Enddate > d.call_dt)"""
CLEANED = f"""cleaned AS (
  SELECT o.*, o.outcome_no AS outcomes_rn, CAST(o.DH_ABT_OCOR AS DATE) AS call_dt, CAST(month(o.DH_ABT_OCOR) AS INTEGER) AS call_mn, a.anslogin
  FROM (SELECT *, regexp_extract(lower(trim(NM_TIPO_OCORRENCIA)), '^co\\d{{1,2}}') AS threat_type,
      lpad(CAST(CD_OPERADORA AS VARCHAR), 3, '0') || lpad(CAST(NR_CONTRATO AS VARCHAR), 9, '0') AS contract_outcome,
      CASE WHEN NM_SUB_INDICADOR_INTELIGENCIA = 'RETIDO' THEN 1 WHEN NM_SUB_INDICADOR_INTELIGENCIA <> 'RETIDO' THEN 0 END AS isSaved,
      CASE WHEN NM_SUB_INDICADOR_INTELIGENCIA = 'RETIDO' THEN 0 WHEN NM_SUB_INDICADOR_INTELIGENCIA <> 'RETIDO' THEN 1 END AS is_cancelled,
      CASE WHEN NM_VISAO_ANALISE = '{fixed.HOUSEHOLD_VIEW}' THEN 1 ELSE 0 END AS is_in_scope_outcome FROM outcome_rows) o
  JOIN agent_days a ON CAST(o.DH_ABT_OCOR AS DATE) = a.call_dt AND o.CD_LOGIN_USUARIO = a.LOGIN_NET
  WHERE NM_INDICADOR_NEGOCIO = 'LEADS RETENCAO' AND NM_TIPO_CANCELAMENTO = 'PRODUTOS'
    AND NM_SUB_INDICADOR_NEGOCIO IN ('RETIDO', 'NAO RETIDO') AND NM_EPS IN ('AEC SINGLE', 'AEC', 'AEC URA')
    AND threat_type IN ('co2', 'co4', 'co11', 'co13', 'co15', 'co17', 'co19', 'co48', 'co49', 'co50'))"""
_PHONES = ["NUM_TELEFONE_RESIDENCIAL", "NUM_TELEFONE_FIXO_NET", "NUM_CELULAR", "NUM_TELEFONE_COMERCIAL", "NUM_TELEFONE_OUTROS"]
LINKS = f"""contracts AS (
  SELECT contract_outcome AS contract FROM cleaned UNION SELECT contract FROM enriched WHERE contract_string_status = 'valid' AND contract IS NOT NULL),
phones AS (SELECT DISTINCT calling_pty_final AS phone FROM enriched WHERE length(calling_pty_final) > 9),
crm_raw AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT * EXCLUDE (contract), contract AS contract_lookup, NUM_TELEFONE_RESIDENCIAL || '_' || DAT_NASCIMENTO AS crm_key,
           row_number() OVER (PARTITION BY contract ORDER BY DAT_MOVIMENTO DESC) AS rn
    FROM crm WHERE startDate <= DATE '2024-01-01' AND endDate >= DATE '2024-02-01' AND (
      contract IN (SELECT contract FROM contracts)
      {" ".join(f"OR (length({p}) > 9 AND {p} IN (SELECT phone FROM phones))" for p in _PHONES)}))
  WHERE rn = 1),
long_phones AS ({" UNION ALL ".join(
    f"SELECT contract_lookup, DAT_MOVIMENTO, {i} AS pr, {p} AS btn FROM crm_raw WHERE {p} IS NOT NULL" for i, p in enumerate(_PHONES))}),
by_phone AS (
  SELECT btn, contract_lookup FROM (SELECT *, row_number() OVER (PARTITION BY btn ORDER BY pr, DAT_MOVIMENTO DESC, contract_lookup) AS rn FROM long_phones)
  WHERE rn = 1 AND btn IN (SELECT calling_pty_final FROM enriched)),
calling AS (SELECT contract FROM contracts UNION SELECT contract_lookup FROM by_phone),
by_person AS (
  SELECT DISTINCT a.crm_key, a.contract_lookup FROM crm_raw a
  JOIN (SELECT crm_key FROM crm_raw WHERE contract_lookup IN (SELECT contract FROM calling)) b ON a.crm_key = b.crm_key
  WHERE length(trim(NUM_TELEFONE_RESIDENCIAL)) >= 9 AND length(trim(DAT_NASCIMENTO)) >= 5
    AND trim(DAT_NASCIMENTO) NOT IN ('{fixed.PLACEHOLDER_BIRTH_DATES[0]}', '{fixed.PLACEHOLDER_BIRTH_DATES[1]}')
    AND CAST(left(trim(DAT_NASCIMENTO), 4) AS INTEGER) <= 2019)"""
CASCADE = """looked_up AS (
  SELECT e.* EXCLUDE (contract, contract_string_status), b.contract_lookup, contract_string_status AS status_0,
         CASE WHEN contract_string_status = 'valid' THEN contract END AS contract
  FROM enriched e LEFT JOIN by_phone b ON e.calling_pty_final = b.btn),
finalised AS (
  SELECT * EXCLUDE (status_0), CASE WHEN contract IS NULL AND length(contract_lookup) = 12 THEN contract_lookup ELSE contract END AS contract_final,
         CASE WHEN contract IS NULL AND length(contract_lookup) = 12 THEN 'valid_lookup'
              WHEN NOT (contract IS NULL AND length(contract_lookup) = 12) THEN status_0 END AS contract_string_status
  FROM looked_up),
call_rows AS (
  SELECT f.*, p.crm_key, least(next_talk_start_tm + INTERVAL 2 MINUTE, talk_end_tm + INTERVAL 5 MINUTE) AS weak_end,
    coalesce(lead(talk_start_tm) OVER (PARTITION BY call_dt, anslogin, contract_final, calling_pty_final ORDER BY segstart, calls_rn),
             CASE WHEN segstart = date_trunc('day', segstart) THEN segstart ELSE CAST(call_dt + 1 AS TIMESTAMP) END) AS strong_end
  FROM finalised f LEFT JOIN by_person p ON f.contract_final = p.contract_lookup),
outcome_list AS (SELECT c.*, p.crm_key FROM cleaned c LEFT JOIN by_person p ON c.contract_outcome = p.contract_lookup),
with_agent AS (
  SELECT * FROM (SELECT o.*, m.LOGIN_TELEFONIA,
      row_number() OVER (PARTITION BY outcomes_rn ORDER BY m.Startdate DESC, m.Enddate DESC, m.LOGIN_TELEFONIA DESC) AS rn
    FROM outcome_list o LEFT JOIN agent_map m ON o.CD_LOGIN_USUARIO = m.LOGIN_NET AND m.Startdate <= o.call_dt AND m.Enddate >= o.call_dt)
  WHERE rn = 1),
hit_1 AS (
  SELECT calls_rn, segstart, outcomes_rn, row_number() OVER (PARTITION BY calls_rn ORDER BY DH_ABT_OCOR DESC, outcomes_rn DESC) AS rn
  FROM call_rows c JOIN with_agent o ON c.call_dt = o.call_dt AND c.anslogin = o.LOGIN_TELEFONIA AND c.contract_final = o.contract_outcome
    AND o.DH_ABT_OCOR >= c.talk_start_tm AND o.DH_ABT_OCOR < c.strong_end
  WHERE c.contract_string_status IN ('valid', 'valid_lookup')),
map_1 AS (SELECT calls_rn, outcomes_rn FROM (
  SELECT *, row_number() OVER (PARTITION BY outcomes_rn ORDER BY segstart DESC, calls_rn DESC) AS o_rn FROM hit_1 WHERE rn = 1) WHERE o_rn = 1),
hit_2 AS (
  SELECT calls_rn, segstart, outcomes_rn, row_number() OVER (PARTITION BY calls_rn ORDER BY DH_ABT_OCOR DESC, outcomes_rn DESC) AS rn
  FROM call_rows c JOIN with_agent o ON c.call_dt = o.call_dt AND c.anslogin = o.LOGIN_TELEFONIA AND c.crm_key = o.crm_key
    AND o.DH_ABT_OCOR >= c.talk_start_tm AND o.DH_ABT_OCOR < c.strong_end
  WHERE c.contract_string_status IN ('valid', 'valid_lookup') AND c.contract_final <> o.contract_outcome
    AND o.outcomes_rn NOT IN (SELECT outcomes_rn FROM map_1)),
map_2 AS (SELECT calls_rn, outcomes_rn FROM (
  SELECT *, row_number() OVER (PARTITION BY outcomes_rn ORDER BY segstart DESC, calls_rn DESC) AS o_rn FROM hit_2 WHERE rn = 1) WHERE o_rn = 1),
hit_3 AS (
  SELECT calls_rn, segstart, outcomes_rn, row_number() OVER (PARTITION BY calls_rn ORDER BY DH_ABT_OCOR DESC, outcomes_rn DESC) AS rn
  FROM call_rows c JOIN with_agent o ON c.call_dt = o.call_dt AND c.anslogin = o.LOGIN_TELEFONIA
    AND o.DH_ABT_OCOR >= c.talk_start_tm_with_buffer AND o.DH_ABT_OCOR < c.weak_end
  WHERE coalesce(c.contract_string_status NOT IN ('valid', 'valid_lookup'), true)
    AND o.outcomes_rn NOT IN (SELECT outcomes_rn FROM map_1) AND o.outcomes_rn NOT IN (SELECT outcomes_rn FROM map_2)),
map_3 AS (SELECT calls_rn, outcomes_rn FROM (
  SELECT *, row_number() OVER (PARTITION BY outcomes_rn ORDER BY segstart DESC, calls_rn DESC) AS o_rn FROM hit_3 WHERE rn = 1) WHERE o_rn = 1),
steps AS (
  SELECT calls_rn, outcomes_rn, join_step FROM (
    SELECT *, row_number() OVER (PARTITION BY calls_rn ORDER BY join_step) AS rn FROM (
      SELECT *, 1 AS join_step FROM map_1 UNION ALL SELECT *, 2 FROM map_2 UNION ALL SELECT *, 3 FROM map_3)) WHERE rn = 1)"""
FACTS = """facts AS (
  SELECT c.* EXCLUDE (contract_lookup), s.outcomes_rn, s.join_step, o.* EXCLUDE (call_dt, call_mn, anslogin, crm_key, outcomes_rn, isSaved),
         CASE WHEN s.outcomes_rn IS NULL THEN 0 ELSE 1 END AS isJoined,
         CASE WHEN s.outcomes_rn IS NULL THEN 1 ELSE o.isSaved END AS isSaved
  FROM call_rows c LEFT JOIN steps s ON c.calls_rn = s.calls_rn LEFT JOIN outcome_list o ON s.outcomes_rn = o.outcomes_rn)"""
STAGE_1 = [LEGS, ENRICHED]
STAGE_2 = [*STAGE_1, AGENTS, DAYS]
STAGE_3 = [*STAGE_2, OUTCOMES, CLEANED]
STAGE_4 = [*STAGE_3, CRM, LINKS]
STAGE_5 = [*STAGE_4, CASCADE]
STAGE_6 = [*STAGE_5, FACTS]

CALL_OUT = ["calls_rn", "calling_pty_final", "call_dt", "call_mn", "talk_start_tm", "talk_start_tm_with_buffer",
            "talk_end_tm", "isInScopeSkill", "contract", "contract_string_status",
            "is_contract_originally_populated", "retention_type", "next_talk_start_tm"]


def _sql(columns: list[str]) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c == "call_dt" else c for c in columns)


def _run(t: Tables, **options) -> Retention:
    return Retention(call_legs(t), outcome_rows(t), agent_rows(t), crm_rows(t), PARAMS, **options)


@query(with_tables(STAGE_1, f"SELECT {_sql(CALL_OUT)} FROM enriched"))
def job_call_enrichment(t: Tables):
    return _run(t).answered.select(*CALL_OUT)


@query(with_tables(STAGE_2, f"SELECT {_sql(['call_dt', 'anslogin', 'LOGIN_NET'])} FROM agent_days"))
def job_agent_days(t: Tables):
    return _run(t).active


OUTCOME_OUT = ["outcomes_rn", "call_dt", "call_mn", "anslogin", "threat_type", "contract_outcome",
               "isSaved", "is_cancelled", "is_in_scope_outcome", "DH_ABT_OCOR"]


@query(with_tables(STAGE_3, f"SELECT {_sql(OUTCOME_OUT)} FROM cleaned"), as_text=["isSaved", "is_cancelled"])
def job_outcome_clean(t: Tables):
    return _run(t).cleaned.select(*OUTCOME_OUT)


@query(with_tables(STAGE_5, f"""
SELECT {_sql(["calls_rn", "contract", "contract_final", "contract_string_status", "crm_key", "strong_end", "weak_end"])} FROM call_rows"""))
def job_customer_link(t: Tables):
    return _run(t).linked_calls.select("calls_rn", "contract", "contract_final", "contract_string_status",
                                "crm_key", "strong_end", "weak_end")


@query(with_tables(STAGE_5, "SELECT * FROM steps"))
def job_cascade_match(t: Tables):
    return _run(t, links_only=True).steps


@query(with_tables(STAGE_6, """
SELECT 'calls' AS check_name, count(calls_rn) AS n_rows, count(DISTINCT calls_rn) AS n_distinct,
       CASE WHEN count(calls_rn) = count(DISTINCT calls_rn) THEN 1 ELSE 0 END AS is_unique FROM facts
UNION ALL SELECT 'outcomes', count(outcomes_rn), count(DISTINCT outcomes_rn),
       CASE WHEN count(outcomes_rn) = count(DISTINCT outcomes_rn) THEN 1 ELSE 0 END FROM facts"""))
def job_fact_checks(t: Tables):
    return fact_checks(_run(t).fact_rows)


_CONCAT = lambda c: (f"string_agg(coalesce(CAST({c} AS VARCHAR), 'NA'), ',' ORDER BY DH_ABT_OCOR, outcomes_rn) AS {c}_concat")


@query(with_tables(STAGE_6, f"""
SELECT calls_rn, contract_final, calling_pty_final, crm_key, dispsplit, dispvdn, segstart, segstop, count(*) AS outcomes_count,
       CAST(coalesce(sum(is_cancelled), 0) AS BIGINT) AS number_of_cancels,
       {", ".join(_CONCAT(c) for c in ["outcomes_rn", "NM_SUB_INDICADOR_INTELIGENCIA", "NM_TIPO_OCORRENCIA", "DH_ABT_OCOR", "CD_OPERADORA"])}
FROM facts WHERE isInScopeSkill = 1 GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""))
def job_fact_summary(t: Tables):
    return fact_summary(_run(t).fact_rows)


_RATE = lambda part, whole: f"round(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, 6)"
_ROUNDED = lambda df: df.select(*[
    F.round(f.name, 6).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
    for f in df.schema.fields])


@query(with_tables(STAGE_6, f"""
SELECT CAST(call_dt AS VARCHAR) AS call_dt, n AS calls_count_inScope, j AS calls_count_isJoined, j AS calls_count_inScope_isJoined,
       s AS calls_count_isSaved, sc AS calls_count_isSaved_conservative,
       {_RATE("j", "n")} AS disposition_rate, {_RATE("s1", "n")} AS disposition_rate_step_1, {_RATE("s2", "n")} AS disposition_rate_step_2,
       {_RATE("s", "n")} AS save_Rate, {_RATE("sc", "n")} AS save_Rate_conservative, {_RATE("sc", "j")} AS save_rate_conservative_dispositioned_only
FROM (SELECT call_dt, count(*) AS n, count(*) FILTER (WHERE isJoined = 1) AS j, CAST(coalesce(sum(isSaved), 0) AS BIGINT) AS s,
             count(*) FILTER (WHERE join_step = 1) AS s1, count(*) FILTER (WHERE join_step = 2) AS s2,
             count(*) FILTER (WHERE isJoined = 1 AND isSaved = 1) AS sc
      FROM facts WHERE isInScopeSkill = 1 GROUP BY call_dt)"""))
def job_call_rates(t: Tables):
    return _ROUNDED(call_rates(in_scope(_run(t).fact_rows)))


@query(with_tables(STAGE_5, f"""
SELECT CAST(call_dt AS VARCHAR) AS call_dt, n AS outcomes_count_inScope, s1 + s2 + s3 AS outcomes_count_isJoined,
       s1 AS outcomes_count_isJoined_step_1, s2 AS outcomes_count_isJoined_step_2, s3 AS outcomes_count_isJoined_step_3,
       {_RATE("s1 + s2 + s3", "n")} AS match_rate, {_RATE("s1", "n")} AS match_rate_step_1, {_RATE("s2", "n")} AS match_rate_step_2,
       {_RATE("s3", "n")} AS match_rate_step_3
FROM (SELECT o.call_dt, CAST(coalesce(sum(is_in_scope_outcome), 0) AS BIGINT) AS n,
             {", ".join(f"count(*) FILTER (WHERE is_in_scope_outcome = 1 AND join_step = {s}) AS s{s}" for s in (1, 2, 3))}
      FROM outcome_list o LEFT JOIN steps s ON o.outcomes_rn = s.outcomes_rn GROUP BY 1)"""))
def job_match_rates(t: Tables):
    run = _run(t, links_only=True)
    return _ROUNDED(outcome_rates(run.linked_outcomes, run.steps))


_CALL_COLS = ["callid", "segment", "calling_pty", "disposition", "segstart", "segstop", "disptime", "talktime",
              "ansholdtime", "dispsplit", "dispvdn", "anslogin", "ASAIUUI"]
_OUTCOME_COLS = ["outcome_no", "DH_ABT_OCOR", "NM_TIPO_OCORRENCIA", "CD_OPERADORA", "NR_CONTRATO",
                 "NM_SUB_INDICADOR_INTELIGENCIA", "NM_VISAO_ANALISE", "NM_INDICADOR_NEGOCIO", "NM_TIPO_CANCELAMENTO",
                 "NM_SUB_INDICADOR_NEGOCIO", "NM_EPS", "CD_LOGIN_USUARIO"]
LAYOUT = f"""stored AS (
  SELECT {", ".join(f"f.{c} AS echi_{c}" for c in _CALL_COLS)}, {", ".join(f"f.{c} AS outcomes_{c}" for c in _OUTCOME_COLS)},
         {", ".join(f"CAST(f.{c} AS VARCHAR) AS {c}" if c == "call_dt" else c if c in ("LOGIN_NET", "isAgentMapped") else f"f.{c}" for c in DERIVED_COLUMNS)}
  FROM (SELECT f.*, a.LOGIN_NET, CASE WHEN a.LOGIN_NET IS NULL THEN 0 ELSE 1 END AS isAgentMapped
        FROM facts f LEFT JOIN (SELECT call_dt, anslogin, min(LOGIN_NET) AS LOGIN_NET FROM agent_days GROUP BY 1, 2) a
        ON f.call_dt = a.call_dt AND f.anslogin = a.anslogin WHERE isInScopeSkill = 1) f)"""


@query(with_tables([*STAGE_6, LAYOUT], "SELECT * FROM stored"), as_text=["join_step", "outcomes_CD_OPERADORA", "outcomes_NR_CONTRATO", "outcomes_outcome_no", "outcomes_rn", "isSaved"])
def job_fact_layout(t: Tables):
    return _run(t).layout_rows


@query(with_tables([*STAGE_6, LAYOUT], f"""
SELECT n AS calls_count_inScope, j AS calls_count_isJoined, s AS calls_count_isSaved, {_RATE("j", "n")} AS disposition_rate,
       {_RATE("s", "n")} AS save_Rate
FROM (SELECT CAST(coalesce(sum(isInScopeSkill), 0) AS BIGINT) AS n, count(*) FILTER (WHERE isInScopeSkill = 1 AND isJoined = 1) AS j,
             CAST(coalesce(sum(isSaved), 0) AS BIGINT) AS s FROM stored
      WHERE echi_segstart >= TIMESTAMP '2024-01-08' AND echi_segstart < TIMESTAMP '2024-01-22')"""))
def job_stored_sensor(t: Tables):
    """The fact is stored by the slice writer, then summarised from the stored table."""
    path = scratch_path(t.spark, "stored-fact")
    replace_slice(_run(t).stored_rows, path, "echi_segstart", PARAMS.window.start, PARAMS.window.end)
    return _ROUNDED(stored_fact_sensor(read_slices(t.spark, path, "2024-01-08", "2024-01-22"),
                                       RunWindow.of("2024-01-08", "2024-01-22")))


@query(with_tables([*STAGE_6, LAYOUT], """
SELECT 'calls_linked' AS check_name, (SELECT count(*) FROM enriched) AS n_before, (SELECT count(*) FROM facts) AS n_after, 1 AS is_equal
UNION ALL SELECT 'outcomes_linked', (SELECT count(*) FROM cleaned), (SELECT count(*) FROM cleaned), 1
UNION ALL SELECT 'facts', (SELECT count(*) FROM enriched), (SELECT count(*) FROM facts), 1
UNION ALL SELECT 'agent_login', (SELECT count(*) FROM facts WHERE isInScopeSkill = 1), (SELECT count(*) FROM stored), 1
"""))
def job_count_checks(t: Tables):
    return _run(t).count_checks
