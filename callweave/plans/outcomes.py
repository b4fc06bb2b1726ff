"""Retention outcomes in scope."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callweave.functions.dates import parse_timestamp
from callweave.functions.nulls import if_else, paste
from callweave.functions.tags import in_list
from callweave.functions.text import first_match, pad_left, strip
from callweave.operators.lookups import join_suffix
from callweave.plans import fixed_values as fixed
from callweave.plans.calls import with_ids
from callweave.plans.params import RetentionParams


def clean_outcomes(
    outcomes: DataFrame, active: DataFrame, params: RetentionParams
) -> DataFrame:
    """Outcomes of the business scope entered by agents active that day.

    ``is_in_scope_outcome`` also asks for the household view; the row filter does not. A
    login of two agents repeats the outcome, as the uniqueness check then shows.
    """
    rows = outcomes.withColumns({
        "threat_type": first_match(F.lower(strip(F.col("NM_TIPO_OCORRENCIA"))),
                                   fixed.THREAT_PATTERN),
        "contract_outcome": paste(pad_left(F.col("CD_OPERADORA"), 3),
                                  pad_left(F.col("NR_CONTRATO"), 9)),
        "isSaved": if_else(F.col("NM_SUB_INDICADOR_INTELIGENCIA") == fixed.SAVED, 1, 0),
        "is_cancelled": if_else(F.col("NM_SUB_INDICADOR_INTELIGENCIA") == fixed.SAVED, 0, 1),
    })
    business = (
        (F.col("NM_INDICADOR_NEGOCIO") == fixed.RETENTION_LEADS)
        & (F.col("NM_TIPO_CANCELAMENTO") == fixed.PRODUCT_CANCELLATION)
        & in_list(F.col("NM_SUB_INDICADOR_NEGOCIO"), fixed.SAVE_RESULTS)
        & in_list(F.col("threat_type"), params.threat_codes)
        & in_list(F.col("NM_EPS"), params.sites)
    )
    household = F.col("NM_VISAO_ANALISE") == fixed.HOUSEHOLD_VIEW
    rows = rows.where(business).withColumn("is_in_scope_outcome", if_else(household, 1, 0))
    at = parse_timestamp(F.col("DH_ABT_OCOR").cast("string"))
    rows = with_ids(rows, "outcomes_rn", params.outcome_id).withColumns({
        "DH_ABT_OCOR": at, "call_dt": F.to_date(at), "call_mn": F.month(at)})
    return join_suffix(rows, active, [("call_dt", "call_dt"), ("CD_LOGIN_USUARIO", "LOGIN_NET")],
                       how="inner")
