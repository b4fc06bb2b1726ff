"""Customer records: phone to contract, contract to person."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from callweave.functions.nulls import is_true, paste
from callweave.functions.tags import rank_by_levels
from callweave.functions.text import strip
from callweave.operators.identity import content_key
from callweave.operators.lookups import any_key_member, key_set, semi
from callweave.operators.ordered import first_per_group
from callweave.operators.shape import unpivot_keys
from callweave.plans import fixed_values as fixed
from callweave.plans.calls import FULL_PHONE
from callweave.plans.params import RetentionParams
from callweave.session import materialise
from callweave.sources.tables import covering

HOME_PHONE = "NUM_TELEFONE_RESIDENCIAL"
BIRTH = "DAT_NASCIMENTO"
# Phone columns, most trusted first.
PHONES = [HOME_PHONE, "NUM_TELEFONE_FIXO_NET", "NUM_CELULAR", "NUM_TELEFONE_COMERCIAL",
          "NUM_TELEFONE_OUTROS"]
CRM_COLUMNS = ["contract", "DAT_MOVIMENTO", BIRTH, *PHONES]


@dataclass(frozen=True)
class CustomerLinks:
    by_phone: DataFrame   # btn, contract_lookup
    by_person: DataFrame  # crm_key, contract_lookup


def crm_slice(crm: DataFrame, params: RetentionParams) -> DataFrame:
    start, end = params.window.bounds
    return covering(crm, "startDate", "endDate", start, end, CRM_COLUMNS)


def called_contracts(calls: DataFrame, outcomes: DataFrame) -> DataFrame:
    return key_set((outcomes, "contract_outcome"),
                   (calls.where(F.col("contract_string_status") == "valid"), "contract"),
                   name="contract")


def wanted_customers(crm: DataFrame, calls: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Newest record per contract among those reached by a called contract or phone."""
    contracts = called_contracts(calls, outcomes)
    phones = key_set((calls.where(F.length("calling_pty_final") > FULL_PHONE),
                      "calling_pty_final"), name="phone")
    crm = crm.withColumn("_row", content_key(CRM_COLUMNS))
    found = any_key_member(
        crm, ["_row"],
        [("contract", [F.col("contract")]),
         ("phone", [F.when(F.length(p) > FULL_PHONE, F.col(p)) for p in PHONES])],
        {"contract": contracts, "phone": phones},
    )
    newest = first_per_group(found, ["contract"], [F.desc("DAT_MOVIMENTO"), F.asc("_row")])
    return newest.drop("_row").withColumnRenamed("contract", "contract_lookup") \
        .withColumn("crm_key", paste(F.col(HOME_PHONE), F.lit("_"), F.col(BIRTH)))


def contract_by_phone(customers: DataFrame, calls: DataFrame) -> DataFrame:
    """One contract per phone: by phone type, then newest record; called phones only."""
    long = unpivot_keys(customers, ["contract_lookup", "DAT_MOVIMENTO"], PHONES, "kind", "btn")
    best = first_per_group(long, ["btn"], [
        rank_by_levels(F.col("kind"), PHONES).asc(), F.desc("DAT_MOVIMENTO"),
        F.asc("contract_lookup")])
    return semi(best, calls, [("btn", "calling_pty_final")]).select("btn", "contract_lookup")


def real_person(params: RetentionParams):
    """Records whose home phone and birth date can identify a person."""
    phone, birth = strip(F.col(HOME_PHONE)), strip(F.col(BIRTH).cast("string"))
    year = F.substring(birth, 1, 4).try_cast("int")
    bad = (
        phone.isNull() | birth.isNull() | (F.length(phone) < 9) | (F.length(birth) < 5)
        | birth.isin(fixed.PLACEHOLDER_BIRTH_DATES) | is_true(year > params.last_birth_year)
    )
    return ~bad


def customer_links(
    crm: DataFrame, calls: DataFrame, outcomes: DataFrame, params: RetentionParams
) -> CustomerLinks:
    customers = materialise(wanted_customers(crm_slice(crm, params), calls, outcomes), "customers")
    by_phone = contract_by_phone(customers, calls)
    calling = called_contracts(calls, outcomes)
    if params.union_looked_up:
        looked_up = by_phone.select(F.col("contract_lookup").alias("contract"))
        calling = calling.unionByName(looked_up).distinct()
    people = semi(customers, calling, [("contract_lookup", "contract")])
    by_person = semi(customers.where(real_person(params)), people, [("crm_key", "crm_key")]) \
        .select("crm_key", "contract_lookup").distinct()
    return CustomerLinks(by_phone, by_person)
