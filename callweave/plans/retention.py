"""The daily call-to-outcome job, stage by stage."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame

from callweave.operators.metrics import count_check
from callweave.plans.calls import agent_days, agent_map, answered_calls, phones_left
from callweave.plans.cascade import cascade, linked_calls, linked_outcomes
from callweave.plans.customers import CustomerLinks, customer_links
from callweave.plans.facts import in_scope, linked_facts, output_layout, with_agent_login
from callweave.plans.outcomes import clean_outcomes
from callweave.plans.params import RetentionParams
from callweave.session import materialise
from callweave.sources.tables import time_slice


#: Columns of calls and outcomes that later stages read up to the links and the outcome rates.
LINK_CALLS = [
    "calls_rn", "call_dt", "anslogin", "calling_pty_final", "segstart", "talk_start_tm",
    "talk_start_tm_with_buffer", "talk_end_tm", "next_talk_start_tm", "isInScopeSkill",
    "contract", "contract_string_status"]
LINK_OUTCOMES = ["outcomes_rn", "call_dt", "CD_LOGIN_USUARIO", "contract_outcome", "DH_ABT_OCOR",
                 "is_in_scope_outcome"]


@dataclass
class Retention:
    """Source tables in, linked facts out. A stage is built when it is first asked for;
    stages that feed several later ones are written once to the shared folder.

    With ``links_only`` the stages have the same rows with the columns that links and outcome
    rates are made of; there are no facts then.
    """

    legs: DataFrame
    outcomes: DataFrame
    agents: DataFrame
    crm: DataFrame
    params: RetentionParams
    #: ``phones_left`` of the run of the window before: a call may go on over midnight.
    earlier_phones: DataFrame | None = None
    links_only: bool = False

    def __post_init__(self) -> None:
        if not self.params.many_days:
            self.params.window.require_one_day()

    def _slice(self, df: DataFrame, time: str) -> DataFrame:
        return time_slice(df, time, self.params.window.start, self.params.window.end)

    @cached_property
    def mapping(self) -> DataFrame:
        return agent_map(self.agents, self.params)

    @cached_property
    def answered(self) -> DataFrame:
        legs = self._slice(self.legs, "segstart")
        rows = answered_calls(legs, self.params, self.earlier_phones)
        return materialise(self._read_later(rows, LINK_CALLS), "answered-calls")

    def _read_later(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        return rows.select(*columns) if self.links_only else rows

    @property
    def phones_left(self) -> DataFrame:
        """For the run of the next window; store it with the window."""
        return phones_left(self._slice(self.legs, "segstart"), self.earlier_phones)

    @cached_property
    def active(self) -> DataFrame:
        return agent_days(self.answered, self.mapping, self.params)

    @cached_property
    def cleaned(self) -> DataFrame:
        rows = self._slice(self.outcomes, "DH_ABT_OCOR")
        rows = clean_outcomes(rows, self.active, self.params)
        return materialise(self._read_later(rows, LINK_OUTCOMES), "clean-outcomes")

    @cached_property
    def links(self) -> CustomerLinks:
        return customer_links(self.crm, self.answered, self.cleaned, self.params)

    @cached_property
    def linked_calls(self) -> DataFrame:
        return materialise(linked_calls(self.answered, self.links), "linked-calls")

    @cached_property
    def linked_outcomes(self) -> DataFrame:
        return materialise(linked_outcomes(self.cleaned, self.links), "linked-outcomes")

    @cached_property
    def steps(self) -> DataFrame:
        steps = cascade(self.linked_calls, self.linked_outcomes, self.mapping, self.params)
        return materialise(steps, "link-steps")

    @property
    def fact_rows(self) -> DataFrame:
        """``facts`` for a single reader: not written, so only the columns it reads are joined."""
        if self.links_only:
            raise ValueError("a run of links only has no columns of facts")
        return linked_facts(self.linked_calls, self.linked_outcomes, self.steps)

    @cached_property
    def facts(self) -> DataFrame:
        return materialise(self.fact_rows, "facts")

    @property
    def count_checks(self) -> DataFrame:
        """Row counts before and after the steps that must neither lose nor repeat rows."""
        facts = self._counted_facts
        return reduce(DataFrame.unionByName, [
            count_check("calls_linked", self.answered, self.linked_calls),
            count_check("outcomes_linked", self.cleaned, self.linked_outcomes),
            count_check("facts", self.linked_calls, facts),
            count_check("agent_login", in_scope(facts),
                        with_agent_login(in_scope(facts), self.active)),
        ])

    @property
    def _counted_facts(self) -> DataFrame:
        """All rows of the facts; only the columns that the checks read, if they are not written."""
        if "facts" in self.__dict__:
            return self.facts
        return materialise(self.fact_rows.select("call_dt", "anslogin", "isInScopeSkill"),
                           "counted-facts")

    @cached_property
    def stored_rows(self) -> DataFrame:
        return self._layout(self.facts)

    @property
    def layout_rows(self) -> DataFrame:
        """``stored_rows`` for a single reader: the facts are not written before."""
        return self._layout(self.fact_rows)

    def _layout(self, facts: DataFrame) -> DataFrame:
        return output_layout(facts, self.active, self.legs.columns, self.outcomes.columns,
                             list(self.params.audit_columns))
