"""The dialer job: follow-up attribution, router match, combined fact, sensor."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from callweave.operators.metrics import unmatched_by_day
from callweave.plans.combined import combined_fact
from callweave.plans.followup import followup
from callweave.plans.params import DialerParams
from callweave.plans.router import router_match
from callweave.plans.sensors import SENSOR_KEY, time_gap_sensor
from callweave.session import materialise
from callweave.sources.sinks import read_slices, replace_slice, upsert


@dataclass
class Dialer:
    """Source tables in, matched and combined facts out. A stage is built when it is first
    asked for; stages that are read more than once are written once to the shared folder."""

    calls: DataFrame
    router: DataFrame
    other: DataFrame
    agents: DataFrame
    params: DialerParams

    @cached_property
    def attributed(self) -> DataFrame:
        return materialise(followup(self.calls, self.params), "attributed-calls")

    @cached_property
    def matched(self) -> DataFrame:
        return materialise(router_match(self.attributed, self.router, self.params), "matched")

    @cached_property
    def combined(self) -> DataFrame:
        return combined_fact(self.matched, self.other, self.router, self.agents, self.params)

    @property
    def unmatched_agents(self) -> DataFrame:
        """Combined rows without agent id per day."""
        return unmatched_by_day(self.combined, "START_TS", "short_cpf_combined")

    def store(self, matched_path: str, combined_path: str, sensor_path: str) -> None:
        """Replace the window in both fact tables, then upsert the sensor of the stored fact."""
        start, end = self.params.window.start, self.params.window.end
        replace_slice(self.matched, matched_path, "dt_chamada", start, end)
        replace_slice(self.combined, combined_path, "START_TS", start, end)
        stored = read_slices(self.combined.sparkSession, combined_path, start, end)
        upsert(time_gap_sensor(stored, self.router, self.params), sensor_path, SENSOR_KEY,
               "Sensors_Date")
