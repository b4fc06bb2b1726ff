"""Job parameters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from callweave.plans import fixed_values as fixed


@dataclass(frozen=True)
class RunWindow:
    """Half-open run window."""

    start: dt.datetime
    end: dt.datetime

    @classmethod
    def of(cls, start=None, end=None, as_of: dt.date | None = None) -> RunWindow:
        """Defaults: from the first day of yesterday's month to today."""
        today = as_of or dt.date.today()
        yesterday = today - dt.timedelta(days=1)
        return cls(_moment(start or yesterday.replace(day=1)), _moment(end or today))

    @classmethod
    def next_day(cls, newest: dt.date, as_of: dt.date | None = None) -> RunWindow:
        """From the day of the newest stored row (the high-water mark) to today."""
        return cls(_moment(newest), _moment(as_of or dt.date.today()))

    def require_one_day(self) -> RunWindow:
        if self.end - self.start != dt.timedelta(days=1):
            raise ValueError("this job runs on exactly one day")
        return self

    @property
    def bounds(self) -> tuple[dt.date, dt.date]:
        return self.start.date(), self.end.date()


def _moment(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


@dataclass(frozen=True)
class DialerParams:
    """Dialer and router jobs. Engine, program and shutdown texts name a deployment."""

    window: RunWindow
    engine_id: str
    program_id: str
    shutdown_reason: str  # LIKE pattern of router rows written while the router was down
    dialer_tag: str = "DIALER"
    other_tag: str = "OTHER"
    callback_type: str = fixed.CALLBACK_TYPE
    sale_status: str = fixed.SALE_STATUS
    ignore_case: bool = False
    filler: str | None = "NA"
    literal_update: bool = False


@dataclass(frozen=True)
class RetentionParams:
    """Call-to-outcome linkage job."""

    window: RunWindow
    skills: Mapping[str, Sequence[int]] = field(default_factory=lambda: {
        "retention_external": fixed.RETENTION_EXTERNAL,
        "retention_transfer": fixed.RETENTION_TRANSFER,
        "retention_internal": fixed.RETENTION_INTERNAL,
    })
    site_name: str = fixed.SITE_NAME
    sites: Sequence[str] = tuple(fixed.SITES)
    threat_codes: Sequence[str] = tuple(fixed.THREAT_CODES)
    last_birth_year: int = fixed.LAST_BIRTH_YEAR
    call_id: str | None = None  # unique call column; without it a content id is made
    outcome_id: str | None = None
    union_looked_up: bool = True  # contracts found by phone also count as calling
    many_days: bool = False  # the daily job runs on exactly one day unless this is set
    audit_columns: Sequence[str] = ("Filename", "CreatedDate", "UpdatedDate")

    @property
    def in_scope(self) -> list[int]:
        return [code for codes in self.skills.values() for code in codes]
