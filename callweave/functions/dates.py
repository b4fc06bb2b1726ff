"""Date and time expressions on zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def midnight(day: Column) -> Column:
    """Zone-free midnight of a day (``date_trunc`` would give a zoned timestamp)."""
    return day.cast("date").cast("timestamp_ntz")


def add_seconds(ts: Column, seconds) -> Column:
    n = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n)


def seconds_between(a: Column, b: Column) -> Column:
    """Whole seconds from ``a`` to ``b``, negative when ``b`` is earlier; no upper limit."""
    return (b - a).cast("interval second").cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-free timestamp, the same in every session zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def first_of_month(day: Column) -> Column:
    return F.trunc(day, "MM")


def first_of_next_month(day: Column) -> Column:
    return F.date_add(F.last_day(day), 1)


def ceil_day(ts: Column) -> Column:
    """Next midnight; an exact midnight stays as it is."""
    here = midnight(F.to_date(ts))
    return F.when(ts == here, ts).otherwise(midnight(F.date_add(F.to_date(ts), 1)))


def parse_day(text: Column) -> Column:
    """Date from text, NULL for bad input."""
    return text.try_cast("date")


def parse_timestamp(text: Column) -> Column:
    """Zone-free timestamp from text, NULL for bad input."""
    return text.try_cast("timestamp_ntz")
