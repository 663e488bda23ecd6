"""Instants of named schedules, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOURLY, DAILY, WEEKLY, NEVER = "Hourly", "Daily", "Weekly", "Never"

#: Truncation unit and step of each named schedule; weeks start on Monday.
_UNITS = {HOURLY: ("hour", 3600), DAILY: ("day", 86_400), WEEKLY: ("week", 604_800)}


def schedule_name(name: str) -> str:
    """The canonical spelling of a schedule name, whatever its case."""
    for known in (*_UNITS, NEVER):
        if known.lower() == name.lower():
            return known
    raise ValueError(f"Schedule '{name}' is not supported")


def step_seconds(name: str) -> int | None:
    unit = _UNITS.get(schedule_name(name))
    return unit[1] if unit else None


def seconds(count: int | Column) -> Column:
    return F.make_dt_interval(secs=F.lit(count) if isinstance(count, int) else count)


def _floor(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts.cast("timestamp")).cast("timestamp_ntz")


def previous_instant(ts: Column, name: str) -> Column:
    """The last scheduled instant strictly before ``ts``; null for Never."""
    name = schedule_name(name)
    if name == NEVER:
        return F.lit(None).cast("timestamp_ntz")
    return _floor(ts - F.expr("INTERVAL '0.000001' SECOND"), _UNITS[name][0])


def next_instant(ts: Column, name: str) -> Column:
    """The first scheduled instant strictly after ``ts``; null for Never."""
    name = schedule_name(name)
    if name == NEVER:
        return F.lit(None).cast("timestamp_ntz")
    unit, step = _UNITS[name]
    return _floor(ts, unit) + seconds(step)


def by_name(schedule: Column, pick) -> Column:
    """Apply ``pick(name)`` row by row for a schedule column; null for Never or null, an error for others."""
    unknown = F.raise_error(F.concat(F.lit("Schedule '"), schedule, F.lit("' is not supported"))).cast("timestamp_ntz")
    none = schedule.isNull() | (F.lower(schedule) == NEVER.lower())
    choice = F.when(none, F.lit(None).cast("timestamp_ntz")).otherwise(unknown)
    for name in _UNITS:
        choice = F.when(F.lower(schedule) == name.lower(), pick(name)).otherwise(choice)
    return choice


def as_of_time(use_current_time: Column, schedule: Column, scheduled: Column, now: Column) -> Column:
    """Now when asked for or never scheduled, else the scheduled instant."""
    current = use_current_time | (F.lower(schedule) == NEVER.lower())
    return F.when(current, now).otherwise(scheduled)
