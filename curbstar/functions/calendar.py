"""Date and time columns: keys, attributes and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbstar import fixed_values as fv


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_start(ts: Column | str) -> Column:
    """Start of the hour; unlike ``date_trunc``, without a detour through the session zone."""
    return F.timestamp_add("HOUR", F.hour(ts), F.to_date(ts).cast("timestamp_ntz"))


def hour_key(ts: Column | str) -> Column:
    """Integer YYYYMMDDHH of a timestamp."""
    day = F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
    return day.cast("bigint") * 100 + F.hour(ts)


def day_name(ts: Column | str) -> Column:
    return F.date_format(ts, "EEEE")


def month_name(ts: Column | str) -> Column:
    return F.date_format(ts, "MMMM")


def is_weekend(ts: Column | str) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def weekday_or_weekend(ts: Column | str) -> Column:
    return F.when(is_weekend(ts), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def peak_period(ts: Column | str) -> Column:
    hour, result = F.hour(ts), F
    for first, last, label in fv.PEAK_PERIODS:
        result = result.when(hour.between(first, last), F.lit(label))
    return result.otherwise(F.lit(fv.OFF_PEAK))


def fiscal_year(day: Column | str, start_month: int = fv.FISCAL_START_MONTH) -> Column:
    """Year in which the fiscal year that starts in ``start_month`` ends."""
    return (F.year(day) + (F.month(day) >= start_month).cast("int")).cast("bigint")


def month_start(ts: Column | str) -> Column:
    return F.trunc(F.to_date(ts), "MONTH")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from start to end, truncated toward zero; negative when end comes first.

    Taken from the interval between them: ``timestamp_diff`` would go through the session zone.
    """
    lasted = _column(end) - _column(start)
    days, hours, minutes = (F.extract(F.lit(part), lasted) for part in ("DAY", "HOUR", "MINUTE"))
    return days.cast("bigint") * 1440 + hours.cast("bigint") * 60 + minutes.cast("bigint")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end; NULL while there is no end."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
