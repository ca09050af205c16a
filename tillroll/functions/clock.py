"""Time on the London wall clock.

Every instant is kept twice, both as `timestamp_ntz`: the wall clock for dates, months and
windows, and UTC for elapsed seconds. Nothing here reads the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.params import LONDON, as_datetime

FAR_FUTURE = datetime(9999, 12, 31)


def moment(value: date | datetime) -> Column:
    """A wall-clock literal. (A Python datetime literal would pass through the session zone.)"""
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def to_utc(wall_clock: Column) -> Column:
    """Since 1996 summer time begins and ends on the last Sundays of March and October: worked out
    from the date, as looking up the zone for every row costs more than the rest of a line. Of the
    hour that comes twice the first is meant; the hour that is skipped is read as winter time."""
    # Both changes are at two o'clock by the clock of summer, so they fall on midnight here.
    shifted = wall_clock - F.make_dt_interval(F.lit(0), F.lit(2))
    month = F.month(shifted)
    last_sunday = F.dayofmonth(shifted) - F.dayofweek(shifted) >= 24
    summer = month.between(4, 9) | ((month == 3) & last_sunday) | ((month == 10) & ~last_sunday)
    by_rule = F.when(summer, wall_clock - F.make_dt_interval(F.lit(0), F.lit(1))).otherwise(wall_clock)
    by_zone = F.convert_timezone(F.lit(LONDON), F.lit("UTC"), wall_clock)
    return F.when(F.year(wall_clock).between(1996, 2200), by_rule).otherwise(by_zone)


def start_of_day(wall_clock: Column) -> Column:
    return F.to_date(wall_clock).cast("timestamp_ntz")


def month_of(wall_clock: Column) -> Column:
    return F.trunc(F.to_date(wall_clock), "MM")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(F.to_date(later), F.to_date(earlier))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed whole seconds of two zone-free timestamps. (timestampdiff would go through the
    session zone.)"""

    def of_day(ts: Column) -> Column:
        return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)

    days = days_between(later, earlier).cast("bigint")
    return days * 86400 + (of_day(later) - of_day(earlier))


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months between two first-of-month dates."""
    return (
        (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    ).cast("int")


def within(ts: Column, start: date | datetime, end: date | datetime) -> Column:
    """Half-open window: start <= ts < end."""
    return (ts >= moment(start)) & (ts < moment(end))
