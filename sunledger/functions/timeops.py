"""Instants, wall clocks and calendar parts.

`ts_utc` columns are instants in a session pinned to UTC; `ts_local` columns are TIMESTAMP_NTZ wall clocks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunledger.settings import SUMMER_MONTHS, WINTER_MONTHS, ZONE

HOUR = "INTERVAL 1 HOUR"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_to_local(ts: Column | str, zone: str = ZONE) -> Column:
    """Wall time in `zone` of an instant.

    `from_utc_timestamp` resolves a literal zone once per task, `convert_timezone` once per row (several times
    slower); the cast back to a wall clock relies on the session zone being UTC.
    """
    return F.from_utc_timestamp(col(ts).cast("timestamp"), zone).cast("timestamp_ntz")


def localize_wall_clock(local: Column | str, zone: str = ZONE) -> Column:
    """Instant of a naive wall clock: a skipped time moves to the first valid instant, a repeated one is
    read as standard time. Assumes one-hour shifts that start on a full UTC hour, as in Europe."""
    wall = col(local).cast("timestamp")
    first = F.to_utc_timestamp(wall, zone)
    second = first + F.expr(HOUR)
    shown = F.from_utc_timestamp(first, zone)
    shown_later = F.from_utc_timestamp(second, zone)
    return F.when(shown != wall, F.date_trunc("hour", first)).when(shown_later == wall, second).otherwise(first)


def floor_hour(ts: Column | str) -> Column:
    return F.date_trunc("hour", col(ts))


def hour_of_day(ts_local: Column | str) -> Column:
    return F.hour(col(ts_local))


def day_of_year(ts_local: Column | str) -> Column:
    return F.dayofyear(col(ts_local))


def day_of_week(ts_local: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(col(ts_local)) - F.lit(1)


def is_weekend(dow: Column | str) -> Column:
    return col(dow).isin(0, 6)


def local_date(ts_local: Column | str) -> Column:
    return F.to_date(col(ts_local))


def month_start(day: Column | str) -> Column:
    return F.trunc(col(day), "MM")


def month_index(ts: Column | str) -> Column:
    """Months since year 0, so that month arithmetic is integer arithmetic."""
    return F.year(col(ts)) * F.lit(12) + F.month(col(ts))


def in_hours(hour: Column | str, band: tuple[int, int]) -> Column:
    """True within the inclusive hour band."""
    return col(hour).between(F.lit(band[0]), F.lit(band[1]))


def season(ts_local: Column | str) -> Column:
    """'winter', 'summer', or NULL between them."""
    month = F.month(col(ts_local))
    return F.when(month.isin(*WINTER_MONTHS), F.lit("winter")).when(month.isin(*SUMMER_MONTHS), F.lit("summer"))
