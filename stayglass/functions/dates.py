"""Stay dates: durations, weekend overlap, calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stay_nights(checkin: Column, checkout: Column) -> Column:
    return F.datediff(checkout, checkin).cast("bigint")


def lead_days(checkin: Column, snapshot: Column) -> Column:
    """Days from snapshot to check-in, never below 0; null stays null."""
    days = F.datediff(checkin, snapshot)
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0))).cast("bigint")


def weekend_overlap(checkin: Column, checkout: Column) -> Column:
    """Does the closed range hold a Saturday or Sunday? Null or reversed ranges do not.

    The first weekend day on or after check-in is at most ``5 - weekday`` days away, so no day
    has to be enumerated.
    """
    gap = F.datediff(checkout, checkin)
    hit = (gap >= 0) & ((F.weekday(checkin) >= 5) | (gap >= F.lit(5) - F.weekday(checkin)))
    return F.coalesce(hit, F.lit(False))


def calendar_parts(day: Column) -> dict[str, Column]:
    """ISO week, month, day of week (Monday 0) and quarter."""
    return {
        "week_of_year": F.weekofyear(day).cast("bigint"),
        "checkin_month": F.month(day).cast("bigint"),
        "checkin_day_of_week": F.weekday(day).cast("bigint"),
        "checkin_quarter": F.quarter(day).cast("bigint"),
    }


def month_bounds(day: Column) -> dict[str, Column]:
    first = F.trunc(day, "MM")
    last = F.last_day(day)
    return {
        "month_start": first,
        "month_end": last,
        "days_in_month": F.dayofmonth(last).cast("bigint"),
    }


def days_between(start: Column, end: Column) -> Column:
    """Array of the days of the half-open range ``[start, end)``; null when it holds none."""
    return F.when(end > start, F.sequence(start, F.date_sub(end, 1)))


def days_within(start: Column, end: Column, bounds: Column) -> Column:
    """``days_between`` cut to the closed range (lo, hi) of ``bounds``; null bounds leave no day.

    A far-off end, such as 9999-12-31, then lists no more days than the other side has.
    """
    cut = days_between(F.greatest(start, bounds["lo"]), F.least(end, F.date_add(bounds["hi"], 1)))
    return F.when(start.isNotNull() & end.isNotNull() & bounds["lo"].isNotNull(), cut)
