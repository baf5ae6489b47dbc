"""Date arithmetic on naive timestamps, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours_between(start: Column, end: Column) -> Column:
    """Hour boundaries crossed from start to end: 00:59 to 01:01 is one."""
    days = F.datediff(F.to_date(end), F.to_date(start))
    return (days * 24 + F.hour(end) - F.hour(start)).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end."""
    return hours_between(start, end) * 60 + F.minute(end) - F.minute(start)


def as_instant(naive: Column) -> Column:
    """The naive time read as UTC, for what needs an instant (watermarks), whatever the session's zone."""
    parts = [F.year(naive), F.month(naive), F.day(naive), F.hour(naive), F.minute(naive)]
    return F.make_timestamp(*parts, F.extract(F.lit("SECOND"), naive), F.lit("UTC"))


def calendar_parts(day: Column) -> dict[str, Column]:
    """The attributes of a calendar day. Days of the week count from 0 on Sunday, weeks start on Monday."""
    day_of_week = F.dayofweek(day) - 1
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_start": F.trunc(day, "month"),
        "week_start": F.trunc(day, "week"),
        "day_of_week": day_of_week,
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": day_of_week.isin(0, 6),
    }
