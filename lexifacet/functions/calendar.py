"""Integer calendar keys of timestamps and time segments relative to a moment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CALENDAR_UNITS = ("day", "week", "month", "year")

# Upper age bound in seconds -> segment, newest first; older is 0.
TIME_SEGMENTS = ((3600, 5), (86400, 4), (7 * 86400, 3), (30 * 86400, 2), (90 * 86400, 1))


def calendar_key(ts: Column, unit: str) -> Column:
    """yyyymmdd of the day or of the week's Monday, yyyymm, or yyyy."""
    if unit == "year":
        return F.year(ts)
    if unit == "month":
        return F.year(ts) * 100 + F.month(ts)
    day = F.date_trunc("week", ts) if unit == "week" else ts
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def time_segment(ts: Column, now: Column) -> Column:
    age = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(ts.cast("timestamp"))
    out = None
    for bound, segment in TIME_SEGMENTS:
        test = age <= bound
        out = F.when(test, segment) if out is None else out.when(test, segment)
    return out.otherwise(0)
