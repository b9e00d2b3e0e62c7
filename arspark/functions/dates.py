"""Date/time rules of the warehouse SQL expressed with built-in Spark functions.

All helpers return JVM-side Column expressions (no Python UDF), so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Textual "no date" markers written by the source system.
ZERO_DATE_MARKERS = ["0000-00-00 00:00:00", "0000-00-00", ""]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_between(start, end) -> Column:
    """DATEDIFF(day, start, end): whole calendar days from start to end."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("bigint")


def months_between_boundaries(start, end) -> Column:
    """DATEDIFF(month, start, end) counts month boundaries crossed, not whole
    months elapsed (Jan 31 -> Feb 1 is 1)."""
    s, e = _c(start), _c(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("bigint")


def hours_between(start, end) -> Column:
    """DATEDIFF(hour, ...) counts hour boundaries: truncate both, then diff."""
    return F.timestamp_diff("HOUR", F.date_trunc("hour", _c(start)), F.date_trunc("hour", _c(end)))


def minutes_between(start, end) -> Column:
    """DATEDIFF(minute, ...) counts minute boundaries."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", _c(start)), F.date_trunc("minute", _c(end)))


def month_start(d) -> Column:
    """DATE_TRUNC('month', d) keeping a DATE result."""
    return F.trunc(F.to_date(_c(d)), "month")


def month_end(d) -> Column:
    """LAST_DAY(d) (also ADD_MONTHS(month_start, 1) - 1 day)."""
    return F.last_day(F.to_date(_c(d)))


def day_of_week0(d) -> Column:
    """DAYOFWEEK with 0 = Sunday."""
    return F.dayofweek(_c(d)) - 1


def clean_ts(s) -> Column:
    """Text timestamp -> TIMESTAMP_NTZ; zero markers and unparsable text -> NULL."""
    s = _c(s).cast("string")
    return F.when(s.isin(ZERO_DATE_MARKERS), F.lit(None).cast("timestamp_ntz")) \
        .otherwise(s.try_cast("timestamp_ntz"))


def clean_date(s) -> Column:
    """Text date -> DATE; zero markers and unparsable text -> NULL."""
    s = _c(s).cast("string")
    return F.when(s.isin(ZERO_DATE_MARKERS), F.lit(None).cast("date")) \
        .otherwise(F.to_date(s.try_cast("timestamp_ntz")))


def clean_time_of_day(s) -> Column:
    """TIME(ts) as 'HH:mm:ss' text; empty/zero/unparsable -> NULL."""
    ts = clean_ts(s)
    return F.when(ts.isNull(), F.lit(None).cast("string")).otherwise(F.date_format(ts, "HH:mm:ss"))


def utc_to_local(ts, tz: str = "America/Los_Angeles") -> Column:
    """Shift a zone-less UTC timestamp to local wall-clock time (the change
    windows are expressed in Pacific time)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts))
