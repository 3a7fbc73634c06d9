"""Date helpers. Timestamps are TIMESTAMP_NTZ; no time zone is ever applied."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_date(value) -> dt.date | None:
    if value is None or isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.datetime):
        return value.date()
    return dt.date.fromisoformat(str(value))


def in_day_range(ts, start=None, end=None, inclusive_end_day: bool = True) -> Column:
    """Filter a timestamp by calendar days [start, end].

    With ``inclusive_end_day`` (default) the whole end day counts, written as a half-open range on
    the raw column (``ts >= start AND ts < end + 1 day``) so parquet min/max pruning applies.
    With ``inclusive_end_day=False`` the comparison is ``ts BETWEEN start AND end`` against
    midnight, which drops sales after 00:00 on the end day, as the reference's monthly query does.
    """
    start, end = as_date(start), as_date(end)
    cond = F.lit(True)
    col = _c(ts)
    if start is not None:
        cond = cond & (col >= F.lit(dt.datetime.combine(start, dt.time())).cast("timestamp_ntz"))
    if end is not None:
        if inclusive_end_day:
            nxt = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
            cond = cond & (col < F.lit(nxt).cast("timestamp_ntz"))
        else:
            cond = cond & (col <= F.lit(dt.datetime.combine(end, dt.time())).cast("timestamp_ntz"))
    return cond


def date_between(d, start=None, end=None) -> Column:
    """Inclusive range on a DATE column; None bounds are open."""
    start, end = as_date(start), as_date(end)
    col = _c(d)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (col >= F.lit(start))
    if end is not None:
        cond = cond & (col <= F.lit(end))
    return cond


def month_start(ts) -> Column:
    """First day of the month as DATE."""
    return F.trunc(F.to_date(_c(ts)), "month")


def days_in_month(month_col) -> Column:
    return F.dayofmonth(F.last_day(_c(month_col))).cast("bigint")


def year_month(month_col) -> Column:
    return F.date_format(_c(month_col), "yyyy-MM")
