"""Date helpers with the reference's calendar semantics."""

from __future__ import annotations

import calendar
import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def stat_date(ts: Column) -> Column:
    """``yyyyMMdd`` as bigint."""
    return F.date_format(ts, "yyyyMMdd").cast("bigint")


def parse_yyyymmdd(c: Column) -> Column:
    return F.to_date(c.cast("string"), "yyyyMMdd")


def offset_date(d: Column, months: int = 0, days: int = 0) -> Column:
    """Lenient calendar offset: set month += m, then day-of-month += k, letting
    the day overflow into the next month (2019-03-31 -1 month -> 2019-03-03).
    ``add_months`` alone would clamp to 02-28."""
    first = F.add_months(F.trunc(d, "MM"), months)
    return F.date_add(first, F.dayofmonth(d) - 1 + days)


def offset_date_py(day: _dt.date, months: int = 0, days: int = 0) -> _dt.date:
    """Driver-side twin of :func:`offset_date` for literal job dates."""
    m0 = day.year * 12 + (day.month - 1) + months
    first = _dt.date(m0 // 12, m0 % 12 + 1, 1)
    return first + _dt.timedelta(days=day.day - 1 + days)


def weekday_mon1(ts: Column) -> Column:
    """Day of week with Monday = 1 .. Sunday = 7."""
    return (F.weekday(ts) + 1).cast("bigint")


def valid_posttime(s: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` strings of exactly 19 characters that parse."""
    return (F.length(s) == 19) & F.try_to_timestamp(F.regexp_replace(s, "T", " "),
                                                      F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()


def parse_posttime(s: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(s, "T", " "), F.lit("yyyy-MM-dd HH:mm:ss"))


__all__ = ["stat_date", "parse_yyyymmdd", "offset_date", "offset_date_py", "weekday_mon1",
           "valid_posttime", "parse_posttime", "calendar"]
