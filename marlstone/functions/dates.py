"""Calendar arithmetic on dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The open end of intervals. The timestamp stays inside plans: pandas can't hold it.
OPEN_TS = dt.datetime(9999, 12, 31, 23, 59, 59)
OPEN_DATE = dt.date(9999, 12, 31)


def open_ts() -> Column:
    return F.lit("9999-12-31 23:59:59").cast("timestamp")


def open_date() -> Column:
    return F.lit("9999-12-31").cast("date")


def date_key(d: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def monday_dow(d: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return (F.weekday(d) + 1).cast("int")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_end(d: Column) -> Column:
    return F.last_day(d)


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def carried(rate_date: Column, on: Column) -> Column:
    """Whether a rate is older than the day it is used on; null without a rate."""
    return F.when(rate_date.isNotNull(), rate_date < on)
