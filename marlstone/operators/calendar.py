"""The date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, day_name, month_end, month_start, monday_dow

#: Days a calendar may span; a longer one is a sign of a wrong date in the data.
MOST_DAYS = 9999


def dim_date(spark: SparkSession, first: str | dt.date, last: str | dt.date, unknown: bool = True) -> DataFrame:
    """One row for each day from first to last, and the unknown member -1 dated 1900-01-01."""
    first, last = (x if isinstance(x, dt.date) else dt.date.fromisoformat(x) for x in (first, last))
    if not 0 <= (last - first).days <= MOST_DAYS:
        raise ValueError(f"a calendar from {first} to {last} is not supported")
    d = F.col("full_date")
    days = spark.sql(f"SELECT explode(sequence(date'{first}', date'{last}', interval 1 day)) AS full_date")
    if unknown:
        days = spark.sql("SELECT date'1900-01-01' AS full_date, true AS u").unionByName(days.withColumn("u", F.lit(False)))
    else:
        days = days.withColumn("u", F.lit(False))
    u = F.col("u")
    known = lambda c: F.when(u, "Unknown").otherwise(c)
    return days.select(
        F.when(u, -1).otherwise(date_key(d)).cast("int").alias("date_sk"), d, F.dayofmonth(d).alias("day_of_month"), monday_dow(d).alias("day_of_week"),
        known(day_name(d)).alias("day_name"), F.dayofyear(d).alias("day_of_year"), F.weekofyear(d).alias("iso_week"), F.month(d).alias("month_number"),
        known(F.date_format(d, "MMMM")).alias("month_name"), month_start(d).alias("month_start_date"), month_end(d).alias("month_end_date"),
        F.quarter(d).alias("quarter_number"), F.year(d).alias("year_number"), known(F.date_format(d, "yyyy-MM")).alias("year_month"),
        (F.when(u, False).otherwise(monday_dow(d) >= 6)).alias("is_weekend"), (F.when(u, False).otherwise(d == month_end(d))).alias("is_month_end"),
    )


def date_range(frames: list[tuple[DataFrame, str]]) -> tuple[dt.date, dt.date]:
    """Whole years that hold every date of the columns named, from one aggregate over each frame."""
    lows, highs = [], []
    for df, c in frames:
        r = df.agg(F.min(F.col(c).cast("date")).alias("a"), F.max(F.col(c).cast("date")).alias("b")).first()
        lows += [r["a"]] if r["a"] else []
        highs += [r["b"]] if r["b"] else []
    if not lows:
        raise ValueError("no dates to span")
    return dt.date(min(lows).year, 1, 1), dt.date(max(highs).year, 12, 31)
