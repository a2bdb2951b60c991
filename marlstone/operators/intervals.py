"""Intervals from dated facts: rates that hold until the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import open_date


def closed_intervals(df: DataFrame, keys: list[str], date: str, start: str = "valid_from_date", end: str = "valid_to_date") -> DataFrame:
    """Each row holds from its date to the day before the key's next date; the last one is open."""
    nxt = F.lead(date).over(Window.partitionBy(*keys).orderBy(date))
    return df.withColumn(start, F.col(date)).withColumn(end, F.coalesce(F.date_sub(nxt, 1), open_date()))


def chain_audit(versions: DataFrame, keys: list[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Counts of gaps, overlaps and empty intervals over all keys' chains."""
    nxt = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    c = versions.withColumn("__next", nxt)
    count = lambda p: F.count_if(p).cast("bigint")
    return c.agg(
        F.count(F.lit(1)).cast("bigint").alias("versions"), count(F.col("__next") > F.col(end)).alias("gaps"), count(F.col("__next") < F.col(end)).alias("overlaps"),
        count(F.col(start) >= F.col(end)).alias("empty_intervals"),
    )
