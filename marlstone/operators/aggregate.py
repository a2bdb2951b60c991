"""Aggregates over facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_of_grains(left: DataFrame, right: DataFrame, keys: list[str], left_aggs: dict[str, Column], right_aggs: dict[str, Column]) -> DataFrame:
    """Both facts summed to the same grain; a grain that only one of them has counts zero for the other.

    One full outer join of two already aggregated sides, which is what the union of the grains with two left joins says.
    """
    a = left.groupBy(*keys).agg(*[c.alias(n) for n, c in left_aggs.items()])
    b = right.groupBy(*keys).agg(*[c.alias(n) for n, c in right_aggs.items()])
    out = a.join(b, keys, "full_outer")
    return out.select(*keys, *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in [*left_aggs, *right_aggs]])


def top_k(df: DataFrame, by: str, k: int, tie: list[str]) -> DataFrame:
    """The k rows with the largest value, ties by the columns named."""
    return df.orderBy(F.col(by).desc(), *tie).limit(k)


def version_counter(flag: Column, partition: list[str], order: list[str]) -> Column:
    """How many flagged rows there were up to this one."""
    from pyspark.sql.window import Window

    return F.sum(flag.cast("bigint")).over(Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
