"""Row-level security and column masks as frames and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL_REGIONS = "*"


def region_filter(df: DataFrame, access: DataFrame, region: str = "region", principal: str | Column | None = None) -> DataFrame:
    """Rows whose region the principal (the session's user, unless named) may see. A semi-join: no row repeats."""
    who = F.current_user() if principal is None else F.lit(principal) if isinstance(principal, str) else principal
    mine = access.filter(F.col("principal_name") == who)
    some = df.join(mine.select(F.col("region").alias("__r")), F.col(region) == F.col("__r"), "left_semi")
    everything = mine.filter(F.col("region") == ALL_REGIONS).limit(1).select(F.lit(1).alias("__all"))
    # With '*' all rows pass; without it this side is empty, and the other gives the answer.
    full = df.join(F.broadcast(everything), F.lit(True), "left_semi")
    rest = some.join(F.broadcast(everything), F.lit(True), "left_anti")
    return full.unionByName(rest)


def masked(df: DataFrame, masks: dict[str, Column]) -> DataFrame:
    """The frame with masked columns in place."""
    return df.select(*[masks[c].alias(c) if c in masks else F.col(f"`{c}`") for c in df.columns])


def secure_view(df: DataFrame, name: str, access: DataFrame | None = None, masks: dict[str, Column] | None = None, region: str = "region") -> None:
    """A temporary view that shows only what it should."""
    out = masked(df, masks or {})
    (region_filter(out, access, region) if access is not None else out).createOrReplaceTempView(name)
