"""Deduplication to a grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def newest(df: DataFrame, grain: list[str], order: list[Column]) -> DataFrame:
    """The first row of each grain under a total order: ``order`` breaks all ties, so a reshuffle can't change it."""
    w = Window.partitionBy(*grain).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def dedupe_grain(config: dict) -> list[str]:
    """Merge keys; a change feed also keeps one row for each instant of a key."""
    keys = [k.strip() for k in config["merge_keys"].split(",")]
    cdc = config["scd_type"] == 2 and config["load_type"] != "full_snapshot"
    return [*keys, config["effective_from_column"]] if cdc else keys
