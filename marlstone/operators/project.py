"""Projections: business and payload columns, renames, audit columns, window filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_hash

# Columns that describe arrival, not the entity.
AUDIT = ("_source_file", "_batch_id", "_ingest_ts", "_row_hash")


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns that are there."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def business_columns(df: DataFrame, partition_column: str | None = "ingest_date") -> list[str]:
    """Sorted columns that carry business: neither technical (leading underscore) nor the partition."""
    return sorted(c for c in df.columns if not c.startswith("_") and c != partition_column)


def payload_columns(df: DataFrame, effective: str | None = None, op: str | None = None, partition_column: str = "ingest_date") -> list[str]:
    """Columns a dimension keeps: no audit columns, no ordering column, no operation."""
    drop = {*AUDIT, partition_column, effective, op}
    return [c for c in df.columns if c not in drop]


def add_audit_columns(df: DataFrame, batch_id: str, partition_column: str = "ingest_date", source: bool = True) -> DataFrame:
    """Source file, batch, arrival time and a hash of the business columns."""
    business = business_columns(df, partition_column)
    if not business:
        raise ValueError("no business columns: the feed is empty or misread")
    origin = F.col("_metadata.file_path") if source else F.lit(None).cast("string")
    return df.select(
        "*", origin.alias("_source_file"), F.lit(batch_id).alias("_batch_id"), F.current_timestamp().alias("_ingest_ts"), row_hash(business).alias("_row_hash")
    )


def in_window(df: DataFrame, partitions: list[str], column: str = "ingest_date") -> DataFrame:
    """Rows of the named arrival dates; compared as dates so that partitions are pruned."""
    return df.filter(F.col(column).isin([F.lit(p).cast("date") for p in partitions]))
