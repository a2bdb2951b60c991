"""Fact-to-dimension joins. All are equi-joins with the range as a residual, so they stay hash or sort-merge joins.

Rows whose key is null can't match: with ``split_null`` they take no part in the shuffle and don't pile up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = -1


def _on(pairs: dict[str, str]) -> Column:
    out = None
    for left, right in pairs.items():
        c = F.col(f"f.{left}") == F.col(f"d.{right}")
        out = c if out is None else out & c
    return out


def _take(take: dict[str, str], defaults: dict[str, object] | None) -> list[Column]:
    return [(F.coalesce(F.col(f"d.{c}"), F.lit((defaults or {})[n])) if n in (defaults or {}) else F.col(f"d.{c}")).alias(n) for n, c in take.items()]


def _joined(fact: DataFrame, dim: DataFrame, on: Column, take, defaults, keys, split_null: bool) -> DataFrame:
    out = ["f.*", *_take(take, defaults)]
    if not split_null:
        return fact.alias("f").join(dim.alias("d"), on, "left").select(*out)
    known = None
    for k in keys:
        known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
    hit = fact.filter(known).alias("f").join(dim.alias("d"), on, "left").select(*out)
    types = {n: dim.schema[c].dataType for n, c in take.items()}
    miss = fact.filter(~known).select("*", *[F.lit((defaults or {}).get(n)).cast(t).alias(n) for n, t in types.items()])
    return hit.unionByName(miss)


def lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str], defaults: dict | None = None, split_null: bool = False) -> DataFrame:
    """Left equi-lookup. ``take`` maps new names to dimension columns; ``defaults`` fill what isn't found."""
    return _joined(fact, dim, _on(on), take, defaults, on, split_null)


def pit_lookup(
    fact: DataFrame, dim: DataFrame, on: dict[str, str], at: str, take: dict[str, str], defaults: dict | None = None,
    start: str = "valid_from", end: str = "valid_to", split_null: bool = False,
) -> DataFrame:
    """Point in time: the version whose half-open interval [start, end) holds ``at``. Ends are never null."""
    within = (F.col(f"f.{at}") >= F.col(f"d.{start}")) & (F.col(f"f.{at}") < F.col(f"d.{end}"))
    return _joined(fact, dim, _on(on) & within, take, defaults, on, split_null)


def chained_lookup(fact: DataFrame, first: DataFrame, on: dict[str, str], via: str, second: DataFrame, key: str, at: str, take_first: dict[str, str], take: dict[str, str], defaults: dict | None = None) -> DataFrame:
    """Two points in time: ``first`` gives the then-current ``via``, whose then-current version in ``second`` is taken."""
    mid = pit_lookup(fact, first, on, at, {**take_first, "__via": via}, defaults)
    return pit_lookup(mid, second, {"__via": key}, at, take, defaults, split_null=True).drop("__via")


def date_interval_lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str], at: str, take: dict[str, str], defaults: dict | None = None, start: str = "valid_from_date", end: str = "valid_to_date") -> DataFrame:
    """Closed date intervals: start <= day of ``at`` <= end."""
    day = F.col(f"f.{at}").cast("date")
    return _joined(fact, dim, _on(on) & day.between(F.col(f"d.{start}"), F.col(f"d.{end}")), take, defaults, on, False)


def daily_lookup(fact: DataFrame, dim: DataFrame, on: dict[str, str], at: str, take: dict[str, str], defaults: dict | None = None, start: str = "valid_from_date", end: str = "valid_to_date") -> DataFrame:
    """As date_interval_lookup, with the intervals carried forward to days: an equi-join on key and day, so that a fact is
    compared with one row and not with every interval of its key. Open intervals are carried to the last start or closed end;
    a later day counts as that one. For dense intervals, such as rates."""
    closed = F.when(F.col(end) < F.lit("9999-12-31").cast("date"), F.col(end))
    last = dim.agg(F.greatest(F.max(start), F.max(closed)).alias("last")).first()["last"]  # one row of a small dimension
    if last is None:
        return date_interval_lookup(fact, dim, on, at, take, defaults, start, end)
    days = dim.withColumn("__day", F.explode(F.sequence(F.col(start), F.least(F.col(end), F.lit(last)))))
    keyed = fact.withColumn("__day", F.least(F.col(at).cast("date"), F.lit(last)))
    return _joined(keyed, days, _on({**on, "__day": "__day"}), take, defaults, on, False).drop("__day")


def checked_date_key(fact: DataFrame, dim_date: DataFrame, at: str, name: str) -> DataFrame:
    """A date key computed from ``at`` and kept only if the calendar has it; else the unknown member."""
    from ..functions.dates import date_key

    days = F.broadcast(dim_date.select(F.col("date_sk").alias("__sk")))
    keyed = fact.withColumn("__key", date_key(F.col(at)))
    return keyed.join(days, F.col("__key") == F.col("__sk"), "left").withColumn(name, F.coalesce("__sk", F.lit(UNKNOWN))).drop("__key", "__sk")


def not_in(df: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows without a partner: NOT EXISTS, so a null key is kept."""
    return df.alias("f").join(other.select(*{*on.values()}).alias("d"), _on(on), "left_anti")


def only_in(df: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows with a partner."""
    return df.alias("f").join(other.select(*{*on.values()}).alias("d"), _on(on), "left_semi")


def exists_flag(df: DataFrame, ref: DataFrame, column: str, ref_column: str, name: str) -> DataFrame:
    """Adds whether ``column`` occurs in the reference. The reference is made distinct, so no row is repeated; Spark
    broadcasts it when its measured size allows."""
    known = ref.select(F.col(ref_column).alias("__ref")).distinct()
    return df.join(known, F.col(column) == F.col("__ref"), "left").withColumn(name, F.col("__ref").isNotNull()).drop("__ref")


def unknown_causes(fact: DataFrame, dim: DataFrame, key: str, at: str, dim_key: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Each fact row with the reason why its point-in-time lookup finds nothing: null key, absent key, before the first
    version, a hole in the chain; 'resolved' if it finds one."""
    first = dim.groupBy(F.col(dim_key).alias("__k")).agg(F.min(start).alias("__first"))
    hit = pit_lookup(fact, dim.withColumn("__one", F.lit(1)), {key: dim_key}, at, {"__hit": "__one"}, start=start, end=end)
    out = hit.join(first, F.col(key) == F.col("__k"), "left")
    cause = (
        F.when(F.col("__hit").isNotNull(), "resolved").when(F.col(key).isNull(), "null_key").when(F.col("__first").isNull(), "absent_key")
        .when(F.col(at) < F.col("__first"), "before_first_version").otherwise("hole_in_chain")
    )
    return out.withColumn("cause", cause).drop("__hit", "__k", "__first")
