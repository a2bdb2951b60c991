"""Row-level changes as joins: each function gives the table after the change; the store commits it in one piece."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    pass


def assert_unique(df: DataFrame, keys: list[str], what: str = "source") -> None:
    """A merge whose source repeats a key has no answer; a join would quietly give two."""
    bad = df.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if bad:
        raise DuplicateKeys(f"{what} repeats keys, such as {[tuple(r)[:-1] for r in bad]}")


def upsert_if_changed(target: DataFrame, source: DataFrame, keys: list[str], hash_column: str = "_row_hash", action: str | None = None) -> DataFrame:
    """Insert new keys, update keys whose hash differs, keep the rest. With ``action`` a column says which it was."""
    t, s = target.alias("t"), source.alias("s")
    on = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        on = c if on is None else on & c
    there, new = F.col(f"t.{keys[0]}").isNotNull(), F.col(f"s.{keys[0]}").isNotNull()
    changed = ~F.col(f"t.{hash_column}").eqNullSafe(F.col(f"s.{hash_column}"))
    take = new & (~there | changed)
    names = target.columns
    columns = [F.when(take, F.col(f"s.{c}") if c in source.columns else F.lit(None)).otherwise(F.col(f"t.{c}")).alias(c) for c in names]
    if action:
        columns.append(F.when(new & ~there, "inserted").when(take, "updated").otherwise("unchanged").alias(action))
    return t.join(s, on, "full_outer").select(*columns)


def replace_by_key(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Delete the source's keys, then insert its rows."""
    other = source.select(*[F.col(k).alias(f"__k_{k}") for k in keys]).distinct()
    return target.join(other, [F.col(k) == F.col(f"__k_{k}") for k in keys], "left_anti").unionByName(source)


def rebuild_groups(target: DataFrame, rebuilt: DataFrame, affected: DataFrame, column: str) -> DataFrame:
    """Replace all rows of the affected groups by the rebuilt ones."""
    gone = affected.select(F.col(column).alias("__g")).distinct()
    return target.join(gone, F.col(column) == F.col("__g"), "left_anti").unionByName(rebuilt)


def resync(target: DataFrame, source: DataFrame, keys: list[str], compare: list[str], update: dict[str, Column]) -> DataFrame:
    """Update matched rows when one of the ``compare`` columns differs (null-safe); never insert, never delete.

    ``update`` maps target columns to expressions over ``s.<column>``.
    """
    on, differ = None, F.lit(False)
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        on = c if on is None else on & c
    for c in compare:
        differ = differ | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    hit = F.col(f"s.{keys[0]}").isNotNull() & differ
    columns = [F.when(hit, update[c]).otherwise(F.col(f"t.{c}")).alias(c) if c in update else F.col(f"t.{c}") for c in target.columns]
    return target.alias("t").join(source.alias("s"), on, "left").select(*columns)


def delete_batch(target: DataFrame, batch_id: str, column: str = "_batch_id") -> DataFrame:
    """All rows of other batches (null included)."""
    return target.filter(~F.col(column).eqNullSafe(F.lit(batch_id)))


def changes(result: DataFrame, action: str = "__action") -> DataFrame:
    """How many rows an upsert inserted, updated and left."""
    of = lambda a: F.count_if(F.col(action) == a).cast("bigint").alias(a)
    return result.agg(of("inserted"), of("updated"), of("unchanged"))
