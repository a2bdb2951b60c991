"""Change-detection hashes and deterministic stand-ins for randomness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands for null in a hash: a control character that data doesn't hold.
NULL_MARK = "\x00"


def row_hash(columns: Sequence[str]) -> Column:
    """Null-safe 64-bit hash of the columns' text, independent of their order and of type widening."""
    if not columns:
        raise ValueError("a row hash needs at least one column")
    return F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_MARK)) for c in sorted(columns)])


def content_checksum(columns: Sequence[str]) -> Column:
    """Order-independent checksum of a table: the exact sum of its row hashes."""
    return F.sum(row_hash(columns).cast("decimal(38,0)"))


def bucket(seed: int, salt: str, n: int, *keys: Column) -> Column:
    """Integer 0 .. n - 1 fixed by seed, salt and keys; never rand(), which a retried task would draw anew."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *keys), F.lit(n)).cast("int")


def uniform(seed: int, salt: str, *keys: Column) -> Column:
    """Double in [0, 1)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), *keys), F.lit(1_000_000_000)) / F.lit(1_000_000_000.0)


def chance(seed: int, salt: str, p: float, *keys: Column) -> Column:
    """True with probability p."""
    return uniform(seed, salt, *keys) < p


def pick(seed: int, salt: str, values: Sequence, *keys: Column) -> Column:
    """One of the values, each as likely."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), bucket(seed, salt, len(values), *keys) + 1)


def weighted_pick(seed: int, salt: str, weights: Sequence[tuple[object, float]], *keys: Column) -> Column:
    """One of the values by weight; the last takes what rounding leaves."""
    total, at = sum(w for _, w in weights), 0.0
    u, out = uniform(seed, salt, *keys), None
    for value, w in weights[:-1]:
        at += w / total
        out = F.when(u < at, F.lit(value)) if out is None else out.when(u < at, F.lit(value))
    last = F.lit(weights[-1][0])
    return last if out is None else out.otherwise(last)
