"""Value expressions: safe division, money, bands, null-safe difference, lossy casts, masks, types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_divide(num: Column, den: Column) -> Column:
    """num / den as a double; null when either is null or the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def minor_to_major(minor: Column) -> Column:
    """Minor units to major ones."""
    return minor.cast("double") / 100.0


def bps(num: Column, den: Column) -> Column:
    """A ratio in basis points."""
    return safe_divide(num, den) * 10000.0


def scale_to_two_digits(digits: Column) -> Column:
    """Factor from an amount in a currency's minor units to hundredths; null for unknown digit counts."""
    return F.when(digits == 0, F.lit(100)).when(digits == 2, F.lit(1)).when(digits == 3, F.lit("0.1").cast("decimal(12,4)")).cast("decimal(12,4)")


def convert_minor(amount: Column, rate: Column, factor: Column) -> Column:
    """Amount times rate times factor, rounded half away from zero; decimals only, so no float error."""
    return F.round(amount.cast("bigint") * rate.cast("decimal(18,8)") * factor.cast("decimal(12,4)"), 0).cast("bigint")


def risk_tier(score: Column) -> Column:
    """Quarter bands of a 0 to 100 score."""
    return (
        F.when((score >= 0) & (score < 25), "LOW").when((score >= 25) & (score < 50), "MEDIUM").when((score >= 50) & (score < 75), "HIGH")
        .when((score >= 75) & (score <= 100), "CRITICAL").otherwise("UNKNOWN")
    )


def differs(a: Column, b: Column) -> Column:
    """Null-safe difference."""
    return ~a.eqNullSafe(b)


def flag(condition: Column) -> Column:
    """1 where true, else 0 (null included), as a small integer."""
    return F.when(condition, 1).otherwise(0).cast("smallint")


def lossy_cast(c: Column, to: T.DataType | str) -> Column:
    """True where a value is there but will not cast."""
    return c.isNotNull() & c.try_cast(to).isNull()


def mask_email(c: Column) -> Column:
    """First character and the shape of an address."""
    return F.regexp_replace(c, r"^(.).*@.*$", "$1XXX@XXXX.com")


def mask_partial(c: Column, head: int, pad: str, tail: int) -> Column:
    """``head`` first and ``tail`` last characters around a fixed pad; short values show the pad alone."""
    whole = F.length(c) > head + tail
    ends = F.concat(F.substring(c, 1, head), F.lit(pad), F.substring(c, -tail, tail) if tail else F.lit(""))
    return F.when(c.isNull(), None).when(whole, ends).otherwise(F.lit(pad))


def mask_default(c: Column, kind: T.DataType) -> Column:
    """The type's neutral value in place of any value."""
    if isinstance(kind, T.StringType):
        return F.lit("XXXX")
    if isinstance(kind, T.DateType):
        return F.lit("1900-01-01").cast("date")
    if isinstance(kind, T.TimestampType):
        return F.lit("1900-01-01").cast("timestamp")
    return F.lit(0).cast(kind)


# Warehouse type names and the Spark types that hold them.
WAREHOUSE_TYPES = {"bit": "boolean", "smallint": "smallint", "int": "int", "bigint": "bigint", "date": "date", "datetime2": "timestamp", "float": "double"}


def warehouse_type(name: str) -> str:
    """Spark type of a warehouse column type such as varchar(20), decimal(18,8) or datetime2(6)."""
    base, _, rest = name.strip().lower().partition("(")
    if base in ("varchar", "char"):
        return f"varchar({rest}" if rest else "string"
    if base in ("decimal", "numeric"):
        return f"decimal({rest.replace(' ', '')}" if rest else "decimal(18,0)"
    if base not in WAREHOUSE_TYPES:
        raise ValueError(f"unknown warehouse type {name!r}")
    return WAREHOUSE_TYPES[base]
