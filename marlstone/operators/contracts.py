"""The type gate: contracts of the silver layer, and rows whose values will not cast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The contracted types of the seven feeds. Columns not listed pass as they come.
SILVER_TYPES: dict[str, dict[str, str]] = {
    "transactions": {
        "transaction_id": "string", "account_id": "string", "card_id": "string", "merchant_id": "string", "card_product_code": "string",
        "amount_minor": "bigint", "currency_code": "string", "auth_ts": "timestamp", "capture_ts": "timestamp", "settlement_date": "date",
        "status": "string", "decline_reason_code": "string", "mcc": "string", "channel": "string", "country_code": "string", "is_3ds": "boolean",
        "device_id": "string", "wallet_type": "string",
    },
    "accounts": {
        "account_id": "string", "customer_id": "string", "sort_code": "string", "account_number_masked": "string", "account_type": "string",
        "status": "string", "risk_band": "string", "credit_limit_minor": "bigint", "opened_date": "date", "closed_date": "date", "region": "string",
        "_op": "string", "_change_ts": "timestamp",
    },
    "customers": {
        "customer_id": "string", "first_name": "string", "last_name": "string", "email": "string", "dob": "date", "kyc_status": "string",
        "country_code": "string", "segment": "string", "marketing_opt_in": "boolean", "_snapshot_date": "date",
    },
    "merchants": {
        "merchant_id": "string", "merchant_name": "string", "mcc": "string", "category": "string", "country_code": "string",
        "acquirer_id": "string", "risk_score": "int", "status": "string", "onboarded_date": "date", "_snapshot_date": "date",
    },
    "disputes": {
        "dispute_id": "string", "transaction_id": "string", "raised_date": "date", "reason_code": "string", "disputed_amount_minor": "bigint",
        "currency_code": "string", "status": "string", "resolved_date": "date", "_event_ts": "timestamp",
    },
    "fx_rates": {"rate_date": "date", "from_currency": "string", "to_currency": "string", "rate": "decimal(18,8)", "source": "string"},
    "card_products": {
        "card_product_code": "string", "product_name": "string", "network": "string", "tier": "string", "annual_fee_minor": "bigint",
        "active_from": "date", "active_to": "date",
    },
}


def types_for(entity: str) -> dict[str, str]:
    if entity not in SILVER_TYPES:
        raise KeyError(f"no contract for {entity!r}")
    return SILVER_TYPES[entity]


def pending_casts(df: DataFrame, types: dict[str, str]) -> dict[str, T.DataType]:
    """Contracted columns that don't have their type yet. Types are compared as types, not as text."""
    want = {c: T.StructType.fromDDL(f"x {t}")["x"].dataType for c, t in types.items() if c in df.columns}
    return {c: t for c, t in want.items() if df.schema[c].dataType != t}


def castable_rules(df: DataFrame, entity: str, types: dict[str, str], threshold: float = 1.0) -> list:
    """A derived rule for each cast that can fail; a cast to text can't."""
    from .quality import Rule

    pending = pending_casts(df, types)
    return [
        Rule(f"{entity}.{c}.castable", entity, c, "castable", {"type": t.simpleString()}, severity="warn", threshold=threshold)
        for c, t in pending.items() if not isinstance(t, T.StringType)
    ]


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Contracted types for the rows that passed the gate; what is not contracted passes."""
    pending = pending_casts(df, types)
    return df.select(*[F.col(f"`{c}`").try_cast(pending[c]).alias(c) if c in pending else F.col(f"`{c}`") for c in df.columns])


def complete(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Contracted columns that didn't arrive, as nulls of their type: a feed may leave out a field that is always null."""
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in df.columns])
