"""Feed and rule configuration, and how parameters are resolved."""

from __future__ import annotations

import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import Rule

CONFIG_COLUMNS = (
    "entity", "source_format", "read_options", "target_table", "load_type", "watermark_column", "merge_keys", "scd_type", "effective_from_column",
    "op_column", "dq_rule_set", "partition_column", "reprocess_window_days", "allow_schema_evolution", "priority", "enabled",
)

# The seven feeds. Smaller priorities run first; feeds of one priority run together.
FEEDS = (
    ("transactions", "json", {"multiLine": "false"}, "fact_transaction", "incremental_watermark", "ingest_date", "transaction_id", 0, "auth_ts", None, "transactions", "ingest_date", None, True, 20, True),
    ("accounts", "csv", {"header": "true"}, "dim_account", "incremental_watermark", "ingest_date", "account_id", 2, "_change_ts", "_op", "accounts", "ingest_date", None, False, 10, True),
    ("customers", "csv", {"header": "true"}, "dim_customer", "full_snapshot", "ingest_date", "customer_id", 2, "_snapshot_date", None, "customers", "ingest_date", None, False, 10, True),
    ("merchants", "parquet", {}, "dim_merchant", "full_snapshot", "ingest_date", "merchant_id", 2, "_snapshot_date", None, "merchants", "ingest_date", None, False, 10, True),
    ("disputes", "json", {"multiLine": "false"}, "fact_dispute", "incremental_watermark", "ingest_date", "dispute_id", 0, "_event_ts", None, "disputes", "ingest_date", 90, False, 30, True),
    ("fx_rates", "csv", {"header": "true"}, "dim_fx_rate", "incremental_watermark", "ingest_date", "rate_date,from_currency", 0, "rate_date", None, "fx_rates", "ingest_date", None, False, 5, True),
    ("card_products", "csv", {"header": "true"}, "dim_card_product", "static", None, "card_product_code", 1, None, None, "card_products", "ingest_date", None, False, 5, True),
)
LOAD_TYPES = ("incremental_watermark", "full_snapshot", "static")
CURRENCIES = ("GBP", "USD", "EUR", "JPY", "CHF", "AUD", "CAD", "SEK", "NOK")

# The configured rules as (set, column, type, severity, condition, threshold, parameters).
RULES = (
    ("transactions", "transaction_id", "not_null", "error", None, None, {}),
    ("transactions", "transaction_id", "unique", "error", None, None, {}),
    ("transactions", "account_id", "not_null", "error", None, None, {}),
    ("transactions", "amount_minor", "range", "warn", None, 1.0, {"min": 1}),
    ("transactions", "currency_code", "enum_domain", "warn", None, 1.0, {"values": list(CURRENCIES)}),
    ("transactions", "status", "enum_domain", "error", None, None, {"values": ["AUTHORISED", "DECLINED", "REVERSED", "CAPTURED", "SETTLED"]}),
    ("transactions", "channel", "enum_domain", "error", None, None, {"values": ["POS", "ECOM", "ATM", "MOTO"]}),
    ("transactions", "merchant_id", "not_null", "warn", "channel <> 'ATM'", 2.0, {}),
    ("transactions", "merchant_id", "referential", "warn", "merchant_id is not null", 1.0, {"ref_layer": "silver", "ref_table": "dim_merchant", "ref_column": "merchant_id"}),
    ("transactions", "decline_reason_code", "expression", "warn", None, 1.0, {"predicate": "(status = 'DECLINED') = (decline_reason_code is not null)"}),
    ("accounts", "account_id", "not_null", "error", None, None, {}),
    ("accounts", "_op", "enum_domain", "error", None, None, {"values": ["I", "U", "D"]}),
    ("accounts", "_change_ts", "not_null", "error", None, None, {}),
    ("accounts", "risk_band", "enum_domain", "warn", None, 1.0, {"values": ["A", "B", "C", "D", "E"]}),
    ("accounts", "status", "enum_domain", "warn", None, 1.0, {"values": ["ACTIVE", "DORMANT", "FROZEN", "CLOSED"]}),
    ("accounts", "customer_id", "not_null", "warn", None, 1.0, {}),
    ("customers", "customer_id", "not_null", "error", None, None, {}),
    ("customers", "customer_id", "unique", "error", None, None, {}),
    ("customers", "kyc_status", "enum_domain", "warn", None, 1.0, {"values": ["VERIFIED", "PENDING", "FAILED"]}),
    ("customers", "segment", "enum_domain", "warn", None, 1.0, {"values": ["RETAIL", "PREMIER", "BUSINESS"]}),
    ("customers", "email", "not_null", "warn", None, 5.0, {}),
    ("merchants", "merchant_id", "not_null", "error", None, None, {}),
    ("merchants", "merchant_id", "unique", "error", None, None, {}),
    ("merchants", "risk_score", "range", "warn", None, 1.0, {"min": 0, "max": 100}),
    ("merchants", "status", "enum_domain", "warn", None, 1.0, {"values": ["ACTIVE", "SUSPENDED", "TERMINATED"]}),
    ("merchants", "mcc", "not_null", "warn", None, 1.0, {}),
    ("disputes", "dispute_id", "not_null", "error", None, None, {}),
    ("disputes", "dispute_id", "unique", "error", None, None, {}),
    ("disputes", "transaction_id", "referential", "error", None, None, {"ref_layer": "silver", "ref_table": "fact_transaction", "ref_column": "transaction_id"}),
    ("disputes", "disputed_amount_minor", "range", "warn", None, 1.0, {"min": 1}),
    ("disputes", "status", "enum_domain", "warn", None, 1.0, {"values": ["OPEN", "WON", "LOST", "WITHDRAWN"]}),
    ("disputes", "resolved_date", "expression", "warn", None, 1.0, {"predicate": "(status <> 'OPEN') = (resolved_date is not null)"}),
    ("fx_rates", "rate_date", "not_null", "error", None, None, {}),
    ("fx_rates", "rate", "range", "error", None, None, {"min": 0.000001}),
    ("fx_rates", "from_currency", "enum_domain", "warn", None, 1.0, {"values": [c for c in CURRENCIES if c != "GBP"]}),
    ("fx_rates", "rate_date", "freshness", "warn", None, None, {"max_age_days": 3}),
    ("fx_rates", "rate_date", "continuity", "warn", None, None, {"max_missing_days": 0}),
    ("card_products", "card_product_code", "not_null", "error", None, None, {}),
    ("card_products", "card_product_code", "unique", "error", None, None, {}),
    ("card_products", "annual_fee_minor", "range", "warn", None, 1.0, {"min": 0}),
)


def feed_configs() -> list[dict]:
    return [dict(zip(CONFIG_COLUMNS, f, strict=True)) for f in FEEDS]


def quality_rules() -> list[Rule]:
    return [Rule(f"{s}.{c}.{t}", s, c, t, p, cond, sev, th) for s, c, t, sev, cond, th, p in RULES]


def config_frame(spark: SparkSession, configs: list[dict]) -> DataFrame:
    """The configuration as a table; options are JSON text."""
    schema = "entity string, source_format string, read_options string, target_table string, load_type string, watermark_column string, merge_keys string, scd_type int, effective_from_column string, op_column string, dq_rule_set string, partition_column string, reprocess_window_days int, allow_schema_evolution boolean, priority int, enabled boolean"
    return spark.createDataFrame([tuple(json.dumps(c[k]) if k == "read_options" else c[k] for k in CONFIG_COLUMNS) for c in configs], schema)


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    schema = "rule_id string, rule_set string, column_name string, rule_type string, rule_params string, condition string, severity string, fail_threshold_pct string, enabled boolean"
    rows = [(r.rule_id, r.rule_set, r.column, r.rule_type, json.dumps(r.params), r.condition, r.severity, None if r.threshold is None else str(r.threshold), True) for r in rules]
    return spark.createDataFrame(rows, schema)


def rules_from(df: DataFrame) -> list[Rule]:
    rows = df.filter("enabled").orderBy("rule_id").collect()
    return [Rule(r["rule_id"], r["rule_set"], r["column_name"], r["rule_type"], json.loads(r["rule_params"] or "{}"), r["condition"], r["severity"], float(r["fail_threshold_pct"]) if r["fail_threshold_pct"] else None) for r in rows]


def config_for(configs: list[dict], entity: str, enabled: bool = True) -> dict:
    """One feed's configuration; disabled feeds don't count unless asked for."""
    for c in configs:
        if c["entity"] == entity:
            if enabled and not c["enabled"]:
                raise ValueError(f"feed {entity!r} is disabled")
            return c
    raise KeyError(f"no feed {entity!r}")


def resolve(name: str, default: str = "", argv: list[str] | None = None, environ: dict | None = None, prefix: str = "MARLSTONE_") -> str:
    """A parameter from the command line (--name value or --name=value), else the environment, else the default."""
    argv, environ = sys.argv[1:] if argv is None else argv, os.environ if environ is None else environ
    want = "--" + name.replace("_", "-")
    for i, a in enumerate(argv):
        if a == want and i + 1 < len(argv):
            return argv[i + 1]
        if a.startswith(want + "="):
            return a[len(want) + 1 :]
    return environ.get(prefix + name.upper(), default)
