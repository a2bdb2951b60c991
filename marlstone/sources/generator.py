"""A synthetic payments feed with known defects: seven feeds, fixed by a seed, made by Spark from row numbers alone."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import bucket, chance, pick, uniform, weighted_pick
from .landing import Landing, calendar

SEED = 7919
# Rates of the injected defects, and the share of the span at which rates go missing.
DUPLICATES, NO_MERCHANT, NEGATIVE, BAD_CURRENCY, MISMATCH = 0.003, 0.005, 0.0002, 0.00015, 0.0005
GAPS = (0.17, 0.33, 0.51, 0.68, 0.86)
CURRENCY_WEIGHTS = [("GBP", 70), ("EUR", 12), ("USD", 10), ("JPY", 2), ("CHF", 2), ("AUD", 1), ("CAD", 1), ("SEK", 1), ("NOK", 1)]
RATES = {"USD": 0.79, "EUR": 0.86, "JPY": 0.0053, "CHF": 0.89, "AUD": 0.52, "CAD": 0.58, "SEK": 0.075, "NOK": 0.074}
REGIONS = ("London", "North", "Scotland", "Wales", "South")


@dataclass(frozen=True)
class Scale:
    days: int
    transactions: int
    customers: int
    accounts: int
    merchants: int


SCALES = {"tiny": Scale(120, 50_000, 2_000, 3_000, 500), "demo": Scale(548, 2_000_000, 50_000, 80_000, 8_000)}


class Generator:
    def __init__(self, spark: SparkSession, scale: Scale, as_of: dt.date = dt.date(2026, 6, 30), seed: int = SEED):
        self.spark, self.scale, self.as_of, self.seed = spark, scale, as_of, seed
        self.first = as_of - dt.timedelta(days=scale.days - 1)

    def _id(self, prefix: str, n: Column, width: int = 7) -> Column:
        return F.concat(F.lit(prefix), F.lpad(n.cast("string"), width, "0"))

    def _day(self, offset: Column) -> Column:
        return F.date_add(F.lit(self.first), offset.cast("int"))

    def _months(self) -> DataFrame:
        first = self.first.replace(day=1).isoformat()
        return calendar(self.spark, first, self.as_of.isoformat(), "1 month").select(F.greatest("d", F.lit(self.first)).alias("ingest_date"))

    def card_products(self) -> DataFrame:
        k, s = F.col("id"), self.seed
        return self.spark.range(12).select(
            F.concat(F.lit("CP"), F.lpad(k.cast("string"), 2, "0")).alias("card_product_code"), F.concat(F.lit("Card "), k.cast("string")).alias("product_name"),
            pick(s, "network", ["VISA", "MASTERCARD"], k).alias("network"), pick(s, "tier", ["STANDARD", "GOLD", "PLATINUM"], k).alias("tier"),
            (bucket(s, "fee", 5, k) * 2500).cast("bigint").alias("annual_fee_minor"), F.lit("2020-01-01").cast("date").alias("active_from"),
            F.when(k == 11, F.lit("2025-12-31").cast("date")).alias("active_to"), F.lit(self.first).alias("ingest_date"),
        )

    def fx_rates(self) -> DataFrame:
        gaps = [self.first + dt.timedelta(days=int(self.scale.days * g)) for g in GAPS]
        days = calendar(self.spark, self.first.isoformat(), self.as_of.isoformat()).filter(~F.col("d").isin(gaps))
        base = self.spark.createDataFrame(list(RATES.items()), "from_currency string, base double")
        rate = F.col("base") * (0.97 + 0.06 * uniform(self.seed, "fx", F.col("d"), F.col("from_currency")))
        return days.crossJoin(base).select(F.col("d").alias("rate_date"), "from_currency", F.lit("GBP").alias("to_currency"), F.round(rate, 8).cast("decimal(18,8)").alias("rate"), F.lit("ECB").alias("source"), F.col("d").alias("ingest_date"))

    def customers(self) -> DataFrame:
        s, k, version = self.seed, F.col("id"), F.floor(F.months_between("ingest_date", F.lit(self.first)) / 2)
        return self.spark.range(self.scale.customers).crossJoin(F.broadcast(self._months())).select(
            self._id("CU", k).alias("customer_id"), pick(s, "first", ["Ada", "Ben", "Cleo", "Dev", "Eve"], k).alias("first_name"), pick(s, "last", ["Hall", "Khan", "Lee", "Moss", "Reid"], k).alias("last_name"),
            F.concat(F.lit("c"), k.cast("string"), F.lit("@example.com")).alias("email"), F.date_add(F.lit("1950-01-01").cast("date"), bucket(s, "dob", 19000, k)).alias("dob"),
            weighted_pick(s, "kyc", [("VERIFIED", 9), ("PENDING", 1)], k, F.when(chance(s, "moves", 0.02, k), version).otherwise(0)).alias("kyc_status"), F.lit("GB").alias("country_code"),
            pick(s, "segment", ["RETAIL", "PREMIER", "BUSINESS"], k, F.when(chance(s, "seg", 0.03, k), version).otherwise(0)).alias("segment"), chance(s, "opt", 0.4, k).alias("marketing_opt_in"),
            F.col("ingest_date").alias("_snapshot_date"), "ingest_date",
        )

    def merchants(self) -> DataFrame:
        s, k = self.seed, F.col("id")
        moved = F.when(chance(s, "mmoves", 0.1, k), F.floor(F.months_between("ingest_date", F.lit(self.first)))).otherwise(0)
        return self.spark.range(self.scale.merchants).crossJoin(F.broadcast(self._months())).select(
            self._id("ME", k).alias("merchant_id"), F.concat(F.lit("Merchant "), k.cast("string")).alias("merchant_name"), pick(s, "mcc", ["5411", "5812", "5999", "4111"], k).alias("mcc"),
            pick(s, "mcc", ["Grocery", "Dining", "Retail", "Travel"], k).alias("category"), F.lit("GB").alias("country_code"), pick(s, "acq", ["ACQ1", "ACQ2"], k).alias("acquirer_id"),
            bucket(s, "risk", 101, k, moved).alias("risk_score"), weighted_pick(s, "mstatus", [("ACTIVE", 95), ("SUSPENDED", 5)], k).alias("status"),
            F.date_sub(F.lit(self.first), bucket(s, "onb", 900, k)).alias("onboarded_date"), F.col("ingest_date").alias("_snapshot_date"), "ingest_date",
        )

    def accounts(self) -> DataFrame:
        s, k, n = self.seed, F.col("id"), F.col("n")
        base = self.spark.range(self.scale.accounts).withColumn("changes", bucket(s, "changes", 6, k))
        rows = base.select("id", F.explode(F.sequence(F.lit(0), F.col("changes"))).alias("n"), "changes")
        offset = F.when(n == 0, 0).otherwise(F.floor((n + uniform(s, "when", k, n)) * (self.scale.days / 8)))
        deleted = (n == F.col("changes")) & (n > 0) & chance(s, "del", 0.02, k)
        # Every third change changes nothing.
        version = F.when(bucket(s, "noop", 3, k, n) == 0, n - 1).otherwise(n)
        day = F.least(self._day(offset), F.lit(self.as_of))
        return rows.select(
            self._id("AC", k).alias("account_id"), self._id("CU", bucket(s, "owner", self.scale.customers, k)).alias("customer_id"), F.lpad(bucket(s, "sort", 999999, k).cast("string"), 6, "0").alias("sort_code"),
            F.concat(F.lit("****"), F.lpad(bucket(s, "acc", 10000, k).cast("string"), 4, "0")).alias("account_number_masked"), pick(s, "type", ["CURRENT", "CREDIT"], k).alias("account_type"),
            pick(s, "astatus", ["ACTIVE", "ACTIVE", "DORMANT", "FROZEN"], k, version).alias("status"), pick(s, "band", ["A", "B", "C", "D", "E"], k, version).alias("risk_band"),
            F.when(bucket(s, "type", 2, k) == 1, bucket(s, "limit", 100, k) * 10000).cast("bigint").alias("credit_limit_minor"), F.date_sub(F.lit(self.first), bucket(s, "open", 2000, k)).alias("opened_date"),
            F.lit(None).cast("date").alias("closed_date"), pick(s, "region", list(REGIONS), k).alias("region"), F.when(deleted, "D").when(n == 0, "I").otherwise("U").alias("_op"),
            (day.cast("timestamp") + F.make_dt_interval(hours=n)).alias("_change_ts"), day.alias("ingest_date"),
        )

    def transactions(self) -> DataFrame:
        s, k = self.seed, F.col("id")
        channel = weighted_pick(s, "channel", [("POS", 45), ("ECOM", 40), ("ATM", 12), ("MOTO", 3)], k)
        status = weighted_pick(s, "status", [("SETTLED", 80), ("CAPTURED", 6), ("AUTHORISED", 4), ("DECLINED", 8), ("REVERSED", 2)], k)
        currency = weighted_pick(s, "ccy", CURRENCY_WEIGHTS, k)
        df = self.spark.range(self.scale.transactions).withColumns({"channel": channel, "status": status, "ccy": currency, "off": bucket(s, "day", self.scale.days, k)})
        at = (self._day(F.col("off")).cast("timestamp") + F.make_dt_interval(secs=bucket(s, "sec", 86400, k).cast("decimal(18,6)"))).alias("auth_ts")
        wrong = (F.col("status") == "DECLINED") != chance(s, "mismatch", MISMATCH, k)
        reason = F.when(wrong, pick(s, "reason", ["INSUFFICIENT_FUNDS", "LIMIT_EXCEEDED", "DO_NOT_HONOUR", "EXPIRED_CARD", "INVALID_CVV", "SUSPECTED_FRAUD"], k))
        amount = (bucket(s, "amt", 20000, k) + 100).cast("bigint")
        done = F.col("status").isin("CAPTURED", "SETTLED")
        out = df.select(
            self._id("TX", k, 10).alias("transaction_id"), self._id("AC", bucket(s, "acct", self.scale.accounts, k)).alias("account_id"), self._id("CA", bucket(s, "card", self.scale.accounts, k)).alias("card_id"),
            F.when((F.col("channel") != "ATM") & ~chance(s, "nomerch", NO_MERCHANT, k), self._id("ME", bucket(s, "merch", self.scale.merchants, k))).alias("merchant_id"),
            F.concat(F.lit("CP"), F.lpad(bucket(s, "prod", 12, k).cast("string"), 2, "0")).alias("card_product_code"),
            F.when(chance(s, "neg", NEGATIVE, k), -amount).otherwise(amount).alias("amount_minor"), F.when(chance(s, "badccy", BAD_CURRENCY, k), F.lit("XYZ")).otherwise(F.col("ccy")).alias("currency_code"), at,
            F.when(done, self._day(F.col("off")).cast("timestamp") + F.make_dt_interval(hours=F.lit(26))).alias("capture_ts"),
            F.when(F.col("status") == "SETTLED", F.date_add(self._day(F.col("off")), 1 + bucket(s, "lag", 4, k))).alias("settlement_date"), "status", reason.alias("decline_reason_code"),
            pick(s, "tmcc", ["5411", "5812", "5999", "4111"], k).alias("mcc"), "channel", F.lit("GB").alias("country_code"), ((F.col("channel") == "ECOM") & chance(s, "3ds", 0.6, k)).alias("is_3ds"),
            F.when(chance(s, "dev", 0.8, k), self._id("DV", bucket(s, "dev", 5000, k))).alias("device_id"),
            F.when((F.col("off") >= int(self.scale.days * 10 / 18)) & chance(s, "wallet", 0.3, k), pick(s, "wal", ["APPLE", "GOOGLE"], k)).alias("wallet_type"), self._day(F.col("off")).alias("ingest_date"),
        )
        return out.unionByName(out.filter(chance(s, "dup", DUPLICATES, F.col("transaction_id"))))

    def disputes(self) -> DataFrame:
        s = self.seed
        t = self.transactions().dropDuplicates(["transaction_id"]).filter((F.col("status") == "SETTLED") & (F.col("amount_minor") > 0) & F.col("currency_code").isin([c for c, _ in CURRENCY_WEIGHTS]) & F.col("decline_reason_code").isNull() & (F.col("merchant_id").isNotNull() | (F.col("channel") == "ATM")))
        k = F.col("transaction_id")
        raised = F.date_add(F.col("auth_ts").cast("date"), bucket(s, "late", 91, k))
        status = weighted_pick(s, "dstatus", [("OPEN", 3), ("WON", 3), ("LOST", 3), ("WITHDRAWN", 1)], k)
        t = t.filter(chance(s, "disputed", 0.006, k)).withColumns({"raised_date": raised, "dstatus": status}).filter(F.col("raised_date") <= F.lit(self.as_of))
        return t.select(
            F.concat(F.lit("DP"), F.substring("transaction_id", 3, 10)).alias("dispute_id"), "transaction_id", "raised_date", pick(s, "dreason", ["FRAUD", "NOT_RECEIVED", "DUPLICATE"], k).alias("reason_code"),
            F.col("amount_minor").alias("disputed_amount_minor"), "currency_code", F.col("dstatus").alias("status"), F.when(F.col("dstatus") != "OPEN", F.date_add("raised_date", 1 + bucket(s, "dres", 30, k))).alias("resolved_date"),
            F.col("raised_date").cast("timestamp").alias("_event_ts"), F.col("raised_date").alias("ingest_date"),
        )

    def write(self, landing: Landing) -> None:
        formats = {"transactions": "json", "accounts": "csv", "customers": "csv", "merchants": "parquet", "disputes": "json", "fx_rates": "csv", "card_products": "csv"}
        for entity, kind in formats.items():
            landing.write(getattr(self, entity)(), entity, kind)
