"""The report's queries, and a self-contained page of them."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import top_k
from .measures import COUNT, MEASURES, MONEY, ONE, PERCENT, evaluate, render

_n = lambda: F.count(F.lit(1)).cast("bigint")
_sum = lambda c: F.sum(c).cast("bigint")


def totals(star: dict[str, DataFrame]) -> DataFrame:
    return star["fact_transaction"].agg(
        _n().alias("attempts"), *[_sum(f"is_{s}").alias(s) for s in ("approved", "declined", "reversed", "settled")], _sum("amount_gbp_minor").alias("attempted_gbp_minor"),
        _sum(F.when(F.col("is_approved") == 1, F.col("amount_gbp_minor"))).alias("approved_gbp_minor"), F.avg(F.col("settlement_lag_days").cast("double")).alias("avg_settlement_lag"),
        F.count_if("fx_rate_is_carried").cast("bigint").alias("fx_carried"),
    )


def declines_by_reason(star: dict[str, DataFrame]) -> DataFrame:
    """Declines only, so the not-applicable member has no row."""
    j = star["fact_transaction"].filter("is_declined = 1").join(F.broadcast(star["dim_decline_reason"]), "decline_reason_sk")
    return j.groupBy("decline_reason_code", "decline_reason_desc", "decline_category", "is_retriable").agg(_n().alias("declines")).orderBy(F.desc("declines"), "decline_reason_code")


def by_channel(star: dict[str, DataFrame]) -> DataFrame:
    return star["fact_transaction"].groupBy("channel").agg(_n().alias("attempts"), _sum("is_declined").alias("declined")).orderBy(F.desc("attempts"), "channel")


def three_ds(star: dict[str, DataFrame]) -> DataFrame:
    """Online payments only, on both sides."""
    return star["fact_transaction"].filter("channel = 'ECOM'").groupBy("is_3ds").agg(_n().alias("attempts"), _sum("is_approved").alias("approved"))


def wallets(star: dict[str, DataFrame]) -> DataFrame:
    """Missing wallets keep a group of their own, with a label."""
    w = F.coalesce("wallet_type", F.lit("(not recorded)")).alias("wallet")
    return star["fact_transaction"].groupBy(w).agg(_n().alias("attempts"), _sum("is_approved").alias("approved")).orderBy(F.desc("attempts"), "wallet")


def monthly(star: dict[str, DataFrame]) -> DataFrame:
    j = star["fact_transaction"].join(F.broadcast(star["dim_date"]), "date_sk")
    return j.groupBy("year_month").agg(_n().alias("attempts"), _sum("is_approved").alias("approved"), _sum("is_declined").alias("declined"), _sum("amount_gbp_minor").alias("attempted_gbp_minor")).orderBy("year_month")


def top_merchants(star: dict[str, DataFrame], k: int = 10) -> DataFrame:
    """By business key: a merchant's versions are one merchant."""
    j = star["fact_transaction"].drop("mcc", "country_code").join(star["dim_merchant"], "merchant_sk")
    g = j.groupBy("merchant_id").agg(F.max("merchant_name").alias("merchant_name"), F.max("mcc_category").alias("mcc_category"), _n().alias("attempts"), _sum("is_approved").alias("approved"), _sum("amount_gbp_minor").alias("attempted_gbp_minor"))
    return top_k(g, "attempted_gbp_minor", k, ["merchant_id"])


def disputes(star: dict[str, DataFrame]) -> DataFrame:
    closed = F.col("is_open") == 0
    return star["fact_dispute"].agg(
        _n().alias("raised"), _sum("is_open").alias("open_now"), _sum("is_won").alias("won"), _sum("is_lost").alias("lost"), _sum("disputed_amount_gbp_minor").alias("disputed_gbp_minor"),
        F.count_if(closed).cast("bigint").alias("resolved"), F.avg(F.when(closed, F.col("resolution_days").cast("double"))).alias("resolution_days"),
    )


def current_members(star: dict[str, DataFrame]) -> DataFrame:
    """Four one-row aggregates side by side."""
    count = lambda t, c: star[t].filter("is_current").agg(F.count_distinct(c).alias(c.replace("_id", "s")))
    risk = star["dim_merchant"].filter("is_current").agg(F.avg(F.col("risk_score").cast("double")).alias("risk_score"))
    return count("dim_account", "account_id").crossJoin(count("dim_customer", "customer_id")).crossJoin(count("dim_merchant", "merchant_id")).crossJoin(risk)


def transacting_accounts(star: dict[str, DataFrame]) -> DataFrame:
    return star["fact_transaction"].join(star["dim_account"], "account_sk").agg(F.count_distinct("account_id").alias("accounts"))


def aggregate_totals(star: dict[str, DataFrame]) -> DataFrame:
    return star["agg_merchant_daily"].agg(*[_sum(c).alias(c) for c in ("attempt_count", "approved_count", "attempted_amount_gbp_minor", "distinct_account_count")])


TILES = ("Attempts", "Authorisation Rate", "Decline Rate", "Retriable Decline Share", "Average Approved Value (GBP)", "Average Settlement Lag (Days)", "3DS Approval Uplift (pp)", "FX Carried Share", "Dispute Win Rate", "Chargeback Rate (bps)", "Distinct Accounts", "Active Merchants")


def _bars(rows: list[tuple[str, float]], width: int = 420) -> str:
    """Horizontal bars as inline SVG."""
    most, out = max((v for _, v in rows), default=0) or 1, []
    for i, (label, v) in enumerate(rows):
        y = 22 * i
        out.append(f'<text x="0" y="{y + 14}" font-size="12">{html.escape(str(label))}</text><rect x="190" y="{y + 3}" width="{v / most * (width - 190):.1f}" height="14" fill="#4a7a8c"/><text x="{width + 6}" y="{y + 14}" font-size="12">{v:,.0f}</text>')
    return f'<svg width="{width + 100}" height="{22 * len(rows) + 4}" role="img">{"".join(out)}</svg>'


def page(star: dict[str, DataFrame]) -> str:
    """One HTML document without outside references. Only aggregates reach the driver."""
    row = evaluate(star, list(TILES)).first()
    tiles = "".join(f"<div class=t><b>{html.escape(render(row[n], MEASURES[n].format))}</b><span>{html.escape(n)}</span></div>" for n in TILES)
    parts = [
        ("Declines by reason", _bars([(r["decline_reason_desc"], r["declines"]) for r in declines_by_reason(star).collect()])),
        ("Attempts by month", _bars([(r["year_month"], r["attempts"]) for r in monthly(star).collect()])),
        ("Top merchants by volume (GBP)", _bars([(r["merchant_name"], (r["attempted_gbp_minor"] or 0) / 100) for r in top_merchants(star).collect()])),
        ("Attempts by wallet", _bars([(r["wallet"], r["attempts"]) for r in wallets(star).collect()])),
    ]
    body = "".join(f"<h2>{html.escape(t)}</h2>{s}" for t, s in parts)
    style = "body{font:14px sans-serif;margin:2em}.t{display:inline-block;margin:.4em;padding:.6em 1em;border:1px solid #ccc}.t b{display:block;font-size:1.4em}"
    return f"<!doctype html><meta charset=utf-8><title>Payments</title><style>{style}</style><h1>Payments</h1>{tiles}{body}"


FORMATS = (MONEY, PERCENT, COUNT, ONE)
