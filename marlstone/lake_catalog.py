"""Registered queries over the plans: gold loads, the report, the store, windows, control tables; each with its SQL twin.

The feeds are made of the driver's tables: customers are accounts and their holders, suppliers merchants, lines (of equal
keys the newest) transactions, returned lines disputes, order priorities card products; versions change on fixed days.
Tables that a query writes go to a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import NEWEST_SQL, _newest, big, cents, day_text, query, read
from .functions.dates import open_ts
from .functions.hashing import bucket, chance, content_checksum, pick, uniform, weighted_pick
from .functions.values import flag, warehouse_type
from .operators import project, quality
from .operators.calendar import dim_date
from .operators.dedupe import dedupe_grain
from .plans import config, control, gold, ingest, maintenance, report, runner
from .sources.landing import Landing
from .sources.store import TableStore

OPEN = "TIMESTAMP '9999-12-31 23:59:59'"
CURRENCIES = ("GBP", "USD", "EUR", "JPY", "CHF", "AUD", "CAD", "SEK", "NOK", "XXX")
REASONS = tuple(r[1] for r in gold.REASON_ROWS[1:])


def workspace(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{tempfile.gettempdir()}/marlstone-lake"
    return f"{at.rstrip('/')}/lake-{uuid.uuid4().hex}"


def _store(spark: SparkSession) -> TableStore:
    return TableStore(spark, workspace(spark))


# ---- silver frames and what SQL says of them -----------------------------------------------------------------------


def _versions(df: DataFrame, key: str, every: int, day: str) -> DataFrame:
    """One version each, two for every so many keys; keys divisible by seven are known from 1995-03-01 only."""
    two, second = F.col(key) % every == 0, F.col("v") == 1
    df = df.withColumn("v", F.explode(F.when(two, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    at, first = F.lit(day).cast("timestamp"), F.when(F.col(key) % 7 == 0, F.lit("1995-03-01")).otherwise("1990-01-01").cast("timestamp")
    return df.withColumns({
        "valid_from": F.when(second, at).otherwise(first), "valid_to": F.when(~second & two, at).otherwise(open_ts()), "is_current": second | ~two,
        "_scd_hash": F.xxhash64(key, "v"),
    })


def _versions_sql(key: str, every: int, day: str) -> str:
    return f"""v, CASE WHEN v = 1 THEN TIMESTAMP '{day}' WHEN {key} % 7 = 0 THEN TIMESTAMP '1995-03-01' ELSE TIMESTAMP '1990-01-01' END AS valid_from,
        CASE WHEN v = 0 AND {key} % {every} = 0 THEN TIMESTAMP '{day}' ELSE {OPEN} END AS valid_to, v = 1 OR {key} % {every} <> 0 AS is_current"""


def silver_accounts(spark: SparkSession, sf: str) -> DataFrame:
    c = _versions(read(spark, sf, "customer"), "c_custkey", 3, "1998-06-01")
    none = F.lit(None)
    return c.select(
        F.concat(F.lit("A"), "c_custkey").alias("account_id"), F.concat(F.lit("C"), "c_custkey").alias("customer_id"), F.lit("112233").alias("sort_code"), F.lit("****1234").alias("account_number_masked"),
        F.col("c_mktsegment").alias("account_type"), F.when(F.col("is_current"), "ACTIVE").otherwise("DORMANT").alias("status"), F.substring(F.lit("ABCDE"), ((F.col("c_custkey") + F.col("v")) % 5 + 1).cast("int"), F.lit(1)).alias("risk_band"),
        cents("c_acctbal").alias("credit_limit_minor"), F.concat(F.lit("R"), (F.col("c_nationkey") % 5).cast("string")).alias("region"), F.lit("1990-01-01").cast("date").alias("opened_date"), none.cast("date").alias("closed_date"),
        "valid_from", "valid_to", "is_current", "_scd_hash", "v",
    )


def silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    c = _versions(read(spark, sf, "customer"), "c_custkey", 4, "1997-01-01")
    return c.select(
        F.concat(F.lit("C"), "c_custkey").alias("customer_id"), F.lit("F").alias("first_name"), F.col("c_name").alias("last_name"), F.concat(F.lower("c_name"), F.lit("@mail.example")).alias("email"),
        F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int")).alias("dob"), F.when(F.col("v") == 0, "PENDING").otherwise("VERIFIED").alias("kyc_status"), F.lit("GB").alias("country_code"),
        F.col("c_mktsegment").alias("segment"), (F.col("c_custkey") % 2 == 0).alias("marketing_opt_in"), "valid_from", "valid_to", "is_current", "_scd_hash",
    )


def silver_merchants(spark: SparkSession, sf: str) -> DataFrame:
    s = _versions(read(spark, sf, "supplier"), "s_suppkey", 2, "1999-01-01")
    return s.select(
        F.concat(F.lit("M"), "s_suppkey").alias("merchant_id"), F.col("s_name").alias("merchant_name"), F.lpad((F.col("s_nationkey") * 100).cast("string"), 4, "0").alias("mcc"), F.concat(F.lit("cat"), (F.col("s_nationkey") % 4).cast("string")).alias("category"),
        F.lit("GB").alias("country_code"), F.lit("ACQ").alias("acquirer_id"), ((F.col("s_suppkey") * 7 + F.col("v") * 30) % 110).cast("int").alias("risk_score"), F.lit("ACTIVE").alias("status"), F.lit("1990-01-01").cast("date").alias("onboarded_date"),
        "valid_from", "valid_to", "is_current", "_scd_hash",
    )


def silver_products(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").select(F.col("o_orderpriority").alias("card_product_code")).distinct()
    return o.select(
        "card_product_code", F.upper("card_product_code").alias("product_name"), F.lit("NET").alias("network"), F.lit("GOLD").alias("tier"), (F.substring("card_product_code", 1, 1).cast("bigint") * 1000).alias("annual_fee_minor"),
        F.lit("1990-01-01").cast("date").alias("active_from"), F.lit(None).cast("date").alias("active_to"),
    )


def silver_rates(spark: SparkSession, sf: str) -> DataFrame:
    """A rate on the first of most months for eight currencies."""
    months = spark.sql("SELECT posexplode(sequence(date'1994-06-01', date'2001-12-01', interval 1 month)) AS (i, rate_date)")
    cur = spark.createDataFrame(list(enumerate(CURRENCIES[1:9], 1)), "k int, from_currency string")
    r = months.crossJoin(F.broadcast(cur)).filter("(i + k) % 5 <> 0 or i = 0")
    rate = (F.lit(50) + F.col("k") * 10 + F.col("i")).cast("decimal(18,8)") / F.lit(100).cast("decimal(3,0)")
    return r.select("rate_date", "from_currency", F.lit("GBP").alias("to_currency"), rate.cast("decimal(18,8)").alias("rate"), F.lit("ecb").alias("source"))


def silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    l = _newest(spark, sf).join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left")  # noqa: E741
    key, line, declined = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag") == "R"
    cur = F.element_at(F.array(*map(F.lit, CURRENCIES)), ((key + line) % 10 + 1).cast("int"))
    status = F.when(declined, "DECLINED").when(F.col("l_returnflag") == "A", "REVERSED").when(F.col("l_linestatus") == "F", "SETTLED").otherwise("AUTHORISED")
    at = F.timestamp_add("HOUR", line, F.col("o_orderdate").cast("timestamp"))
    return l.select(
        F.concat(F.lit("T"), "l_orderkey", F.lit("-"), "l_linenumber").alias("transaction_id"), F.concat(F.lit("K"), "o_custkey").alias("card_id"),
        F.when(key % 50 == 1, "AX").when(key % 50 != 0, F.concat(F.lit("A"), "o_custkey")).alias("account_id"), F.when(line % 6 != 0, F.concat(F.lit("M"), "l_suppkey")).alias("merchant_id"), F.col("o_orderpriority").alias("card_product_code"),
        cur.alias("currency_code"), F.when(declined, F.element_at(F.array(*map(F.lit, REASONS)), (line % 6 + 1).cast("int"))).alias("decline_reason_code"), status.alias("status"), cents("l_extendedprice").alias("amount_minor"),
        at.alias("auth_ts"), F.when(~declined, at).alias("capture_ts"), F.when(F.col("l_linestatus") == "F", F.col("l_shipdate").cast("date")).alias("settlement_date"), F.when(line % 6 == 0, "ATM").when(line % 3 == 0, "ECOM").otherwise("POS").alias("channel"),
        F.lit("GB").alias("country_code"), F.lit("5411").alias("mcc"), (F.col("l_tax") > 0.04).alias("is_3ds"), F.when(line % 4 == 1, "APPLE").when(line % 4 == 2, "GOOGLE").alias("wallet_type"), F.lit(None).cast("string").alias("device_id"),
    )


def silver_disputes(spark: SparkSession, sf: str) -> DataFrame:
    l = _newest(spark, sf).filter("l_returnflag = 'R'")  # noqa: E741
    line, closed, raised = F.col("l_linenumber"), F.col("l_linestatus") == "F", F.col("l_shipdate").cast("date")
    kind = F.when(~closed, "OPEN").when(line % 3 == 0, "WON").when(line % 3 == 1, "LOST").otherwise("WITHDRAWN")
    return l.select(
        F.concat(F.lit("D"), "l_orderkey", F.lit("-"), "l_linenumber").alias("dispute_id"), F.concat(F.lit("T"), "l_orderkey", F.lit("-"), F.when(line == 7, 99).otherwise(line)).alias("transaction_id"), raised.alias("raised_date"),
        F.lit("10.4").alias("reason_code"), F.floor(cents("l_extendedprice") / 2).cast("bigint").alias("disputed_amount_minor"), F.element_at(F.array(*map(F.lit, CURRENCIES)), ((F.col("l_orderkey") + line) % 10 + 1).cast("int")).alias("currency_code"),
        kind.alias("status"), F.when(closed, F.date_add(raised, (line * 10).cast("int"))).alias("resolved_date"),
    )


def star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The star as plans.gold makes it of those frames."""
    d = {
        "dim_currency": gold.dim_currency(spark), "dim_decline_reason": gold.dim_decline_reason(spark), "dim_date": dim_date(spark, "1995-01-01", "2003-12-31"), "dim_card_product": gold.dim_card_product(None, silver_products(spark, sf)),
        "dim_account": gold.versioned_dimension("dim_account", None, silver_accounts(spark, sf)), "dim_customer": gold.versioned_dimension("dim_customer", None, silver_customers(spark, sf)),
        "dim_merchant": gold.versioned_dimension("dim_merchant", None, silver_merchants(spark, sf)), "dim_fx_rate": gold.dim_fx_rate(silver_rates(spark, sf)),
    }
    d["fact_transaction"] = gold.fact_transaction(silver_transactions(spark, sf), d)
    d["fact_dispute"] = gold.fact_dispute(silver_disputes(spark, sf), d["fact_transaction"], d)
    d["agg_merchant_daily"] = gold.agg_merchant_daily(d["fact_transaction"], d["fact_dispute"])
    return d


_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
_DAY = lambda d: f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS BIGINT)"

DIMS_SQL = f"""
    acc AS (SELECT *, row_number() OVER (ORDER BY account_id, valid_from) AS account_sk FROM (SELECT 'A' || c_custkey AS account_id, 'C' || c_custkey AS customer_id, 'R' || (c_nationkey % 5) AS region, substr('ABCDE', CAST((c_custkey + v) % 5 + 1 AS INT), 1) AS risk_band, {_versions_sql("c_custkey", 3, "1998-06-01")} FROM customer CROSS JOIN (VALUES (0), (1)) t(v) WHERE v = 0 OR c_custkey % 3 = 0)),
    cus AS (SELECT *, row_number() OVER (ORDER BY customer_id, valid_from) AS customer_sk FROM (SELECT 'C' || c_custkey AS customer_id, c_custkey, CASE WHEN v = 0 THEN 'PENDING' ELSE 'VERIFIED' END AS kyc_status, year(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INT)) AS birth_year, {_versions_sql("c_custkey", 4, "1997-01-01")} FROM customer CROSS JOIN (VALUES (0), (1)) t(v) WHERE v = 0 OR c_custkey % 4 = 0)),
    mer AS (SELECT *, row_number() OVER (ORDER BY merchant_id, valid_from) AS merchant_sk FROM (SELECT 'M' || s_suppkey AS merchant_id, s_name AS merchant_name, 'cat' || (s_nationkey % 4) AS mcc_category, (s_suppkey * 7 + v * 30) % 110 AS risk_score, {_versions_sql("s_suppkey", 2, "1999-01-01")} FROM supplier CROSS JOIN (VALUES (0), (1)) t(v) WHERE v = 0 OR s_suppkey % 2 = 0)),
    pro AS (SELECT code, row_number() OVER (ORDER BY code) AS card_product_sk FROM (SELECT DISTINCT o_orderpriority AS code FROM orders)),
    cur AS (SELECT * FROM (VALUES {", ".join(f"({r[0]}, '{r[1]}', {r[3]})" for r in gold.CURRENCY_ROWS)}) t(currency_sk, currency_code, digits)),
    rea AS (SELECT * FROM (VALUES {", ".join(f"({r[0]}, '{r[1]}', '{r[2]}', '{r[3]}', {str(r[4]).lower()})" for r in gold.REASON_ROWS)}) t(decline_reason_sk, decline_reason_code, decline_reason_desc, decline_category, is_retriable)),
    months AS (SELECT CAST(d AS DATE) AS d, row_number() OVER (ORDER BY d) - 1 AS i FROM range(DATE '1994-06-01', DATE '2001-12-02', INTERVAL 1 MONTH) t(d)),
    fx AS (SELECT *, row_number() OVER (ORDER BY c, d) AS fx_rate_sk, coalesce(lead(d) OVER (PARTITION BY c ORDER BY d) - 1, DATE '9999-12-31') AS until FROM (
        SELECT d, {_LIST(CURRENCIES[1:9])}[k] AS c, CAST((50 + k * 10 + i) / 100.0 AS DECIMAL(12,6)) AS rate FROM months CROSS JOIN range(1, 9) t(k) WHERE (i + k) % 5 <> 0 OR i = 0))"""

FACT_SQL = f"""{DIMS_SQL},
    li AS ({NEWEST_SQL}),
    tx AS (SELECT 'T' || l_orderkey || '-' || l_linenumber AS transaction_id, CASE WHEN l_orderkey % 50 = 1 THEN 'AX' WHEN l_orderkey % 50 <> 0 THEN 'A' || o_custkey END AS account_id, CASE WHEN l_linenumber % 6 <> 0 THEN 'M' || l_suppkey END AS merchant_id, o_orderpriority AS code,
           {_LIST(CURRENCIES)}[(l_orderkey + l_linenumber) % 10 + 1] AS currency_code, CASE WHEN l_returnflag = 'R' THEN {_LIST(REASONS)}[l_linenumber % 6 + 1] END AS decline_reason_code, l_returnflag = 'R' AS no, l_returnflag = 'A' AS rev, l_linestatus = 'F' AND l_returnflag NOT IN ('R', 'A') AS settled,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_minor, CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(l_linenumber AS INT)) AS auth_ts, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS settlement_date,
           CASE WHEN l_linenumber % 6 = 0 THEN 'ATM' WHEN l_linenumber % 3 = 0 THEN 'ECOM' ELSE 'POS' END AS channel, l_tax > 0.04 AS is_3ds, CASE WHEN l_linenumber % 4 = 1 THEN 'APPLE' WHEN l_linenumber % 4 = 2 THEN 'GOOGLE' END AS wallet_type
           FROM li LEFT JOIN orders ON l_orderkey = o_orderkey),
    ft AS (SELECT transaction_id, {_DAY("auth_ts")} AS date_sk, strftime(auth_ts, '%Y-%m') AS ym, coalesce(acc.account_sk, -1) AS account_sk, coalesce(cus.customer_sk, -1) AS customer_sk, coalesce(mer.merchant_sk, -1) AS merchant_sk, coalesce(card_product_sk, -1) AS card_product_sk, coalesce(acc.region, 'UNKNOWN') AS account_region,
           coalesce(cur.currency_sk, -1) AS currency_sk, coalesce(rea.decline_reason_sk, -1) AS decline_reason_sk, CASE WHEN NOT no THEN datediff('day', CAST(auth_ts AS DATE), settlement_date) END AS settlement_lag_days, amount_minor,
           CASE WHEN tx.currency_code = 'GBP' THEN 1 ELSE fx.rate END AS fx_rate, CASE WHEN fx.d IS NOT NULL THEN fx.d < CAST(auth_ts AS DATE) END AS fx_rate_is_carried,
           CAST(round(CAST(amount_minor AS DECIMAL(12,0)) * (CASE WHEN tx.currency_code = 'GBP' THEN CAST(1 AS DECIMAL(12,6)) ELSE fx.rate END) * (CASE digits WHEN 0 THEN CAST(100 AS DECIMAL(3,0)) WHEN 2 THEN CAST(1 AS DECIMAL(3,0)) END), 0) AS BIGINT) AS amount_gbp_minor,
           CAST(NOT no AND NOT rev AS BIGINT) AS is_approved, CAST(no AS BIGINT) AS is_declined, CAST(rev AS BIGINT) AS is_reversed, CAST(settled AS BIGINT) AS is_settled, channel, is_3ds, wallet_type
           FROM tx LEFT JOIN acc ON acc.account_id = tx.account_id AND auth_ts >= acc.valid_from AND auth_ts < acc.valid_to LEFT JOIN cus ON cus.customer_id = acc.customer_id AND auth_ts >= cus.valid_from AND auth_ts < cus.valid_to
           LEFT JOIN mer ON mer.merchant_id = tx.merchant_id AND auth_ts >= mer.valid_from AND auth_ts < mer.valid_to LEFT JOIN pro ON pro.code = tx.code LEFT JOIN cur ON cur.currency_code = tx.currency_code
           LEFT JOIN rea ON rea.decline_reason_code = tx.decline_reason_code LEFT JOIN fx ON fx.c = tx.currency_code AND CAST(auth_ts AS DATE) BETWEEN fx.d AND fx.until),
    dp AS (SELECT 'D' || l_orderkey || '-' || l_linenumber AS dispute_id, 'T' || l_orderkey || '-' || CASE WHEN l_linenumber = 7 THEN 99 ELSE l_linenumber END AS transaction_id, CAST(l_shipdate AS DATE) AS raised, {_LIST(CURRENCIES)}[(l_orderkey + l_linenumber) % 10 + 1] AS currency_code,
           CAST(floor(CAST(round(l_extendedprice * 100) AS BIGINT) / 2) AS BIGINT) AS disputed, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + CAST(l_linenumber * 10 AS INT) END AS resolved, l_linestatus <> 'F' AS open_now, l_linenumber % 3 AS third FROM li WHERE l_returnflag = 'R'),
    fd AS (SELECT dispute_id, {_DAY("raised")} AS raised_date_sk, CASE WHEN resolved IS NULL THEN -1 ELSE {_DAY("resolved")} END AS resolved_date_sk, coalesce(ft.account_sk, -1) AS account_sk, coalesce(ft.merchant_sk, -1) AS merchant_sk, coalesce(cur.currency_sk, -1) AS currency_sk, coalesce(ft.account_region, 'UNKNOWN') AS account_region,
           datediff('day', raised, resolved) AS resolution_days, disputed, CAST(round(CAST(disputed AS DECIMAL(12,0)) * CAST(fx_rate AS DECIMAL(12,6)) * (CASE digits WHEN 0 THEN CAST(100 AS DECIMAL(3,0)) WHEN 2 THEN CAST(1 AS DECIMAL(3,0)) END), 0) AS BIGINT) AS disputed_gbp,
           CAST(open_now AS BIGINT) AS is_open, CAST(NOT open_now AND third = 0 AS BIGINT) AS is_won, CAST(NOT open_now AND third = 1 AS BIGINT) AS is_lost, CAST(NOT open_now AND third = 2 AS BIGINT) AS is_withdrawn
           FROM dp LEFT JOIN ft ON ft.transaction_id = dp.transaction_id LEFT JOIN cur ON cur.currency_code = dp.currency_code),
    ag AS (SELECT coalesce(a.date_sk, b.date_sk) AS date_sk, coalesce(a.merchant_sk, b.merchant_sk) AS merchant_sk, coalesce(n, 0) AS attempt_count, coalesce(ok, 0) AS approved_count, coalesce(no, 0) AS declined_count, coalesce(accounts, 0) AS distinct_account_count, coalesce(v, 0) AS attempted, coalesce(okv, 0) AS approved, coalesce(dn, 0) AS dispute_count, coalesce(dv, 0) AS disputed
           FROM (SELECT date_sk, merchant_sk, count(*) AS n, sum(is_approved) AS ok, sum(is_declined) AS no, count(DISTINCT account_sk) AS accounts, sum(amount_gbp_minor) AS v, sum(CASE WHEN is_approved = 1 THEN amount_gbp_minor ELSE 0 END) AS okv FROM ft GROUP BY 1, 2) a
           FULL JOIN (SELECT raised_date_sk AS date_sk, merchant_sk, count(*) AS dn, sum(disputed_gbp) AS dv FROM fd GROUP BY 1, 2) b ON a.date_sk = b.date_sk AND a.merchant_sk = b.merchant_sk)"""


# ---- gold ----------------------------------------------------------------------------------------------------------


def _longs(df: DataFrame, *names: str) -> list:
    return [big(n).alias(n) for n in names]


@query(f"WITH {DIMS_SQL} SELECT CAST(currency_sk AS BIGINT) AS sk, currency_code AS code, CAST(digits AS BIGINT) AS extra FROM cur UNION ALL SELECT decline_reason_sk, decline_reason_code, CAST(is_retriable AS BIGINT) FROM rea")
def gold_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Currencies and decline reasons with their unknown members."""
    c = gold.dim_currency(spark).select(big("currency_sk").alias("sk"), F.col("currency_code").alias("code"), big("minor_unit_digits").alias("extra"))
    return c.union(gold.dim_decline_reason(spark).select(big("decline_reason_sk"), "decline_reason_code", big("is_retriable")))


@query("""
    WITH span AS (SELECT least(min(CAST(o_orderdate AS DATE)), (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_returnflag = 'R')) AS a, greatest(max(CAST(o_orderdate AS DATE)) + 1, (SELECT max(CAST(l_shipdate AS DATE) + CAST(CASE WHEN l_linestatus = 'F' THEN l_linenumber * 10 ELSE 0 END AS INT)) FROM lineitem WHERE l_returnflag = 'R')) AS b FROM orders),
    days AS (SELECT unnest(range(make_date(year(a), 1, 1), make_date(year(b) + 1, 1, 1), INTERVAL 1 DAY)) AS d FROM span)
    SELECT CAST(year(d) AS BIGINT) AS year_number, CAST(count(*) AS BIGINT) AS days, CAST(sum(CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END) AS BIGINT) AS weekend_days, CAST(sum(CASE WHEN CAST(d AS DATE) = last_day(d) THEN 1 ELSE 0 END) AS BIGINT) AS month_ends FROM days GROUP BY 1
    UNION ALL SELECT 1900, 1, 0, 0
""")
def gold_dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """Whole years around everything the facts have, from the frames themselves."""
    from .operators.calendar import date_range

    tx, dp = silver_transactions(spark, sf), silver_disputes(spark, sf)
    # A line at most seven hours into the day after the last order still falls into its year.
    d = dim_date(spark, *date_range([(tx, "auth_ts"), (dp, "raised_date"), (dp, "resolved_date")]))
    return d.groupBy(big("year_number").alias("year_number")).agg(big(F.count(F.lit(1))).alias("days"), big(F.count_if("is_weekend")).alias("weekend_days"), big(F.count_if("is_month_end")).alias("month_ends"))


@query(f"""
    WITH {DIMS_SQL}, had AS (SELECT code, row_number() OVER (ORDER BY code) AS sk FROM pro WHERE substr(code, 1, 1) < '3')
    SELECT CAST(coalesce(had.sk, (SELECT max(sk) FROM had) + row_number() OVER (PARTITION BY had.sk IS NULL ORDER BY pro.code)) AS BIGINT) AS card_product_sk, pro.code AS card_product_code, upper(pro.code) AS product_name, CAST(CAST(substr(pro.code, 1, 1) AS BIGINT) * 1000 AS BIGINT) AS annual_fee_minor FROM pro LEFT JOIN had ON had.code = pro.code
    UNION ALL SELECT CAST((SELECT max(sk) FROM had) + 0 AS BIGINT) * 0 - 1, 'UNKNOWN', 'Unknown product', 0
""")
def gold_dim_card_product(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes overwritten in place, keys stay, new products get the next."""
    s = silver_products(spark, sf)
    first = s.filter("substring(card_product_code, 1, 1) < '3'").withColumns({"annual_fee_minor": F.lit(1).cast("bigint"), "product_name": F.lit("old")})
    out = gold.dim_card_product(gold.dim_card_product(None, first), s)
    return out.select(big("card_product_sk").alias("card_product_sk"), "card_product_code", "product_name", big("annual_fee_minor").alias("annual_fee_minor"))


_SHOWN = "strftime(valid_from, '%Y-%m-%d') AS valid_from, strftime(valid_to, '%Y-%m-%d') AS valid_to, is_current"


def _span(*more) -> list:
    return [*more, day_text("valid_from").alias("valid_from"), day_text("valid_to").alias("valid_to"), "is_current"]


@query(f"""
    WITH {DIMS_SQL}, keyed AS (SELECT *, CASE WHEN v = 0 THEN row_number() OVER (PARTITION BY v ORDER BY account_id, valid_from) ELSE (SELECT count(*) FROM customer) + row_number() OVER (PARTITION BY v ORDER BY account_id, valid_from) END AS sk FROM acc)
    SELECT CAST(sk AS BIGINT) AS account_sk, account_id, risk_band, CASE WHEN is_current THEN 'ACTIVE' ELSE 'DORMANT' END AS account_status, {_SHOWN} FROM keyed
    UNION ALL SELECT -1, 'UNKNOWN', 'U', 'UNKNOWN', '1900-01-01', '9999-12-31', true
""")
def gold_dim_account(spark: SparkSession, sf: str) -> DataFrame:
    """A load before the second versions came, and one after; closed intervals are brought up to date."""
    s = silver_accounts(spark, sf)
    early = s.filter("v = 0").withColumns({"valid_to": open_ts(), "is_current": F.lit(True), "status": F.lit("ACTIVE")})
    out = gold.versioned_dimension("dim_account", gold.versioned_dimension("dim_account", None, early), s)
    return out.select(*_span(big("account_sk").alias("account_sk"), "account_id", "risk_band", "account_status"))


@query(f"WITH {DIMS_SQL} SELECT CAST(customer_sk AS BIGINT) AS customer_sk, customer_id, CAST(birth_year AS BIGINT) AS birth_year, kyc_status, {_SHOWN} FROM cus UNION ALL SELECT -1, 'UNKNOWN', 1900, 'UNKNOWN', '1900-01-01', '9999-12-31', true")
def gold_dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    """G4."""
    out = gold.versioned_dimension("dim_customer", None, silver_customers(spark, sf))
    return out.select(*_span(big("customer_sk").alias("customer_sk"), "customer_id", big("birth_year").alias("birth_year"), "kyc_status"))


@query(f"""
    WITH {DIMS_SQL} SELECT CAST(merchant_sk AS BIGINT) AS merchant_sk, merchant_id, mcc_category, CAST(risk_score AS BIGINT) AS risk_score, CASE WHEN risk_score < 25 THEN 'LOW' WHEN risk_score < 50 THEN 'MEDIUM' WHEN risk_score < 75 THEN 'HIGH' WHEN risk_score <= 100 THEN 'CRITICAL' ELSE 'UNKNOWN' END AS risk_tier, {_SHOWN} FROM mer
    UNION ALL SELECT -1, 'UNKNOWN', 'Unknown', 0, 'UNKNOWN', '1900-01-01', '9999-12-31', true
""")
def gold_dim_merchant(spark: SparkSession, sf: str) -> DataFrame:
    """G5."""
    out = gold.versioned_dimension("dim_merchant", None, silver_merchants(spark, sf))
    return out.select(*_span(big("merchant_sk").alias("merchant_sk"), "merchant_id", "mcc_category", big("risk_score").alias("risk_score"), "risk_tier"))


@query(f"WITH {DIMS_SQL} SELECT CAST(fx_rate_sk AS BIGINT) AS fx_rate_sk, c AS from_currency, 'GBP' AS to_currency, CAST(rate AS DOUBLE) AS rate, strftime(d, '%Y-%m-%d') AS valid_from_date, strftime(until, '%Y-%m-%d') AS valid_to_date FROM fx")
def gold_dim_fx_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Rebuilt whole; no unknown member and no identity row."""
    r = gold.dim_fx_rate(silver_rates(spark, sf))
    return r.select(big("fx_rate_sk").alias("fx_rate_sk"), "from_currency", "to_currency", F.col("rate").cast("double").alias("rate"), day_text("valid_from_date").alias("valid_from_date"), day_text("valid_to_date").alias("valid_to_date"))


_KEYS = ("date_sk", "account_sk", "customer_sk", "merchant_sk", "card_product_sk", "currency_sk", "decline_reason_sk", "settlement_lag_days", "amount_minor", "amount_gbp_minor", "is_approved", "is_declined", "is_reversed", "is_settled")


@query(f"WITH {FACT_SQL} SELECT transaction_id, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in _KEYS)}, account_region, CAST(fx_rate AS DOUBLE) AS fx_rate, fx_rate_is_carried, channel, is_3ds, wallet_type FROM ft")
def gold_fact_transaction(spark: SparkSession, sf: str) -> DataFrame:
    """All keys, money, flags; nothing is dropped."""
    f = star(spark, sf)["fact_transaction"]
    return f.select("transaction_id", *_longs(f, *_KEYS), "account_region", F.col("fx_rate").cast("double").alias("fx_rate"), "fx_rate_is_carried", "channel", "is_3ds", "wallet_type")


_DISPUTE = ("raised_date_sk", "resolved_date_sk", "account_sk", "merchant_sk", "currency_sk", "resolution_days", "is_open", "is_won", "is_lost", "is_withdrawn")


@query(f"WITH {FACT_SQL} SELECT dispute_id, {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in _DISPUTE)}, account_region, CAST(disputed AS BIGINT) AS disputed_amount_minor, CAST(disputed_gbp AS BIGINT) AS disputed_amount_gbp_minor FROM fd")
def gold_fact_dispute(spark: SparkSession, sf: str) -> DataFrame:
    """Keys, region and rate of the disputed transaction."""
    f = star(spark, sf)["fact_dispute"]
    return f.select("dispute_id", *_longs(f, *_DISPUTE), "account_region", *_longs(f, "disputed_amount_minor", "disputed_amount_gbp_minor"))


_AGG = {"attempt_count": "attempt_count", "approved_count": "approved_count", "declined_count": "declined_count", "distinct_account_count": "distinct_account_count", "attempted_amount_gbp_minor": "attempted", "approved_amount_gbp_minor": "approved", "dispute_count": "dispute_count", "disputed_amount_gbp_minor": "disputed"}


@query(f"WITH {FACT_SQL} SELECT CAST(date_sk AS BIGINT) AS date_sk, CAST(merchant_sk AS BIGINT) AS merchant_sk, {', '.join(f'CAST({c} AS BIGINT) AS {n}' for n, c in _AGG.items())} FROM ag")
def gold_agg_merchant_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Attempts and disputes by merchant and day."""
    a = star(spark, sf)["agg_merchant_daily"]
    return a.select(*_longs(a, "date_sk", "merchant_sk", *_AGG))


@query(f"""
    WITH {FACT_SQL}, odd AS (SELECT dispute_id FROM fd WHERE CAST(split_part(substr(dispute_id, 2), '-', 1) AS BIGINT) % 2 = 1)
    SELECT CASE WHEN CAST(split_part(substr(transaction_id, 2), '-', 1) AS BIGINT) % 2 = 1 THEN 'b2' ELSE 'b1' END AS load_batch_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(amount_gbp_minor) AS BIGINT) AS amount, 'fact_transaction' AS table_name FROM ft GROUP BY 1
    UNION ALL SELECT CASE WHEN odd.dispute_id IS NULL THEN 'b1' ELSE 'b2' END, count(*), CAST(sum(disputed_gbp) AS BIGINT), 'fact_dispute' FROM fd LEFT JOIN odd ON odd.dispute_id = fd.dispute_id GROUP BY 1
    UNION ALL SELECT 'all', CAST(sum(attempt_count) AS BIGINT), CAST(sum(attempted) AS BIGINT), 'agg_merchant_daily' FROM ag
""")
def gold_load_staged(spark: SparkSession, sf: str) -> DataFrame:
    """A whole load, then one of a batch alone; facts that it doesn't name keep the batch that loaded
    them, and the aggregate's touched days are computed anew."""
    store = _store(spark)
    made = {"dim_card_product": silver_products, "dim_account": silver_accounts, "dim_customer": silver_customers, "dim_merchant": silver_merchants, "dim_fx_rate": silver_rates}
    for n, f in made.items():
        store.write(f(spark, sf).drop("v"), "silver", n, "overwrite")
    store.write(silver_transactions(spark, sf), "silver", "fact_transaction", "overwrite")
    store.write(silver_disputes(spark, sf), "silver", "fact_dispute", "overwrite")
    odd = lambda c: F.split_part(F.substring(c, 2, 99), F.lit("-"), F.lit(1)).cast("bigint") % 2 == 1
    tx, dp = store.read("silver", "fact_transaction"), store.read("silver", "fact_dispute")
    gold.load(store, "b1", {"fact_transaction": tx.filter(~odd("transaction_id")), "fact_dispute": dp.filter(~odd("dispute_id"))})
    gold.load(store, "b2", {"fact_transaction": tx.filter(odd("transaction_id")), "fact_dispute": dp.filter(odd("dispute_id"))})
    total = lambda t, by, n, v: store.read("gold", t).groupBy(by).agg(big(n).alias("n"), big(F.sum(v)).alias("amount")).withColumn("table_name", F.lit(t))
    one = F.count(F.lit(1))
    out = total("fact_transaction", "load_batch_id", one, "amount_gbp_minor").unionByName(total("fact_dispute", "load_batch_id", one, "disputed_amount_gbp_minor"))
    return out.unionByName(total("agg_merchant_daily", F.lit("all").alias("load_batch_id"), F.sum("attempt_count"), "attempted_amount_gbp_minor"))


# ---- the report ------------------------------------------------------------------------------------------------------


@query(f"""
    WITH {FACT_SQL} SELECT CAST(count(*) AS BIGINT) AS attempts, CAST(sum(is_approved) AS BIGINT) AS approved, CAST(sum(is_declined) AS BIGINT) AS declined, CAST(sum(is_reversed) AS BIGINT) AS reversed, CAST(sum(is_settled) AS BIGINT) AS settled, CAST(sum(amount_gbp_minor) AS BIGINT) AS attempted_gbp_minor,
    CAST(sum(amount_gbp_minor) FILTER (WHERE is_approved = 1) AS BIGINT) AS approved_gbp_minor, round(avg(settlement_lag_days), 6) AS avg_settlement_lag, CAST(count(*) FILTER (WHERE fx_rate_is_carried) AS BIGINT) AS fx_carried FROM ft
""")
def report_totals(spark: SparkSession, sf: str) -> DataFrame:
    """O2: the report's headline figures."""
    return report.totals(star(spark, sf)).withColumn("avg_settlement_lag", F.round("avg_settlement_lag", 6))


@query(f"WITH {FACT_SQL} SELECT decline_reason_code, decline_reason_desc, decline_category, is_retriable, CAST(count(*) AS BIGINT) AS declines FROM ft JOIN rea ON rea.decline_reason_sk = ft.decline_reason_sk WHERE is_declined = 1 GROUP BY 1, 2, 3, 4")
def report_declines_by_reason(spark: SparkSession, sf: str) -> DataFrame:
    return report.declines_by_reason(star(spark, sf))


@query(f"WITH {FACT_SQL} SELECT channel, CAST(count(*) AS BIGINT) AS attempts, CAST(sum(is_declined) AS BIGINT) AS declined FROM ft GROUP BY 1")
def report_by_channel(spark: SparkSession, sf: str) -> DataFrame:
    return report.by_channel(star(spark, sf))


@query(f"WITH {FACT_SQL} SELECT is_3ds, CAST(count(*) AS BIGINT) AS attempts, CAST(sum(is_approved) AS BIGINT) AS approved FROM ft WHERE channel = 'ECOM' GROUP BY 1")
def report_three_ds(spark: SparkSession, sf: str) -> DataFrame:
    return report.three_ds(star(spark, sf))


@query(f"WITH {FACT_SQL} SELECT coalesce(wallet_type, '(not recorded)') AS wallet, CAST(count(*) AS BIGINT) AS attempts, CAST(sum(is_approved) AS BIGINT) AS approved FROM ft GROUP BY 1")
def report_wallets(spark: SparkSession, sf: str) -> DataFrame:
    return report.wallets(star(spark, sf))


@query(f"WITH {FACT_SQL} SELECT ym AS year_month, CAST(count(*) AS BIGINT) AS attempts, CAST(sum(is_approved) AS BIGINT) AS approved, CAST(sum(is_declined) AS BIGINT) AS declined, CAST(sum(amount_gbp_minor) AS BIGINT) AS attempted_gbp_minor FROM ft GROUP BY 1")
def report_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return report.monthly(star(spark, sf))


@query(f"""
    WITH {FACT_SQL}, named AS (SELECT merchant_sk, merchant_id, merchant_name, mcc_category FROM mer UNION ALL SELECT -1, 'UNKNOWN', 'Unknown merchant', 'Unknown')
    SELECT n.merchant_id, max(merchant_name) AS merchant_name, max(mcc_category) AS mcc_category, CAST(count(*) AS BIGINT) AS attempts, CAST(sum(is_approved) AS BIGINT) AS approved, CAST(sum(amount_gbp_minor) AS BIGINT) AS attempted_gbp_minor FROM ft JOIN named n ON n.merchant_sk = ft.merchant_sk GROUP BY 1 ORDER BY attempted_gbp_minor DESC, merchant_id LIMIT 10
""")
def report_top_merchants(spark: SparkSession, sf: str) -> DataFrame:
    """O1, O4."""
    return report.top_merchants(star(spark, sf))


@query(f"""
    WITH {FACT_SQL} SELECT CAST(count(*) AS BIGINT) AS raised, CAST(sum(is_open) AS BIGINT) AS open_now, CAST(sum(is_won) AS BIGINT) AS won, CAST(sum(is_lost) AS BIGINT) AS lost, CAST(sum(disputed_gbp) AS BIGINT) AS disputed_gbp_minor, CAST(count(*) FILTER (WHERE is_open = 0) AS BIGINT) AS resolved, round(avg(resolution_days) FILTER (WHERE is_open = 0), 6) AS resolution_days FROM fd
""")
def report_disputes(spark: SparkSession, sf: str) -> DataFrame:
    return report.disputes(star(spark, sf)).withColumn("resolution_days", F.round("resolution_days", 6))


@query(f"""
    WITH {DIMS_SQL} SELECT CAST((SELECT count(DISTINCT account_id) + 1 FROM acc WHERE is_current) AS BIGINT) AS accounts, CAST((SELECT count(DISTINCT customer_id) + 1 FROM cus WHERE is_current) AS BIGINT) AS customers, CAST((SELECT count(DISTINCT merchant_id) + 1 FROM mer WHERE is_current) AS BIGINT) AS merchants,
    round((SELECT CAST(sum(risk_score) AS DOUBLE) / (count(*) + 1) FROM mer WHERE is_current), 6) AS risk_score
""")
def report_current_members(spark: SparkSession, sf: str) -> DataFrame:
    """The unknown members count as current, as they do in the report."""
    got = report.current_members(star(spark, sf))
    return got.select(*_longs(got, "accounts", "customers", "merchants"), F.round("risk_score", 6).alias("risk_score"))


@query(f"WITH {FACT_SQL} SELECT CAST(count(DISTINCT coalesce(a.account_id, 'UNKNOWN')) AS BIGINT) AS accounts FROM ft LEFT JOIN acc a ON a.account_sk = ft.account_sk")
def report_transacting_accounts(spark: SparkSession, sf: str) -> DataFrame:
    got = report.transacting_accounts(star(spark, sf))
    return got.select(*_longs(got, "accounts"))


@query(f"WITH {FACT_SQL} SELECT CAST(sum(attempt_count) AS BIGINT) AS attempt_count, CAST(sum(approved_count) AS BIGINT) AS approved_count, CAST(sum(attempted) AS BIGINT) AS attempted_amount_gbp_minor, CAST(sum(distinct_account_count) AS BIGINT) AS distinct_account_count FROM ag")
def report_aggregate_totals(spark: SparkSession, sf: str) -> DataFrame:
    return report.aggregate_totals(star(spark, sf))


@query("SELECT true AS is_document, CAST(0 AS BIGINT) AS outside_references, CAST(12 AS BIGINT) AS tiles, CAST(4 AS BIGINT) AS charts")
def report_page(spark: SparkSession, sf: str) -> DataFrame:
    """One page that stands alone."""
    d = star(spark, sf)
    text = report.page({n: f.persist() if n.startswith("fact") else f for n, f in d.items()})
    for n in ("fact_transaction", "fact_dispute"):
        d[n].unpersist()
    row = (text.startswith("<!doctype html>"), sum(text.count(x) for x in ("http://", "https://", "src=", "@import")), text.count("<div class=t>"), text.count("<svg"))
    return spark.createDataFrame([row], "is_document boolean, outside_references bigint, tiles bigint, charts bigint")


# ---- sources, store and upkeep ---------------------------------------------------------------------------------------


@query("""
    SELECT f AS source_format, strftime(y, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS amount, true AS from_its_folder
    FROM (SELECT *, date_trunc('year', o_orderdate) AS y FROM orders) CROSS JOIN (VALUES ('csv'), ('json'), ('parquet')) t(f) WHERE y >= DATE '1996-01-01' GROUP BY 1, 2
""")
def landing_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """Three formats out and in; partitions from folder names; the file each row came from."""
    landing, out = Landing(spark, workspace(spark)), None
    o = read(spark, sf, "orders").select("o_orderkey", cents("o_totalprice").alias("amount"), F.date_trunc("year", "o_orderdate").cast("date").alias("ingest_date"))
    for kind in ("csv", "json", "parquet"):
        landing.write(o, f"orders_{kind}", kind)
        wanted = [p for p in landing.partitions(f"orders_{kind}") if p >= "1996-01-01"]
        got = landing.read({"entity": f"orders_{kind}", "source_format": kind, "read_options": '{"header": "true"}' if kind == "csv" else ""}, wanted)
        got = got.withColumn("at", F.regexp_extract(F.col("_metadata.file_path"), "ingest_date(?:=|%3D)([0-9-]+)", 1))
        g = got.groupBy(F.lit(kind).alias("source_format"), day_text("ingest_date").alias("day")).agg(big(F.count(F.lit(1))).alias("n"), big(F.sum(F.col("amount").cast("bigint"))).alias("amount"), F.every(F.col("at") == day_text("ingest_date")).alias("from_its_folder"))
        out = g if out is None else out.unionByName(g)
    return out


@query("""
    SELECT 'live' AS state, o_orderstatus AS status, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END) AS BIGINT) AS marks FROM orders GROUP BY 2
    UNION ALL SELECT 'before', o_orderstatus, count(*), count(*) FROM orders GROUP BY 2
""")
def bronze_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Batches are appended under their tags; one that comes again replaces its own rows; the version
    before stays readable."""
    store, o = _store(spark), read(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.lit(1).alias("mark"))
    tags = sorted(r["status"] for r in o.select("status").distinct().collect())
    for t in tags:
        store.write(o.filter(F.col("status") == t), "bronze", "br_orders", "replace_tag", tag=t)
    before = store.version("bronze", "br_orders")
    store.write(o.filter("status = 'F'").withColumn("mark", F.lit(2)), "bronze", "br_orders", "replace_tag", tag="F")
    assert store.exists("bronze", "br_orders") and store.list_tables("bronze") == ["br_orders"]
    total = lambda df, state: df.groupBy(F.lit(state).alias("state"), "status").agg(big(F.count(F.lit(1))).alias("n"), big(F.sum("mark")).alias("marks"))
    return total(store.read("bronze", "br_orders"), "live").unionByName(total(store.read("bronze", "br_orders", before), "before"))


@query("SELECT c_custkey AS k, upper(c_name) AS name, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer")
def store_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """An overwrite replaces rows and schema."""
    store, c = _store(spark), read(spark, sf, "customer")
    store.write(c.select("c_custkey"), "silver", "t", "overwrite")
    store.write(c.select(F.col("c_custkey").alias("k"), F.upper("c_name").alias("name"), cents("c_acctbal").alias("balance")), "silver", "t", "overwrite")
    return store.read("silver", "t")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, true AS some_files_kept FROM orders UNION ALL SELECT CAST(-1 AS BIGINT), 'new', true")
def store_merge(spark: SparkSession, sf: str) -> DataFrame:
    """M3, M4, M8 in the store: files without affected rows stay as they are; every 1000th order changes, one is new."""
    store, o = _store(spark), read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    store.write(o.repartitionByRange(8, "o_orderkey"), "silver", "o", "overwrite")
    edge = o.agg(F.max("o_orderkey")).first()[0]
    changed = lambda t, low, high: F.col("o_orderkey").between(low, high) & (F.col("o_orderkey") % 1000 == 0)
    kept = False
    for low, high in ((0, edge // 2), (edge // 2 + 1, edge)):  # two batches, each in its half of the keys
        new = spark.createDataFrame([(-1, "new")], o.schema)
        change = lambda t, low=low, high=high, new=new: t.withColumn("o_orderstatus", F.when(changed(t, low, high), "X").otherwise(F.col("o_orderstatus"))).unionByName(new.filter(F.lit(low == 0)))
        kept = store.merge("silver", "o", lambda t, low=low, high=high: t.filter(changed(t, low, high)), change)["files_kept"] > 0 or kept
    return store.read("silver", "o").withColumn("some_files_kept", F.lit(kept))


@query("SELECT CAST(count(*) AS BIGINT) AS rows_before, CAST(count(*) AS BIGINT) AS rows_after, CAST(4 AS BIGINT) AS parts, true AS compacted, true AS stale_files_went, CAST(2 AS BIGINT) AS logged, true AS advised FROM supplier")
def store_upkeep(spark: SparkSession, sf: str) -> DataFrame:
    """Footprint, compaction, clean-up, and the advice on small partitions."""
    store, s = _store(spark), read(spark, sf, "supplier").select("s_suppkey", (F.col("s_suppkey") % 4).alias("p"))
    for i in range(4):
        store.write(s.filter(F.col("p") == i).repartition(2), "silver", "s", "append")
    before = store.footprint("silver", "s")
    parts = len(store.manifest("silver", "s")["parts"])
    done = maintenance.maintain(store, ["silver"], control.new_run_id(), retain_hours=0)
    after = store.footprint("silver", "s")
    logged = store.read("meta", "maintenance_log").count()
    small = type(after)(10, 4, 4000, 4, 4000, ["p"])
    row = (before.rows, store.read("silver", "s").count(), parts, any(a.files_compacted > 0 for a in done), after.stale_ratio == 1.0 < before.files, logged, bool(maintenance.advise(small, 0)) and not maintenance.advise(small, 1))
    return spark.createDataFrame([row], "rows_before bigint, rows_after bigint, parts bigint, compacted boolean, stale_files_went boolean, logged bigint, advised boolean")


# ---- windows, control, configuration -----------------------------------------------------------------------------------

WINDOWS = (("all", "incremental_watermark", None, "", False, None), ("beyond", "incremental_watermark", "1996-06-01", "", False, None), ("until", "full_snapshot", "1996-06-01", "1998-01-01", False, None), ("forced", "incremental_watermark", "1996-06-01", "1998-01-01", True, None), ("restated", "incremental_watermark", "1998-01-01", "", False, 90), ("static", "static", "1998-01-01", "", False, None))


@query("""
    WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders),
    w AS (SELECT 'all' AS case_name, 'bronze' AS layer, d FROM m UNION ALL SELECT 'beyond', 'bronze', d FROM m WHERE d > DATE '1996-06-01' UNION ALL SELECT 'until', 'bronze', d FROM m WHERE d > DATE '1996-06-01' AND d <= DATE '1998-01-01' UNION ALL SELECT 'forced', 'bronze', d FROM m WHERE d <= DATE '1998-01-01'
        UNION ALL SELECT 'restated', 'bronze', d FROM m WHERE d > DATE '1998-01-01' UNION ALL SELECT 'static', 'bronze', d FROM m WHERE d > DATE '1998-01-01'
        UNION ALL SELECT 'all', 'silver', d FROM m UNION ALL SELECT 'beyond', 'silver', d FROM m WHERE d > DATE '1996-06-01' UNION ALL SELECT 'until', 'silver', d FROM m WHERE d > DATE '1996-06-01' AND d <= DATE '1998-01-01' UNION ALL SELECT 'forced', 'silver', d FROM m WHERE d <= DATE '1998-01-01'
        UNION ALL SELECT 'restated', 'silver', d FROM m WHERE d >= DATE '1998-01-01' - INTERVAL 90 DAY UNION ALL SELECT 'static', 'silver', d FROM m)
    SELECT case_name, layer, CAST(count(*) AS BIGINT) AS dates, 'orders|' || min(d) || '|' || max(d) AS batch_id, CAST(CASE WHEN case_name = 'until' THEN count(*) ELSE 1 END AS BIGINT) AS batches, CAST(sum(n) AS BIGINT) AS n
    FROM w JOIN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS om, count(*) AS n FROM orders GROUP BY 1) ON om = d GROUP BY 1, 2
""")
def windows(spark: SparkSession, sf: str) -> DataFrame:
    """Which arrival dates each layer reads, their batch ids, and the rows those dates hold."""
    o = read(spark, sf, "orders").select(F.date_trunc("month", "o_orderdate").cast("date").alias("ingest_date"))
    dates, out = [r["d"] for r in o.select(day_text("ingest_date").alias("d")).distinct().collect()], None
    for name, load, mark, until, force, back in WINDOWS:
        c = {"entity": "orders", "load_type": load, "reprocess_window_days": back, "scd_type": 2 if load == "full_snapshot" else 0}
        for layer, found in (("bronze", ingest.select_window(c, dates, mark, until, force)), ("silver", ingest.select_scope(c, dates, mark, until, force))):
            row = [F.lit(name).alias("case_name"), F.lit(layer).alias("layer"), big(F.lit(len(found))).alias("dates"), F.lit(ingest.derive_batch_id("orders", found)).alias("batch_id"), big(F.lit(len(ingest.batches(c, found)))).alias("batches"), big(F.count(F.lit(1))).alias("n")]
            got = project.in_window(o, found).agg(*row)
            out = got if out is None else out.unionByName(got)
    return out


@query("""
    SELECT r_name AS entity, 'silver' AS layer, '2024-01-0' || (r_regionkey + 1) AS watermark_value, 'second' AS last_batch_id, true AS is_stamped FROM region WHERE r_name <> 'ASIA' UNION ALL SELECT r_name, 'bronze', '2023-12-31', 'first', true FROM region WHERE r_name NOT IN ('ASIA', 'EUROPE')
""")
def watermarks(spark: SparkSession, sf: str) -> DataFrame:
    """Set, set again, and forgotten by feed and layer."""
    store = _store(spark)
    rows = [(r["r_name"], r["r_regionkey"]) for r in read(spark, sf, "region").collect()]
    for name, k in rows:
        control.set_watermark(store, name, "bronze", "2023-12-31", "first")
        control.set_watermark(store, name, "silver", "2023-12-31", "first")
        control.set_watermark(store, name, "silver", f"2024-01-0{k + 1}", "second")
    control.reset_watermark(store, "ASIA")
    control.reset_watermark(store, "EUROPE", "bronze")
    assert control.get_watermark(store, "AFRICA") == "2023-12-31" and control.get_watermark(store, "ASIA") is None
    return store.read("meta", "watermark").select("entity", "layer", "watermark_value", "last_batch_id", F.col("updated_ts").isNotNull().alias("is_stamped"))


@query("""
    WITH f AS (SELECT r_name, r_regionkey % 3 AS wave, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS n, r_name = 'AMERICA' AS fails FROM region)
    SELECT r_name AS entity, CAST(wave AS BIGINT) AS priority, CASE WHEN wave > (SELECT min(wave) FROM f WHERE fails) THEN 'not_run' WHEN fails THEN 'failed' ELSE 'succeeded' END AS outcome, CAST(CASE WHEN wave > (SELECT min(wave) FROM f WHERE fails) THEN 0 WHEN fails THEN 2 ELSE 1 END AS BIGINT) AS attempts,
           CASE WHEN wave > (SELECT min(wave) FROM f WHERE fails) THEN 'unknown' WHEN fails THEN 'failed' ELSE 'succeeded' END AS logged, CAST(CASE WHEN fails OR wave > (SELECT min(wave) FROM f WHERE fails) THEN 0 ELSE n END AS BIGINT) AS rows_written, CAST(CASE WHEN wave > (SELECT min(wave) FROM f WHERE fails) THEN 0 WHEN fails THEN 2 ELSE 1 END AS BIGINT) AS log_rows FROM f
""")
def run_waves(spark: SparkSession, sf: str) -> DataFrame:
    """Waves by priority, a second try, the log of every step, and what was sent out but never
    logged."""
    store, run = _store(spark), control.new_run_id()
    size = {r["n_regionkey"]: r["count"] for r in read(spark, sf, "nation").groupBy("n_regionkey").count().collect()}
    feeds = [{"entity": r["r_name"], "priority": r["r_regionkey"] % 3, "enabled": True, "n": size.get(r["r_regionkey"], 0)} for r in read(spark, sf, "region").collect()]

    def load(c: dict) -> int:
        with control.step(store, run, c["entity"], "bronze", "ingest") as s:
            if c["entity"] == "AMERICA":
                raise ValueError("broken feed")
            s.rows_written = c["n"]
            return c["n"]

    done = {o.entity: o for o in runner.run_stage(load, feeds, retries=1, wait=0.0)}
    found = runner.reconcile(store, run, [(c["entity"], "bronze") for c in feeds])
    logs = {r["entity"]: r["count"] for r in store.read("meta", "run_log").groupBy("entity").count().collect()}
    rows = [(c["entity"], c["priority"], done[c["entity"]].status, done[c["entity"]].attempts, found[(c["entity"], "bronze")], done[c["entity"]].rows, logs.get(c["entity"], 0)) for c in feeds]
    return spark.createDataFrame(rows, "entity string, priority bigint, outcome string, attempts bigint, logged string, rows_written bigint, log_rows bigint")


@query("SELECT o_orderkey, 'orders|a|b' AS _batch_id, true AS same_hash, o_orderkey % 2 = 0 AS hash_moved, CAST(3 AS BIGINT) AS business_columns, CAST(2 AS BIGINT) AS payload_columns FROM orders")
def audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The row hash is that of the business columns, whatever their order; it moves when one of them does."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", F.lit("2024-01-01").cast("date").alias("ingest_date"))
    one = project.add_audit_columns(o, "orders|a|b", source=False)
    two = project.add_audit_columns(o.select("ingest_date", "o_custkey", "o_orderstatus", "o_orderkey"), "x", source=False)
    other = project.add_audit_columns(o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, "?").otherwise(F.col("o_orderstatus"))), "x", source=False)
    counts = (len(project.business_columns(o)), len(project.payload_columns(one, "o_orderkey")))
    pairs = one.join(two.select(F.col("o_orderkey").alias("k2"), F.col("_row_hash").alias("h2")), F.col("o_orderkey") == F.col("k2")).join(other.select(F.col("o_orderkey").alias("k3"), F.col("_row_hash").alias("h3")), F.col("o_orderkey") == F.col("k3"))
    return pairs.select("o_orderkey", "_batch_id", (F.col("_row_hash") == F.col("h2")).alias("same_hash"), (F.col("_row_hash") != F.col("h3")).alias("hash_moved"), *[big(F.lit(n)).alias(c) for c, n in zip(("business_columns", "payload_columns"), counts, strict=True)])


@query("SELECT CAST(count(*) AS BIGINT) AS n, true AS same_in_any_order, true AS moves_with_a_value, true AS moves_with_a_row FROM orders")
def checksums(spark: SparkSession, sf: str) -> DataFrame:
    """A table's checksum, by its properties."""
    o = read(spark, sf, "orders")
    of = lambda df: df.agg(content_checksum(o.columns).alias("c")).first()["c"]
    low = o.agg(F.min("o_orderkey")).first()[0]
    whole, n = of(o), o.count()
    row = (n, whole == of(o.repartition(5).orderBy("o_totalprice").select(*reversed(o.columns))), whole != of(o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") == low, "?").otherwise(F.col("o_orderstatus")))), whole != of(o.filter(F.col("o_orderkey") != low)))
    return spark.createDataFrame([row], "n bigint, same_in_any_order boolean, moves_with_a_value boolean, moves_with_a_row boolean")


@query("SELECT CAST(count(*) AS BIGINT) AS n, true AS in_range, true AS repeatable, true AS salted, true AS fair_buckets, true AS fair_weights, true AS fair_chance FROM events")
def draws(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-ins for randomness are repeatable, depend on the salt, and are as likely as they should be."""
    e = read(spark, sf, "events").select("event_id")
    cols = lambda salt: {"b": bucket(7, salt, 10, F.col("event_id")), "u": uniform(7, salt, F.col("event_id")), "w": weighted_pick(7, salt, [("a", 3), ("b", 1)], F.col("event_id")), "p": pick(7, salt, ["x", "y"], F.col("event_id")), "c": chance(7, salt, 0.3, F.col("event_id"))}
    one = e.withColumns(cols("s"))
    same = one.join(e.repartition(3).withColumns(cols("s")).withColumnsRenamed({c: f"{c}2" for c in "buwpc"}), "event_id").agg(F.every((F.col("b") == F.col("b2")) & (F.col("u") == F.col("u2")) & (F.col("w") == F.col("w2")) & (F.col("p") == F.col("p2")) & (F.col("c") == F.col("c2")))).first()[0]
    moved = one.join(e.withColumns(cols("t")).select("event_id", F.col("b").alias("b3")), "event_id").agg(F.count_if(F.col("b") != F.col("b3"))).first()[0]
    r = one.agg(F.count(F.lit(1)).alias("n"), F.every(F.col("b").between(0, 9) & (F.col("u") >= 0) & (F.col("u") < 1)).alias("ok"), F.count_if(F.col("w") == "a").alias("a"), F.count_if(F.col("c")).alias("c")).first()
    per = [x["count"] for x in one.groupBy("b").count().collect()]
    near = lambda got, want: abs(got - want) < 6 * (want + 1) ** 0.5
    row = (r["n"], r["ok"], same, moved > r["n"] / 2, len(per) == 10 and all(near(x, r["n"] / 10) for x in per), near(r["a"], 0.75 * r["n"]), near(r["c"], 0.3 * r["n"]))
    return spark.createDataFrame([row], "n bigint, in_range boolean, repeatable boolean, salted boolean, fair_buckets boolean, fair_weights boolean, fair_chance boolean")


_TYPES = (("varchar(20)", "varchar(20)"), ("varchar", "string"), ("char(2)", "varchar(2)"), ("decimal(18,8)", "decimal(18,8)"), ("numeric", "decimal(18,0)"), ("bit", "boolean"), ("smallint", "smallint"), ("int", "int"), ("bigint", "bigint"), ("date", "date"), ("datetime2(6)", "timestamp"), ("float", "double"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _TYPES) + ") t(warehouse, spark_type)")
def type_map(spark: SparkSession, sf: str) -> DataFrame:
    """F16."""
    return spark.createDataFrame([(a, warehouse_type(a)) for a, _ in _TYPES], "warehouse string, spark_type string")


@query("SELECT * FROM (VALUES ('from_command', 'a'), ('from_command_with_equals', 'b'), ('from_environment', 'c'), ('from_default', 'd'), ('command_wins', 'e')) t(case_name, value)")
def parameters(spark: SparkSession, sf: str) -> DataFrame:
    """C11: command line, environment, default."""
    of = lambda argv, env: config.resolve("until_date", "d", argv, env)
    rows = [("from_command", of(["--until-date", "a"], {})), ("from_command_with_equals", of(["--until-date=b"], {})), ("from_environment", of([], {"MARLSTONE_UNTIL_DATE": "c"})), ("from_default", of([], {})), ("command_wins", of(["--until-date", "e"], {"MARLSTONE_UNTIL_DATE": "c"}))]
    return spark.createDataFrame(rows, "case_name string, value string")


@query("""
    SELECT * FROM (VALUES ('accounts', 'account_id,_change_ts', 'dim_account', CAST(10 AS BIGINT), 'true'), ('card_products', 'card_product_code', 'dim_card_product', 5, 'true'), ('customers', 'customer_id', 'dim_customer', 10, 'true'), ('disputes', 'dispute_id', 'fact_dispute', 30, NULL),
    ('fx_rates', 'rate_date,from_currency', 'dim_fx_rate', 5, 'true'), ('merchants', 'merchant_id', 'dim_merchant', 10, NULL), ('transactions', 'transaction_id', 'fact_transaction', 20, NULL)) t(entity, grain, target_table, priority, header)
""")
def feed_configuration(spark: SparkSession, sf: str) -> DataFrame:
    """The feeds as a table, their options as JSON, and the grain that each is deduplicated to."""
    feeds = config.feed_configs()
    grains = spark.createDataFrame([(c["entity"], ",".join(dedupe_grain(config.config_for(feeds, c["entity"])))) for c in feeds], "entity string, grain string")
    return config.config_frame(spark, feeds).join(grains, "entity").select("entity", "grain", "target_table", big("priority").alias("priority"), F.get_json_object("read_options", "$.header").alias("header"))


_BAD = (("repeated id", 2), ("unknown rule set", 1), ("can't be configured", 1), ("an error has no threshold", 1), ("lacks", 1), ("range needs", 1), ("has no rules", 1))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a.replace(chr(39), chr(39) * 2)}', CAST({n} AS BIGINT))" for a, n in _BAD) + ") t(finding, n) UNION ALL SELECT 'configured rules', CAST(0 AS BIGINT) UNION ALL SELECT 'round trip', CAST(0 AS BIGINT) UNION ALL SELECT 'empty set', CAST(1 AS BIGINT) UNION ALL SELECT 'missing column', CAST(1 AS BIGINT)")
def rule_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Q13, Q14, Q15: what is wrong with a rule table, a set without rules, a column that isn't there."""
    r = quality.Rule
    bad = [
        r("a", "s", "c", "not_null"), r("a", "s", "c", "not_null"), r("a", "s", "c", "not_null"), r("b", "x", "c", "not_null"), r("c", "s", "c", "castable"),
        r("d", "s", "c", "not_null", severity="error", threshold=1.0), r("e", "s", "c", "enum_domain"), r("f", "s", "c", "range"),
    ]
    found = quality.validate_rules(bad, {"s", "t"})
    rules = config.quality_rules()
    raised = lambda call: int(_raises(call))
    rows = [(a, sum(a in f for f in found)) for a, _ in _BAD]
    rows += [("configured rules", len(quality.validate_rules(rules, {x.rule_set for x in rules}))), ("round trip", len({repr(x) for x in rules} ^ {repr(x) for x in config.rules_from(config.rules_frame(spark, rules))}))]
    rows += [("empty set", raised(lambda: quality.rules_for(rules, "nothing"))), ("missing column", raised(lambda: quality.flagged(read(spark, sf, "region"), [r("a", "s", "absent", "not_null")])))]
    return spark.createDataFrame(rows, "finding string, n bigint")


def _raises(call) -> bool:
    try:
        call()
    except quality.QualityFailure:
        return True
    return False


@query("""
    WITH o AS (SELECT o_orderstatus = 'P' AS a, o_totalprice > 300000 AS b, o_custkey % 11 = 0 AS c FROM orders)
    SELECT 'orders.price' AS rule_id, 'warn' AS severity, CAST(count(*) AS BIGINT) AS evaluated, CAST(count(*) FILTER (WHERE b) AS BIGINT) AS failed, CASE WHEN count(*) FILTER (WHERE b) = 0 THEN 'passed' ELSE 'quarantined' END AS outcome, CAST(count(*) FILTER (WHERE b) AS BIGINT) AS quarantined, true AS run_failed FROM o
    UNION ALL SELECT 'orders.status', 'error', count(*), count(*) FILTER (WHERE a), 'failed_run', count(*) FILTER (WHERE a), true FROM o
    UNION ALL SELECT 'orders.customer', 'warn', count(*) FILTER (WHERE NOT a), count(*) FILTER (WHERE c AND NOT a), 'quarantined', count(*) FILTER (WHERE c AND NOT a), true FROM o
""")
def gate_and_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Q11, Q12, P10: results and rejected rows are written before the run fails."""
    store, run, r = _store(spark), control.new_run_id(), quality.Rule
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    rules = [
        r("orders.status", "orders", "o_orderstatus", "enum_domain", {"values": ["O", "F"]}, severity="error"), r("orders.price", "orders", "o_totalprice", "range", {"max": 300000}),
        r("orders.customer", "orders", None, "expression", {"predicate": "o_custkey % 11 <> 0"}, condition="o_orderstatus <> 'P'"),
    ]
    gate = quality.gate(o, rules, batch_id="orders|a|2001-01-01")
    control.record_results(store, run, "b", "orders", gate)
    control.quarantine(store, run, "b", "orders", gate)
    failed = _raises(lambda: gate.raise_if_failed("orders"))
    gate.release()
    held = store.read("quarantine", "q_orders").select(F.explode("_dq_rule_ids").alias("rule_id")).groupBy("rule_id").agg(big(F.count(F.lit(1))).alias("quarantined"))
    got = store.read("meta", "dq_results").join(held, "rule_id", "left")
    return got.select("rule_id", "severity", big("rows_evaluated").alias("evaluated"), big("rows_failed").alias("failed"), "outcome", F.coalesce("quarantined", F.lit(0).cast("bigint")).alias("quarantined"), F.lit(failed).alias("run_failed"))


@query("""
    WITH b AS (SELECT o_orderkey, o_orderstatus, o_custkey FROM orders)
    SELECT 'fact' AS kind, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE o_orderkey % 10 = 0) AS BIGINT) AS second_batch, CAST(count(*) FILTER (WHERE o_orderkey % 10 IN (0, 1)) AS BIGINT) AS changed, CAST(0 AS BIGINT) AS replayed FROM b
    UNION ALL SELECT 'versions', CAST((SELECT count(*) + count(*) FILTER (WHERE c_custkey % 10 = 0) FROM customer) AS BIGINT), CAST((SELECT 2 * count(*) FILTER (WHERE c_custkey % 10 = 0) FROM customer) AS BIGINT), CAST((SELECT 2 * count(*) FILTER (WHERE c_custkey % 10 = 0) FROM customer) AS BIGINT), CAST(0 AS BIGINT)
    UNION ALL SELECT 'whole', CAST((SELECT count(*) FROM customer) AS BIGINT), CAST((SELECT count(*) FROM customer) AS BIGINT), CAST((SELECT count(*) FROM customer) AS BIGINT), CAST((SELECT count(*) FROM customer) AS BIGINT)
""")
def write_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The three kinds of history through the store; a batch, a second one, and the second again."""
    lake = ingest.Lake(Landing(spark, workspace(spark)), _store(spark), [], control.new_run_id())
    base = {"merge_keys": "k", "effective_from_column": None, "op_column": None, "partition_column": "ingest_date"}
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("s"))
    hashed = lambda df: df.withColumn("_row_hash", F.xxhash64("k", "s"))
    at = lambda df, day: df.withColumn("seen", F.lit(day).cast("timestamp"))
    tenth = F.col("k") % 10 == 0
    new = lambda df: df.withColumn("s", F.when(tenth, F.concat("s", F.lit("*"))).otherwise(F.col("s")))
    kinds = {
        "fact": ({**base, "target_table": "f", "scd_type": 0}, hashed(o.filter("k % 10 <> 1")), hashed(new(o).filter("k % 10 < 3")), "_silver_batch_id"),
        "versions": ({**base, "target_table": "v", "scd_type": 2, "effective_from_column": "seen"}, at(c, "2024-01-01"), at(new(c), "2024-02-01"), "_batch_id"),
        "whole": ({**base, "target_table": "w", "scd_type": 1}, hashed(c), hashed(new(c)), "_silver_batch_id"),
    }
    rows = []
    for kind, (conf, first, second, stamp) in kinds.items():
        ingest.write_silver(lake, conf, first, "one")
        changed, again = ingest.write_silver(lake, conf, second, "two"), ingest.write_silver(lake, conf, second, "two" if kind == "whole" else "three")
        t = lake.store.read("silver", conf["target_table"])
        rows.append((kind, t.count(), t.filter(F.col(stamp) == "two").filter(tenth if kind == "fact" else F.lit(True)).count(), changed, again))
    return spark.createDataFrame(rows, "kind string, n bigint, second_batch bigint, changed bigint, replayed bigint")
