"""Registered queries over the driver's tables, each with its SQL twin.

Every operator family runs on an analogue of its feed: events are a change feed (key user, instant the hour, 'error' a
delete), lineitem and orders are facts, returned lines are late disputes, daily averages of event values are rates.
Dates leave as text, whole numbers as bigint, so that engines can't differ in types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions.dates import carried, date_key, monday_dow, open_ts
from .functions.hashing import bucket, content_checksum, weighted_pick
from .functions.values import convert_minor, differs, flag, mask_default, mask_email, mask_partial, minor_to_major, risk_tier, safe_divide, scale_to_two_digits
from .operators import aggregate, calendar, dedupe, intervals, keys, lookup, merge, quality, scd2, security
from .plans import measures
from .sources.landing import calendar as day_range

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL twin."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def big(c):
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def cents(c: str):
    """Prices are whole cents, so this loses nothing."""
    return F.round(F.col(c) * 100).cast("bigint")


def day_text(c):
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


# ---- star: lookups, keys, flags ---------------------------------------------------------------------------------


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with order, customer and supplier keys; suppliers in debt are unknown, so -1 is in use."""
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    sup = read(spark, sf, "supplier").filter("s_acctbal > 0").select("s_suppkey", "s_nationkey")
    f = lookup.lookup(li, orders, {"l_orderkey": "o_orderkey"}, {"o_custkey": "o_custkey", "o_orderdate": "o_orderdate", "o_orderpriority": "o_orderpriority"})
    f = lookup.lookup(f, sup, {"l_suppkey": "s_suppkey"}, {"supplier_sk": "s_suppkey", "s_nationkey": "s_nationkey"}, {"supplier_sk": -1})
    return f.withColumns({"amount_minor": cents("l_extendedprice"), "date_sk": big(date_key(F.col("o_orderdate")))})


LINES_SQL = """
    lines AS (
        SELECT l.*, o.o_custkey, o.o_orderdate, o.o_orderpriority, coalesce(s.s_suppkey, -1) AS supplier_sk, s.s_nationkey,
               CAST(round(l.l_extendedprice * 100) AS BIGINT) AS amount_minor,
               CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS BIGINT) AS date_sk
        FROM lineitem l
        LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
        LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey
    )"""


@query(f"""
    WITH {LINES_SQL}
    SELECT strftime(o_orderdate, '%Y-%m') AS year_month, coalesce(n.n_name, '(unknown)') AS supplier_nation,
           CAST(count(*) AS BIGINT) AS attempts, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS approved,
           CAST(sum(amount_minor) AS BIGINT) AS amount_minor,
           round(CAST(sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS DOUBLE) / nullif(count(*), 0), 8) AS approval_rate
    FROM lines LEFT JOIN nation n ON lines.s_nationkey = n.n_nationkey
    GROUP BY 1, 2
""")
def star_monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Facts with unknown members, by month and nation."""
    f = lookup.lookup(_lines(spark, sf), read(spark, sf, "nation"), {"s_nationkey": "n_nationkey"}, {"supplier_nation": "n_name"}, {"supplier_nation": "(unknown)"})
    ok = F.sum(flag(F.col("l_returnflag") != "R"))
    g = f.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("year_month"), "supplier_nation")
    return g.agg(big(F.count(F.lit(1))).alias("attempts"), big(ok).alias("approved"), big(F.sum("amount_minor")).alias("amount_minor"), F.round(safe_divide(ok, F.count(F.lit(1))), 8).alias("approval_rate"))


@query(f"""
    WITH {LINES_SQL}
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, supplier_sk, o_custkey AS customer_sk, date_sk, amount_minor,
           CAST(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS BIGINT) AS is_approved, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS is_declined,
           CAST(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS BIGINT) AS lag_days
    FROM lines
""")
def star_fact(spark: SparkSession, sf: str) -> DataFrame:
    """G7's shape: keys with fallback, flags, lag."""
    f = lookup.checked_date_key(_lines(spark, sf).drop("date_sk"), calendar.dim_date(spark, "1995-01-01", "2001-12-31"), "o_orderdate", "date_sk")
    declined = F.col("l_returnflag") == "R"
    return f.select("l_orderkey", big("l_linenumber").alias("l_linenumber"), "supplier_sk", F.col("o_custkey").alias("customer_sk"), big("date_sk").alias("date_sk"), "amount_minor", big(flag(~declined)).alias("is_approved"), big(flag(declined)).alias("is_declined"), big(F.datediff("l_shipdate", "o_orderdate")).alias("lag_days"))


@query(f"""
    WITH {LINES_SQL}, calendar AS (SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS sk FROM range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 DAY) t(d))
    SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_number, supplier_sk, coalesce(c1.sk, -1) AS raised_date_sk, coalesce(c2.sk, -1) AS resolved_date_sk,
           CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS is_open, CASE WHEN l_linestatus = 'F' THEN CAST(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS BIGINT) END AS resolution_days, amount_minor
    FROM lines LEFT JOIN calendar c1 ON c1.sk = lines.date_sk
    LEFT JOIN calendar c2 ON l_linestatus = 'F' AND c2.sk = CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS BIGINT)
    WHERE l_returnflag = 'R'
""")
def dispute_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Returned lines borrow keys from their order and have two date roles."""
    dates = calendar.dim_date(spark, "1995-01-01", "2001-12-31")
    closed = F.col("l_linestatus") == "F"
    f = _lines(spark, sf).filter("l_returnflag = 'R'").withColumn("resolved", F.when(closed, F.col("l_shipdate")))
    f = lookup.checked_date_key(lookup.checked_date_key(f, dates, "o_orderdate", "raised_date_sk"), dates, "resolved", "resolved_date_sk")
    return f.select(F.col("l_orderkey").alias("order_key"), big("l_linenumber").alias("line_number"), "supplier_sk", big("raised_date_sk").alias("raised_date_sk"), big("resolved_date_sk").alias("resolved_date_sk"), big(flag(~closed)).alias("is_open"), big(F.datediff("resolved", "o_orderdate")).alias("resolution_days"), "amount_minor")


AGG_SQL = f"""
    WITH {LINES_SQL},
    tx AS (SELECT date_sk, supplier_sk, count(*) AS attempt_count, sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS approved_count, count(DISTINCT o_custkey) AS distinct_account_count, sum(amount_minor) AS amount FROM lines GROUP BY 1, 2),
    dp AS (SELECT CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS BIGINT) AS date_sk, supplier_sk, count(*) AS dispute_count, sum(amount_minor) AS disputed FROM lines WHERE l_returnflag = 'R' GROUP BY 1, 2),
    g AS (SELECT date_sk, supplier_sk FROM tx UNION SELECT date_sk, supplier_sk FROM dp)
    SELECT g.date_sk, g.supplier_sk, CAST(coalesce(attempt_count, 0) AS BIGINT) AS attempt_count, CAST(coalesce(approved_count, 0) AS BIGINT) AS approved_count,
           CAST(coalesce(distinct_account_count, 0) AS BIGINT) AS distinct_account_count, CAST(coalesce(amount, 0) AS BIGINT) AS attempted_amount_minor,
           CAST(coalesce(dispute_count, 0) AS BIGINT) AS dispute_count, CAST(coalesce(disputed, 0) AS BIGINT) AS disputed_amount_minor
    FROM g LEFT JOIN tx ON tx.date_sk = g.date_sk AND tx.supplier_sk = g.supplier_sk LEFT JOIN dp ON dp.date_sk = g.date_sk AND dp.supplier_sk = g.supplier_sk
"""


def _agg(f: DataFrame) -> DataFrame:
    d = f.filter("l_returnflag = 'R'").withColumn("date_sk", big(date_key(F.col("l_shipdate"))))
    return aggregate.union_of_grains(
        f, d, ["date_sk", "supplier_sk"],
        {"attempt_count": F.count(F.lit(1)), "approved_count": F.sum(flag(F.col("l_returnflag") != "R")), "distinct_account_count": F.count_distinct("o_custkey"), "attempted_amount_minor": F.sum("amount_minor")},
        {"dispute_count": F.count(F.lit(1)), "disputed_amount_minor": F.sum("amount_minor")},
    )


@query(AGG_SQL)
def agg_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Union of grains, absent sides zero."""
    return _agg(_lines(spark, sf))


@query(AGG_SQL)
def rebuild_days(spark: SparkSession, sf: str) -> DataFrame:
    """Stale rows for 1996 onwards are replaced by a rebuild of the affected days; the rest stays."""
    f = _agg(_lines(spark, sf))
    stale = f.withColumn("attempt_count", F.when(F.col("date_sk") >= 19960101, F.lit(-1).cast("bigint")).otherwise(F.col("attempt_count")))
    days = f.filter("date_sk >= 19960101").select("date_sk").distinct()
    return merge.rebuild_groups(stale, lookup.only_in(f, days, {"date_sk": "date_sk"}), days, "date_sk")


@query("""
    SELECT CAST(CASE WHEN u THEN -1 ELSE year(d) * 10000 + month(d) * 100 + day(d) END AS BIGINT) AS date_sk, strftime(d, '%Y-%m-%d') AS full_date, CAST(day(d) AS BIGINT) AS day_of_month,
           CAST(isodow(d) AS BIGINT) AS day_of_week, CASE WHEN u THEN 'Unknown' ELSE dayname(d) END AS day_name, CAST(dayofyear(d) AS BIGINT) AS day_of_year, CAST(weekofyear(d) AS BIGINT) AS iso_week,
           CAST(month(d) AS BIGINT) AS month_number, CASE WHEN u THEN 'Unknown' ELSE monthname(d) END AS month_name, strftime(date_trunc('month', d), '%Y-%m-%d') AS month_start_date, strftime(last_day(d), '%Y-%m-%d') AS month_end_date,
           CAST(quarter(d) AS BIGINT) AS quarter_number, CAST(year(d) AS BIGINT) AS year_number, CASE WHEN u THEN 'Unknown' ELSE strftime(d, '%Y-%m') END AS year_month,
           NOT u AND isodow(d) >= 6 AS is_weekend, NOT u AND d = last_day(d) AS is_month_end
    FROM (SELECT CAST(x AS DATE) AS d, false AS u FROM range(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 DAY) t(x) UNION ALL SELECT DATE '1900-01-01', true)
""")
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """Whole years that hold every date, and the unknown member."""
    first, last = calendar.date_range([(read(spark, sf, "orders"), "o_orderdate"), (read(spark, sf, "lineitem"), "l_shipdate")])
    d = calendar.dim_date(spark, min(first, first.replace(year=1995)), max(last, last.replace(year=2001)))
    kinds = dict(d.dtypes)
    return d.select(*[day_text(c).alias(c) if kinds[c] == "date" else big(c).alias(c) if kinds[c] == "int" else F.col(c) for c in d.columns])


@query("""
    WITH had AS (SELECT s_suppkey AS business_key, row_number() OVER (ORDER BY s_suppkey) AS sk FROM supplier WHERE s_suppkey % 3 = 0)
    SELECT business_key, CAST(sk AS BIGINT) AS sk FROM had
    UNION ALL SELECT s_suppkey, CAST(row_number() OVER (ORDER BY s_suppkey) + (SELECT coalesce(max(sk), 0) FROM had) AS BIGINT) FROM supplier WHERE s_suppkey NOT IN (SELECT business_key FROM had)
    UNION ALL SELECT CAST(-1 AS BIGINT), CAST(-1 AS BIGINT)
""")
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Stable keys, then new ones in order, and the unknown member once."""
    sup = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("business_key"))
    had = keys.surrogate_keys(sup.filter("business_key % 3 = 0"), ["business_key"], "sk")
    new = keys.surrogate_keys(lookup.not_in(sup, had, {"business_key": "business_key"}), ["business_key"], "sk", keys.highest_key(had, "sk"))
    member = {"business_key": -1, "sk": -1}
    return keys.ensure_member(keys.ensure_member(had.unionByName(new), "sk", member), "sk", member)


@query("SELECT s_suppkey, CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS sk FROM supplier")
def surrogate_keys_parallel(spark: SparkSession, sf: str) -> DataFrame:
    """W6 without a global sort in one task: ranges, counts, offsets."""
    return keys.surrogate_keys(read(spark, sf, "supplier").select("s_suppkey"), ["s_suppkey"], "sk", parallel=True)


# ---- versions ---------------------------------------------------------------------------------------------------


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events")
    return e.select("user_id", F.date_trunc("hour", "ts").cast("timestamp").alias("at"), "event_type", "event_id", F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"))


VERSIONS_SQL = """
    changes AS (SELECT user_id, date_trunc('hour', ts) AS h, event_type, event_id, event_type = 'error' AS del FROM events),
    last AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY user_id, h ORDER BY event_type DESC, event_id DESC) = 1),
    seq AS (SELECT *, lag(event_type) OVER w AS before, lag(del) OVER w AS before_del FROM last WINDOW w AS (PARTITION BY user_id ORDER BY h)),
    kept AS (SELECT * FROM seq WHERE CASE WHEN del THEN NOT coalesce(before_del, false) ELSE before IS NULL OR before_del OR before <> event_type END),
    dated AS (SELECT *, lead(h) OVER (PARTITION BY user_id ORDER BY h) AS next_h FROM kept),
    versions AS (SELECT user_id, event_type, h AS valid_from, next_h AS valid_to, next_h IS NULL AS is_current FROM dated WHERE NOT del)"""
SHOW = """SELECT user_id, event_type, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to, is_current FROM versions"""


def _built(spark: SparkSession, sf: str) -> DataFrame:
    c = _changes(spark, sf)
    order = ["event_type", "event_id"]
    # event_id orders ties only: it is dropped from what is versioned by folding ties first.
    one = c.groupBy("user_id", "at").agg(F.max(F.struct(*order, "op")).alias("x")).select("user_id", "at", "x.event_type", "x.op")
    return scd2.build_versions(one, ["user_id"], "at", "op")


def _shown(v: DataFrame) -> DataFrame:
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return v.select("user_id", "event_type", text("valid_from").alias("valid_from"), F.when(F.col("valid_to") < open_ts(), text("valid_to")).alias("valid_to"), "is_current")


@query(f"WITH {VERSIONS_SQL} {SHOW}")
def scd2_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Collapse, no-op suppression, dated chain, deletes."""
    return _shown(_built(spark, sf))


@query(f"WITH {VERSIONS_SQL} {SHOW}")
def scd2_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, the second sent twice, give what one gives."""
    c = _changes(spark, sf)
    one = c.groupBy("user_id", "at").agg(F.max(F.struct("event_type", "event_id", "op")).alias("x")).select("user_id", "at", "x.event_type", "x.op")
    cut = F.lit("2024-01-15").cast("timestamp")
    mid = one.agg(F.min("at"), F.max("at")).first()
    cut = F.lit(mid[0] + (mid[1] - mid[0]) / 2).cast("timestamp")
    target = scd2.merge_scd2(None, one.filter(F.col("at") < cut), ["user_id"], "at", "op").result
    late = one.filter(F.col("at") >= cut)
    # Each batch reads what the one before wrote.
    keys.checkpoint_folder(spark)
    target = scd2.merge_scd2(target.checkpoint(), late, ["user_id"], "at", "op").result.checkpoint()
    return _shown(scd2.merge_scd2(target, late, ["user_id"], "at", "op").result)


@query(f"WITH {VERSIONS_SQL} SELECT user_id, event_type, strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from FROM versions WHERE is_current")
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_built(spark, sf)).filter("is_current").select("user_id", "event_type", "valid_from")


@query(f"""
    WITH {VERSIONS_SQL}, chain AS (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS nxt FROM versions)
    SELECT CAST(count(*) AS BIGINT) AS versions, CAST(count(*) FILTER (WHERE nxt > valid_to) AS BIGINT) AS gaps, CAST(count(*) FILTER (WHERE nxt < valid_to) AS BIGINT) AS overlaps, CAST(count(*) FILTER (WHERE valid_from >= valid_to) AS BIGINT) AS empty_intervals FROM chain
""")
def scd2_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Chains have gaps only where a delete made them, and never overlap."""
    return intervals.chain_audit(_built(spark, sf), ["user_id"])


@query("""
    WITH snap AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS m, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    kept AS (SELECT * FROM (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY m) AS before FROM snap) WHERE before IS NULL OR before <> o_orderpriority)
    SELECT o_custkey, o_orderpriority, strftime(m, '%Y-%m-%d') AS valid_from, strftime(lead(m) OVER (PARTITION BY o_custkey ORDER BY m), '%Y-%m-%d') AS valid_to FROM kept
""")
def snapshot_history(spark: SparkSession, sf: str) -> DataFrame:
    """C4, M1: monthly snapshots become versions; a month that changes nothing makes none."""
    v = scd2.build_versions(_snapshots(spark, sf), ["o_custkey"], "m")
    return v.select("o_custkey", "o_orderpriority", day_text("valid_from").alias("valid_from"), F.when(~F.col("is_current"), day_text("valid_to")).alias("valid_to"))


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").withColumn("m", F.date_trunc("month", "o_orderdate").cast("timestamp"))
    return dedupe.newest(o, ["o_custkey", "m"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select("o_custkey", "m", "o_orderpriority")


PIT_SQL = """
    dim AS (SELECT *, coalesce(lead(m) OVER (PARTITION BY o_custkey ORDER BY m), TIMESTAMP '9999-12-31 23:59:59') AS nxt FROM (
        SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY m) AS before FROM (
            SELECT o_custkey, date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS m, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1))
        WHERE before IS NULL OR before <> o_orderpriority)"""


def _dim(spark: SparkSession, sf: str) -> DataFrame:
    """Customer versions known from the month after."""
    return scd2.build_versions(_snapshots(spark, sf).withColumn("m", F.add_months("m", 1).cast("timestamp")), ["o_custkey"], "m")


@query(f"WITH {PIT_SQL} SELECT o.o_orderkey, o.o_custkey, d.o_orderpriority AS version_priority, strftime(d.m, '%Y-%m-%d') AS version_from FROM orders o LEFT JOIN dim d ON o.o_custkey = d.o_custkey AND o.o_orderdate >= d.m AND o.o_orderdate < d.nxt")
def pit_join(spark: SparkSession, sf: str) -> DataFrame:
    """Each order with the version of its customer that was valid then."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    j = lookup.pit_lookup(o, _dim(spark, sf), {"o_custkey": "o_custkey"}, "at", {"version_priority": "o_orderpriority", "valid_from": "valid_from"})
    return j.select("o_orderkey", "o_custkey", "version_priority", day_text("valid_from").alias("version_from"))


@query(f"""
    WITH {PIT_SQL}, owner AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders)
    SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_suppkey, d.o_orderpriority AS version_priority, n.n_name AS nation
    FROM lineitem l LEFT JOIN owner o ON l.l_orderkey = o.o_orderkey LEFT JOIN dim d ON d.o_custkey = o.o_custkey AND l.l_shipdate >= d.m AND l.l_shipdate < d.nxt
    LEFT JOIN customer c ON c.c_custkey = d.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def pit_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Line to order to then-current customer version to nation."""
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("at"))
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey", F.lit("1900-01-01").cast("timestamp").alias("valid_from"), open_ts().alias("valid_to"))
    j = lookup.chained_lookup(li, orders, {"l_orderkey": "o_orderkey"}, "o_custkey", _dim(spark, sf), "o_custkey", "at", {}, {"version_priority": "o_orderpriority", "__cust": "o_custkey"})
    j = lookup.lookup(j, read(spark, sf, "customer"), {"__cust": "c_custkey"}, {"__nation": "c_nationkey"}, split_null=True)
    j = lookup.lookup(j, F.broadcast(read(spark, sf, "nation")), {"__nation": "n_nationkey"}, {"nation": "n_name"})
    return j.select("l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_suppkey", "version_priority", "nation")


@query(f"""
    WITH {PIT_SQL}, first AS (SELECT o_custkey, min(m) AS f FROM dim GROUP BY 1), cust AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 50 = 1 THEN -o_custkey ELSE o_custkey END AS k, o_orderdate FROM orders)
    SELECT cause, CAST(count(*) AS BIGINT) AS n FROM (
        SELECT CASE WHEN d.m IS NOT NULL THEN 'resolved' WHEN c.k IS NULL THEN 'null_key' WHEN f.f IS NULL THEN 'absent_key' WHEN c.o_orderdate < f.f THEN 'before_first_version' ELSE 'hole_in_chain' END AS cause
        FROM cust c LEFT JOIN dim d ON c.k = d.o_custkey AND c.o_orderdate >= d.m AND c.o_orderdate < d.nxt LEFT JOIN first f ON f.o_custkey = c.k) GROUP BY 1
""")
def unknown_cause(spark: SparkSession, sf: str) -> DataFrame:
    """Why lookups find nothing, with no remainder."""
    k = F.when(F.col("o_orderkey") % 50 == 0, None).when(F.col("o_orderkey") % 50 == 1, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    o = read(spark, sf, "orders").select("o_orderkey", k.alias("k"), F.col("o_orderdate").cast("timestamp").alias("at"))
    c = lookup.unknown_causes(o, _dim(spark, sf), "k", "at", "o_custkey")
    return c.groupBy("cause").agg(big(F.count(F.lit(1))).alias("n"))


# ---- rates ------------------------------------------------------------------------------------------------------

RATES_SQL = """
    days AS (SELECT event_type, CAST(ts AS DATE) AS d, CAST(round(sum(CAST(round(value * 100) AS BIGINT)) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS rate FROM events WHERE day(ts) NOT IN (5, 9, 14, 20, 26) GROUP BY 1, 2),
    rates AS (SELECT *, coalesce(lead(d) OVER (PARTITION BY event_type ORDER BY d) - 1, DATE '9999-12-31') AS until FROM days)"""


def _rates(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").filter(~F.dayofmonth("ts").isin(5, 9, 14, 20, 26))
    mean = F.round(F.sum(F.round(F.col("value") * 100).cast("bigint")) / F.count(F.lit(1)).cast("double")).cast("bigint")
    days = e.groupBy("event_type", F.col("ts").cast("date").alias("d")).agg(mean.alias("rate"))
    return intervals.closed_intervals(days, ["event_type"], "d")


@query(f"WITH {RATES_SQL} SELECT event_type, rate, strftime(d, '%Y-%m-%d') AS valid_from_date, strftime(until, '%Y-%m-%d') AS valid_to_date FROM rates")
def fx_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """A rate holds until the day before the next."""
    return _rates(spark, sf).select("event_type", "rate", day_text("valid_from_date").alias("valid_from_date"), day_text("valid_to_date").alias("valid_to_date"))


@query(f"""
    WITH {RATES_SQL}
    SELECT e.event_id, r.rate, CAST(r.d < CAST(e.ts AS DATE) AS BOOLEAN) AS is_carried, CAST(CASE (e.event_id % 4) WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 9 END AS BIGINT) AS digits,
           CAST(round(CAST(round(e.value * 100) AS BIGINT) * r.rate * CASE (e.event_id % 4) WHEN 0 THEN CAST(100 AS DECIMAL(12,4)) WHEN 1 THEN 1 WHEN 2 THEN 0.1 END, 0) AS BIGINT) AS converted
    FROM events e LEFT JOIN rates r ON e.event_type = r.event_type AND CAST(e.ts AS DATE) BETWEEN r.d AND r.until
""")
def fx_convert(spark: SparkSession, sf: str) -> DataFrame:
    """Carried-forward rates, scaled by minor-unit digits, rounded once."""
    e = read(spark, sf, "events").withColumn("amount", F.round(F.col("value") * 100).cast("bigint"))
    j = lookup.daily_lookup(e, _rates(spark, sf), {"event_type": "event_type"}, "ts", {"rate": "rate", "rate_date": "d"})
    k = F.col("event_id") % 4
    digits = F.when(k == 0, 0).when(k == 1, 2).when(k == 2, 3).otherwise(9)
    return j.select("event_id", "rate", carried(F.col("rate_date"), F.col("ts").cast("date")).alias("is_carried"), big(digits).alias("digits"), convert_minor(F.col("amount"), F.col("rate"), scale_to_two_digits(digits)).alias("converted"))


# ---- deduplication, quality, merges -------------------------------------------------------------------------------

NEWEST_SQL = "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1"


def _newest(spark: SparkSession, sf: str) -> DataFrame:
    order = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return dedupe.newest(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c).desc() for c in order])


@query(f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM ({NEWEST_SQL})")
def dedupe_newest(spark: SparkSession, sf: str) -> DataFrame:
    """W1, C5."""
    return _newest(spark, sf).select("l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_partkey", "l_suppkey", day_text("l_shipdate").alias("shipped"))


def _rules() -> list[quality.Rule]:
    r = quality.Rule
    return [
        r("line.unique", "lines", "l_orderkey", "unique", condition="l_linenumber = 1"), r("qty.range", "lines", "l_quantity", "range", {"min": 3, "max": 45}, threshold=5.0),
        r("flag.enum", "lines", "flag", "enum_domain", {"values": ["A", "N"]}, severity="error"), r("flag.null", "lines", "flag", "not_null", condition="l_linestatus = 'O'"),
        r("ship.expr", "lines", "l_shipdate", "expression", {"predicate": "l_shipdate >= o_orderdate"}), r("supp.ref", "lines", "l_suppkey", "referential", {"ref_layer": "silver", "ref_table": "supplier", "ref_column": "s_suppkey"}),
    ]


def _judged(spark: SparkSession, sf: str) -> tuple[DataFrame, list[quality.Rule]]:
    f = _lines(spark, sf).withColumn("flag", F.nullif(F.col("l_returnflag"), F.when(F.col("l_linenumber") == 2, F.col("l_returnflag")).otherwise(F.lit("?"))))
    f = f.withColumn("l_quantity", F.col("l_linenumber").cast("double") * 8)
    ref = {("silver", "supplier"): read(spark, sf, "supplier").filter("s_acctbal > 0")}
    marked, ready, _ = quality.flagged(f, _rules(), ref)
    return marked, ready


DQ_SQL = f"""
    WITH {LINES_SQL},
    j AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_linestatus, l_shipdate, o_orderdate, supplier_sk, l_linenumber * 8.0 AS q, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS flag, count(*) OVER (PARTITION BY l_orderkey) AS copies FROM lines),
    v AS (SELECT *, l_linenumber = 1 AND copies > 1 AS b1, q < 3 OR q > 45 AS b2, flag IS NOT NULL AND flag NOT IN ('A', 'N') AS b3, l_linestatus = 'O' AND flag IS NULL AS b4, NOT coalesce(l_shipdate >= o_orderdate, false) AS b5, supplier_sk = -1 AS b6 FROM j)"""


@query(f"""
    {DQ_SQL}
    SELECT 'line.unique' AS rule_id, CAST(count(*) FILTER (WHERE l_linenumber = 1) AS BIGINT) AS evaluated, CAST(count(*) FILTER (WHERE b1) AS BIGINT) AS failed FROM v
    UNION ALL SELECT 'qty.range', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE b2) AS BIGINT) FROM v
    UNION ALL SELECT 'flag.enum', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE b3) AS BIGINT) FROM v
    UNION ALL SELECT 'flag.null', CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS BIGINT), CAST(count(*) FILTER (WHERE b4) AS BIGINT) FROM v
    UNION ALL SELECT 'ship.expr', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE b5) AS BIGINT) FROM v
    UNION ALL SELECT 'supp.ref', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE b6) AS BIGINT) FROM v
""")
def dq_row_rules(spark: SparkSession, sf: str) -> DataFrame:
    """All rules judged by one aggregate."""
    marked, ready = _judged(spark, sf)
    aggs = [F.struct(F.lit(r.rule_id).alias("rule_id"), big(F.count_if(F.col(f"__in_{i}"))).alias("evaluated"), big(F.count_if(F.col(f"__bad_{i}"))).alias("failed")) for i, r in enumerate(ready)]
    return marked.agg(F.array(*aggs).alias("r")).select(F.explode("r").alias("r")).select("r.*")


@query(f"""
    {DQ_SQL}
    SELECT ids AS rule_ids, severity, CAST(count(*) AS BIGINT) AS n FROM (
        SELECT concat_ws(',', CASE WHEN b1 THEN 'line.unique' END, CASE WHEN b2 THEN 'qty.range' END, CASE WHEN b3 THEN 'flag.enum' END, CASE WHEN b4 THEN 'flag.null' END, CASE WHEN b5 THEN 'ship.expr' END, CASE WHEN b6 THEN 'supp.ref' END) AS ids, CASE WHEN b3 THEN 'error' ELSE 'warn' END AS severity FROM v)
    WHERE ids <> '' GROUP BY 1, 2
""")
def dq_rule_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected rows with every reason and the worst severity."""
    marked, ready = _judged(spark, sf)
    ids, worst = quality.rule_columns(ready)
    held = marked.select(ids.alias("ids"), worst.alias("severity")).filter(F.size("ids") > 0)
    return held.groupBy(F.concat_ws(",", "ids").alias("rule_ids"), "severity").agg(big(F.count(F.lit(1))).alias("n"))


@query("""
    SELECT 'order.continuity' AS rule_id, CAST(datediff('day', min(d), max(d)) + 1 - count(DISTINCT d) AS BIGINT) AS measure, datediff('day', min(d), max(d)) + 1 - count(DISTINCT d) > 0 AS breached FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)
    UNION ALL SELECT 'order.freshness', CAST(datediff('day', max(d), DATE '2001-08-31') AS BIGINT), datediff('day', max(d), DATE '2001-08-31') > 3 FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)
""")
def dq_batch_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Q7, Q8, A5: rules about the batch, all of it, as of the batch's own date."""
    o = read(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    rules = [quality.Rule("order.continuity", "o", "d", "continuity", {"max_missing_days": 0}), quality.Rule("order.freshness", "o", "d", "freshness", {"max_age_days": 3})]
    got = quality.batch_results(o, rules, quality.as_of("orders|1995-01-01|2001-08-31"))
    measure = lambda r: int(r.detail.split()[0]) if r.rule.rule_type == "continuity" else int(r.detail.split(" is ")[1].split()[0])
    return spark.createDataFrame([(r.rule.rule_id, measure(r), r.breached) for r in got], "rule_id string, measure bigint, breached boolean")


@query("""
    SELECT event_id, TRY_CAST(raw AS BIGINT) AS typed, raw IS NOT NULL AND TRY_CAST(raw AS BIGINT) IS NULL AS uncastable
    FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN event_type WHEN event_id % 5 = 1 THEN NULL ELSE CAST(event_id * 3 AS VARCHAR) END AS raw FROM events)
""")
def type_gate(spark: SparkSession, sf: str) -> DataFrame:
    """What won't cast is caught, not raised."""
    raw = F.when(F.col("event_id") % 5 == 0, F.col("event_type")).when(F.col("event_id") % 5 == 1, None).otherwise((F.col("event_id") * 3).cast("string"))
    e = read(spark, sf, "events").select("event_id", raw.alias("raw"))
    return e.select("event_id", F.col("raw").try_cast("bigint").alias("typed"), quality.violation(quality.Rule("x", "x", "raw", "castable", {"type": "bigint"})).alias("uncastable"))


@query("""
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN 'updated' WHEN o_orderkey % 10 = 1 THEN 'inserted' ELSE 'unchanged' END AS action FROM (
        SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders)
""")
def upsert_if_changed(spark: SparkSession, sf: str) -> DataFrame:
    """M4, M5: changed rows updated, new ones inserted, the rest untouched, and counted as such."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    hashed = lambda d: d.withColumn("_row_hash", F.xxhash64("o_orderstatus"))
    source = o.filter("o_orderkey % 10 < 3").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus")))
    return merge.upsert_if_changed(hashed(o.filter("o_orderkey % 10 <> 1")), hashed(source), ["o_orderkey"], action="action").drop("_row_hash")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def replace_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """M8: delete the keys that come, insert what comes."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return merge.replace_by_key(o, o.filter("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("Z")), ["o_orderkey"])


@query("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN upper(n_name) || '*' ELSE n_name END AS name, CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE CAST(n_regionkey AS BIGINT) END AS region FROM (SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, n_regionkey FROM nation)")
def resync_members(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes overwritten where they differ, null-safe; members that vanished stay."""
    n = read(spark, sf, "nation").select(big("n_nationkey").alias("k"), F.col("n_name").alias("name"), big("n_regionkey").alias("region"))
    source = n.filter("k % 2 = 0").select("k", F.concat(F.upper("name"), F.lit("*")).alias("name"), F.when(F.col("k") % 6 != 0, F.col("region")).alias("region"))
    return merge.resync(n, source, ["k"], ["name", "region"], {"name": F.col("s.name"), "region": F.col("s.region")})


@query("SELECT o_orderkey, CAST(o_orderkey % 3 AS BIGINT) AS batch FROM orders WHERE o_orderkey % 3 <> 1 UNION ALL SELECT o_orderkey, 9 FROM orders WHERE o_orderkey % 3 = 1")
def replay_batch(spark: SparkSession, sf: str) -> DataFrame:
    """M7: a batch's rows go, its rows of the replay come."""
    o = read(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 3).cast("string").alias("_batch_id"))
    again = o.filter("_batch_id = '1'").withColumn("_batch_id", F.lit("9"))
    return merge.delete_batch(o, "1").unionByName(again).select("o_orderkey", F.col("_batch_id").cast("bigint").alias("batch"))


# ---- measures on a star made of the driver's tables -----------------------------------------------------------------


def _star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    f = _lines(spark, sf)
    declined = F.col("l_returnflag") == "R"
    tx = f.select(
        F.col("date_sk").cast("int").alias("date_sk"), F.col("o_custkey").alias("account_sk"), F.col("o_custkey").alias("customer_sk"), F.col("l_suppkey").alias("merchant_sk"), F.lit(1).alias("card_product_sk"), F.lit(1).alias("currency_sk"),
        F.when(declined, F.col("l_linenumber")).otherwise(-1).alias("decline_reason_sk"), flag(~declined).alias("is_approved"), flag(declined).alias("is_declined"), flag(F.col("l_returnflag") == "A").alias("is_reversed"),
        flag(F.col("l_linestatus") == "F").alias("is_settled"), F.col("amount_minor").alias("amount_gbp_minor"), F.when(F.col("l_linestatus") == "F", F.datediff("l_shipdate", "o_orderdate")).alias("settlement_lag_days"),
        F.when(F.col("o_orderpriority") < "3", "ECOM").otherwise("POS").alias("channel"), (F.col("l_tax") > 0.04).alias("is_3ds"), (F.col("l_discount") > 0.05).alias("fx_rate_is_carried"),
    )
    d = f.filter(declined)
    open_now = F.col("l_linestatus") == "O"
    disputes = d.select(
        F.col("date_sk").cast("int").alias("raised_date_sk"), F.when(open_now, -1).otherwise(date_key(F.col("l_shipdate"))).cast("int").alias("resolved_date_sk"), F.col("o_custkey").alias("account_sk"), F.col("l_suppkey").alias("merchant_sk"), F.lit(1).alias("currency_sk"),
        flag(open_now).alias("is_open"), flag(~open_now & (F.col("l_linenumber") % 3 == 0)).alias("is_won"), flag(~open_now & (F.col("l_linenumber") % 3 == 1)).alias("is_lost"), F.col("amount_minor").alias("disputed_amount_gbp_minor"),
        F.when(~open_now, F.datediff("l_shipdate", "o_orderdate")).alias("resolution_days"),
    )
    agg = tx.groupBy("date_sk", "merchant_sk").agg(big(F.count(F.lit(1))).alias("attempt_count"), big(F.sum("is_approved")).alias("approved_count"), big(F.count_distinct("account_sk")).alias("distinct_account_count"), F.sum("amount_gbp_minor").alias("attempted_amount_gbp_minor"))
    sup, cust = read(spark, sf, "supplier"), read(spark, sf, "customer")
    return {
        "fact_transaction": tx, "fact_dispute": disputes, "agg_merchant_daily": agg, "dim_date": calendar.dim_date(spark, "1995-01-01", "2001-12-31"),
        "dim_merchant": sup.select(F.col("s_suppkey").alias("merchant_sk"), F.col("s_name").alias("merchant_id"), F.col("s_nationkey").alias("nation"), (F.col("s_acctbal") > 0).alias("is_current"), (F.col("s_suppkey") % 101).alias("risk_score")),
        "dim_account": cust.select(F.col("c_custkey").alias("account_sk"), F.concat(F.lit("A"), (F.col("c_custkey") % 500).cast("string")).alias("account_id"), (F.col("c_acctbal") > 0).alias("is_current"), "c_mktsegment"),
        "dim_customer": cust.select(F.col("c_custkey").alias("customer_sk"), F.col("c_name").alias("customer_id"), (F.col("c_acctbal") > 0).alias("is_current")),
        "dim_decline_reason": spark.createDataFrame([(-1, "N/A", False), *[(i, f"R{i}", i % 2 == 0) for i in range(1, 8)]], "decline_reason_sk int, code string, is_retriable boolean"),
    }


STAR_SQL = f"""
    {LINES_SQL.strip()},
    tx AS (SELECT date_sk, o_custkey AS account_sk, l_suppkey AS merchant_sk, CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE -1 END AS reason, CAST(l_returnflag <> 'R' AS INT) AS ok, CAST(l_returnflag = 'R' AS INT) AS no, CAST(l_returnflag = 'A' AS INT) AS rev, CAST(l_linestatus = 'F' AS INT) AS settled, amount_minor,
                  CASE WHEN l_linestatus = 'F' THEN datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) END AS lag, o_orderpriority < '3' AS ecom, l_tax > 0.04 AS tds, l_discount > 0.05 AS carried, strftime(o_orderdate, '%Y-%m') AS ym FROM lines),
    dp AS (SELECT date_sk, strftime(o_orderdate, '%Y-%m') AS ym, CASE WHEN l_linestatus = 'O' THEN 'Unknown' ELSE strftime(l_shipdate, '%Y-%m') END AS resolved_ym, l_suppkey AS merchant_sk, CAST(l_linestatus = 'O' AS INT) AS is_open, CAST(l_linestatus <> 'O' AND l_linenumber % 3 = 0 AS INT) AS won, CAST(l_linestatus <> 'O' AND l_linenumber % 3 = 1 AS INT) AS lost, amount_minor,
                  CASE WHEN l_linestatus <> 'O' THEN datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) END AS days FROM lines WHERE l_returnflag = 'R')"""


def _measured(spark: SparkSession, sf: str, names: dict[str, str], by: dict[str, str] | None = None, filters: dict | None = None) -> DataFrame:
    """Measures under plain names; numbers that are no counts rounded to 6 digits."""
    got = measures.evaluate(_star(spark, sf), list(names), list(by or {}), filters)
    kinds = dict(got.dtypes)
    out = [F.round(F.col(f"`{n}`"), 6).alias(a) if kinds[n] == "double" else big(F.col(f"`{n}`")).alias(a) for n, a in names.items()]
    return got.select(*[F.col(k.replace(".", "__")).alias(a) for k, a in (by or {}).items()], *out)


@query(f"""
    WITH {STAR_SQL}
    SELECT CAST(count(*) AS BIGINT) AS attempts, CAST(sum(ok) AS BIGINT) AS approved, CAST(sum(no) AS BIGINT) AS declined, CAST(sum(rev) AS BIGINT) AS reversed, CAST(sum(settled) AS BIGINT) AS settled,
           round(sum(ok) / CAST(count(*) AS DOUBLE), 6) AS authorisation_rate, round(sum(no) / CAST(count(*) AS DOUBLE), 6) AS decline_rate, round(sum(amount_minor) / 100.0, 6) AS attempted_volume, round(sum(amount_minor) FILTER (WHERE ok = 1) / 100.0, 6) AS approved_volume,
           round(sum(amount_minor) FILTER (WHERE ok = 1) / 100.0 / sum(ok), 6) AS average_approved, round(avg(lag), 6) AS lag_days, round(sum(settled) / CAST(sum(ok) AS DOUBLE), 6) AS settlement_rate, round(count(*) FILTER (WHERE carried) / CAST(count(*) AS DOUBLE), 6) AS carried_share
    FROM tx
""")
def measures_volume(spark: SparkSession, sf: str) -> DataFrame:
    """K1-K7, K10-K14, K16, A7, A8."""
    return _measured(spark, sf, {
        "Attempts": "attempts", "Approved Transactions": "approved", "Declined Transactions": "declined", "Reversed Transactions": "reversed", "Settled Transactions": "settled", "Authorisation Rate": "authorisation_rate",
        "Decline Rate": "decline_rate", "Attempted Volume (GBP)": "attempted_volume", "Approved Volume (GBP)": "approved_volume", "Average Approved Value (GBP)": "average_approved", "Average Settlement Lag (Days)": "lag_days", "Settlement Rate": "settlement_rate", "FX Carried Share": "carried_share",
    })


@query(f"""
    WITH {STAR_SQL}
    SELECT 'R' || reason AS reason, CAST(sum(no) AS BIGINT) AS declined, round(sum(no) / CAST((SELECT sum(no) FROM tx) AS DOUBLE), 6) AS decline_share FROM tx WHERE reason > 0 GROUP BY 1
    UNION ALL SELECT 'N/A', CAST(0 AS BIGINT), NULL
""")
def by_reason(spark: SparkSession, sf: str) -> DataFrame:
    """K8: the denominator knows no reason; the not-applicable member is blank."""
    return _measured(spark, sf, {"Declined Transactions": "declined", "Decline Rate by Reason": "decline_share"}, {"dim_decline_reason.code": "reason"})


@query(f"WITH {STAR_SQL} SELECT ym AS year_month, round(sum(CASE WHEN reason IN (2, 4, 6) THEN no END) / nullif(CAST(sum(no) AS DOUBLE), 0), 6) AS retriable_share FROM tx GROUP BY 1")
def retriable_share(spark: SparkSession, sf: str) -> DataFrame:
    """K9, J13."""
    return _measured(spark, sf, {"Retriable Decline Share": "retriable_share"}, {"dim_date.year_month": "year_month"})


@query(f"""
    WITH {STAR_SQL}, r AS (SELECT ym, sum(ok) FILTER (WHERE ecom AND tds) / nullif(CAST(count(*) FILTER (WHERE ecom AND tds) AS DOUBLE), 0) AS a, sum(ok) FILTER (WHERE ecom AND NOT tds) / nullif(CAST(count(*) FILTER (WHERE ecom AND NOT tds) AS DOUBLE), 0) AS b FROM tx GROUP BY 1)
    SELECT ym AS year_month, round((a - b) * 100, 6) AS uplift_pp FROM r
""")
def uplift(spark: SparkSession, sf: str) -> DataFrame:
    """Blank unless both sides have traffic."""
    return _measured(spark, sf, {"3DS Approval Uplift (pp)": "uplift_pp"}, {"dim_date.year_month": "year_month"})


@query(f"WITH {STAR_SQL} SELECT ym AS year_month, CAST(count(*) AS BIGINT) AS raised, CAST(sum(is_open) AS BIGINT) AS open_now, CAST(sum(won) AS BIGINT) AS won, CAST(sum(lost) AS BIGINT) AS lost, round(sum(amount_minor) / 100.0, 6) AS disputed_volume, round(sum(won) / nullif(CAST(sum(won) + sum(lost) AS DOUBLE), 0), 6) AS win_rate FROM dp GROUP BY 1")
def win_rate(spark: SparkSession, sf: str) -> DataFrame:
    """K17-K22."""
    return _measured(spark, sf, {"Disputes Raised": "raised", "Disputes Open": "open_now", "Disputes Won": "won", "Disputes Lost": "lost", "Disputed Volume (GBP)": "disputed_volume", "Dispute Win Rate": "win_rate"}, {"dim_date.year_month": "year_month"})


@query(f"WITH {STAR_SQL} SELECT resolved_ym AS year_month, CAST(count(*) AS BIGINT) AS resolved, round(avg(days), 6) AS resolution_days FROM dp WHERE is_open = 0 GROUP BY 1")
def resolved_role(spark: SparkSession, sf: str) -> DataFrame:
    """By the resolved date, open disputes left out."""
    return _measured(spark, sf, {"Disputes Resolved": "resolved", "Dispute Resolution Days": "resolution_days"}, {"dim_date.year_month": "year_month"})


@query(f"""
    WITH {STAR_SQL}, a AS (SELECT merchant_sk, count(*) AS n, sum(amount_minor) AS v FROM tx GROUP BY 1), b AS (SELECT merchant_sk, count(*) AS n, sum(amount_minor) AS v FROM dp GROUP BY 1)
    SELECT s.s_name AS merchant_id, round(b.n / nullif(CAST(a.n AS DOUBLE), 0) * 10000, 6) AS chargeback_bps, round((b.v / 100.0) / nullif(a.v / 100.0, 0) * 10000, 6) AS chargeback_volume_bps FROM a FULL JOIN b ON a.merchant_sk = b.merchant_sk JOIN supplier s ON s.s_suppkey = coalesce(a.merchant_sk, b.merchant_sk)
""")
def bps_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Numerator and denominator from different facts."""
    return _measured(spark, sf, {"Chargeback Rate (bps)": "chargeback_bps", "Chargeback Volume Rate (bps)": "chargeback_volume_bps"}, {"dim_merchant.merchant_id": "merchant_id"})


@query(f"WITH {STAR_SQL} SELECT ym AS year_month, CAST(count(*) AS BIGINT) AS attempts, CAST(sum(ok) AS BIGINT) AS approved, round(sum(amount_minor) / 100.0, 6) AS volume, round(sum(ok) / CAST(count(*) AS DOUBLE), 6) AS authorisation_rate FROM tx GROUP BY 1")
def agg_tie_out(spark: SparkSession, sf: str) -> DataFrame:
    """From the aggregate, equal to what the facts say."""
    return _measured(spark, sf, {"Attempts (agg)": "attempts", "Approved Transactions (agg)": "approved", "Attempted Volume (GBP) (agg)": "volume", "Authorisation Rate (agg)": "authorisation_rate"}, {"dim_date.year_month": "year_month"})


@query(f"""
    WITH {STAR_SQL}, a AS (SELECT date_sk, merchant_sk, ym, count(DISTINCT account_sk) AS n FROM tx GROUP BY 1, 2, 3)
    SELECT strftime(strptime(CAST(date_sk AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS day, CAST(sum(n) AS BIGINT) AS distinct_per_day FROM a GROUP BY 1
""")
def hasonevalue_guard(spark: SparkSession, sf: str) -> DataFrame:
    """K31 at day grain."""
    out = _measured(spark, sf, {"Distinct Accounts (per day)": "distinct_per_day"}, {"dim_date.full_date": "day"})
    return out.select(day_text("day").alias("day"), "distinct_per_day")


@query(f"WITH {STAR_SQL}, a AS (SELECT ym, date_sk, merchant_sk, count(DISTINCT account_sk) AS n FROM tx GROUP BY 1, 2, 3) SELECT ym AS year_month, CAST(CASE WHEN min(date_sk) = max(date_sk) THEN sum(n) END AS BIGINT) AS distinct_per_day FROM a GROUP BY 1")
def hasonevalue_blank(spark: SparkSession, sf: str) -> DataFrame:
    """K31 at month grain: blank where there is more than one day."""
    return _measured(spark, sf, {"Distinct Accounts (per day)": "distinct_per_day"}, {"dim_date.year_month": "year_month"})


@query(f"WITH {STAR_SQL} SELECT c.c_mktsegment AS segment, CAST(count(DISTINCT 'A' || (c.c_custkey % 500)) AS BIGINT) AS distinct_accounts FROM tx JOIN customer c ON c.c_custkey = tx.account_sk GROUP BY 1")
def distinct_through_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Business keys that the fact reaches."""
    return _measured(spark, sf, {"Distinct Accounts": "distinct_accounts"}, {"dim_account.c_mktsegment": "segment"})


@query("SELECT CAST((SELECT count(DISTINCT c_custkey % 500) FROM customer WHERE c_acctbal > 0) AS BIGINT) AS accounts, CAST((SELECT count(DISTINCT c_name) FROM customer WHERE c_acctbal > 0) AS BIGINT) AS customers, CAST((SELECT count(DISTINCT s_name) FROM supplier WHERE s_acctbal > 0) AS BIGINT) AS merchants, round((SELECT avg(s_suppkey % 101) FROM supplier WHERE s_acctbal > 0), 6) AS risk")
def scalar_subquery(spark: SparkSession, sf: str) -> DataFrame:
    """Four answers of one row side by side."""
    return _measured(spark, sf, {"Active Accounts": "accounts", "Active Customers": "customers", "Active Merchants": "merchants", "Average Merchant Risk Score": "risk"})


@query(f"WITH {STAR_SQL} SELECT s.s_name AS merchant_id, CAST(count(*) AS BIGINT) AS attempts, CAST(sum(amount_minor) AS BIGINT) AS volume FROM tx JOIN supplier s ON s.s_suppkey = tx.merchant_sk GROUP BY 1 ORDER BY volume DESC, merchant_id LIMIT 10")
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The report's ten largest merchants, by business key."""
    s = _star(spark, sf)
    j = s["fact_transaction"].join(s["dim_merchant"], "merchant_sk")
    return aggregate.top_k(j.groupBy("merchant_id").agg(big(F.count(F.lit(1))).alias("attempts"), big(F.sum("amount_gbp_minor")).alias("volume")), "volume", 10, ["merchant_id"])


# ---- security, sets, functions --------------------------------------------------------------------------------------

ACCESS = (("ann", "ASIA"), ("ann", "EUROPE"), ("bob", "*"), ("bob", "ASIA"), ("cy", "NOWHERE"))


@query("""
    WITH c AS (SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT 'ann' AS principal, r_name AS region, CAST(count(*) AS BIGINT) AS n FROM c WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY 2 UNION ALL SELECT 'bob', r_name, CAST(count(*) AS BIGINT) FROM c GROUP BY 2
""")
def rls_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Named regions, all regions, none."""
    access = spark.createDataFrame(list(ACCESS), "principal_name string, region string")
    n = read(spark, sf, "nation").join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = read(spark, sf, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("r_name").alias("region"))
    seen = [security.region_filter(c, access, principal=p).select(F.lit(p).alias("principal"), "region") for p in ("ann", "bob", "cy")]
    return seen[0].unionByName(seen[1]).unionByName(seen[2]).groupBy("principal", "region").agg(big(F.count(F.lit(1))).alias("n"))


@query("SELECT c_custkey, substr(c_name, 1, 2) || '****' || substr(c_name, -2) AS name, substr(lower(c_name), 1, 1) || 'XXX@XXXX.com' AS email, 'XXXX' AS segment, CAST(0 AS DOUBLE) AS balance FROM customer")
def masking(spark: SparkSession, sf: str) -> DataFrame:
    """Partial, address and default masks."""
    c = read(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), F.concat(F.lower("c_name"), F.lit("@mail.example")).alias("email"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    masks = {"name": mask_partial(F.col("name"), 2, "****", 2), "email": mask_email(F.col("email"))} | {n: mask_default(F.col(n), c.schema[n].dataType) for n in ("segment", "balance")}
    return security.masked(c, masks)


@query("SELECT c_custkey, true AS has_orders FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) UNION ALL SELECT c_custkey, false FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def semi_anti(spark: SparkSession, sf: str) -> DataFrame:
    """J8, J12."""
    c, o = read(spark, sf, "customer").select("c_custkey"), read(spark, sf, "orders")
    on = {"c_custkey": "o_custkey"}
    return lookup.only_in(c, o, on).withColumn("has_orders", F.lit(True)).unionByName(lookup.not_in(c, o, on).withColumn("has_orders", F.lit(False)))


@query("SELECT event_type, CAST(user_id AS BIGINT) AS user_id FROM events WHERE event_id % 2 = 0 EXCEPT ALL SELECT event_type, CAST(user_id AS BIGINT) FROM events WHERE event_id % 3 = 0")
def except_all(spark: SparkSession, sf: str) -> DataFrame:
    """U4."""
    e = read(spark, sf, "events").select("event_type", big("user_id").alias("user_id"), "event_id")
    return e.filter("event_id % 2 = 0").drop("event_id").exceptAll(e.filter("event_id % 3 = 0").drop("event_id"))


@query("SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day FROM orders UNION SELECT CAST(l_shipdate AS DATE)::VARCHAR FROM lineitem WHERE l_returnflag = 'R'")
def affected_days(spark: SparkSession, sf: str) -> DataFrame:
    """U1, A12."""
    a = read(spark, sf, "orders").select(day_text("o_orderdate").alias("day"))
    return a.union(read(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(day_text("l_shipdate").alias("day"))).distinct()


@query("""
    WITH e AS (SELECT user_id, ts, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
    SELECT event_id, user_id, CAST(sum(CASE WHEN before IS NULL OR before <> event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS version, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS ordinal FROM e
""")
def version_counter(spark: SparkSession, sf: str) -> DataFrame:
    """W8, W9."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = read(spark, sf, "events").withColumn("changed", differs(F.lag("event_type").over(w), F.col("event_type")))
    return e.select("event_id", "user_id", big(aggregate.version_counter(F.col("changed"), ["user_id"], ["ts", "event_id"])).alias("version"), big(F.row_number().over(w)).alias("ordinal"))


@query("SELECT strftime(d, '%Y-%m-%d') AS day, r_name AS region, CAST(isodow(d) AS BIGINT) AS day_of_week FROM range(DATE '2000-01-01', DATE '2000-03-01', INTERVAL 1 DAY) t(d), region")
def calendar_cross(spark: SparkSession, sf: str) -> DataFrame:
    """Every day with every member of a small relation."""
    d = day_range(spark, "2000-01-01", "2000-02-29")
    return d.crossJoin(F.broadcast(read(spark, sf, "region"))).select(day_text("d").alias("day"), F.col("r_name").alias("region"), big(monday_dow(F.col("d"))).alias("day_of_week"))


@query("""
    SELECT s_suppkey, CASE WHEN k >= 0 AND k < 25 THEN 'LOW' WHEN k < 50 THEN 'MEDIUM' WHEN k < 75 THEN 'HIGH' WHEN k <= 100 THEN 'CRITICAL' ELSE 'UNKNOWN' END AS tier, CASE s_nationkey % 3 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' END AS mapped, lpad(CAST(s_suppkey AS VARCHAR), 8, '0') || '-' || lower(substr(s_name, 1, 4)) AS code, md5(s_name) AS digest, round(CAST(round(s_acctbal * 100) AS BIGINT) / 100.0, 2) AS major
    FROM (SELECT *, s_suppkey % 103 AS k FROM supplier)
""")
def scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Bands, maps, text, digests, minor units."""
    s = read(spark, sf, "supplier")
    mapped = F.try_element_at(F.create_map(F.lit(0), F.lit("zero"), F.lit(1), F.lit("one")), (F.col("s_nationkey") % 3).cast("int"))
    code = F.concat_ws("-", F.lpad(F.col("s_suppkey").cast("string"), 8, "0"), F.lower(F.substring("s_name", 1, 4)))
    return s.select("s_suppkey", risk_tier(F.col("s_suppkey") % 103).alias("tier"), mapped.alias("mapped"), code.alias("code"), F.md5("s_name").alias("digest"), F.round(minor_to_major(cents("s_acctbal")), 2).alias("major"))


@query("SELECT o_custkey, CAST(len(list(o_orderkey)) AS BIGINT) AS n, CAST(list_sum(list_transform(list(o_orderkey), lambda x: x % 10)) AS BIGINT) AS digits, list_contains(list(o_orderpriority), '1-URGENT') AS urgent FROM orders GROUP BY 1")
def array_functions(spark: SparkSession, sf: str) -> DataFrame:
    """arrays and higher-order functions."""
    g = read(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("k"), F.collect_set("o_orderpriority").alias("p"))
    digits = F.aggregate(F.transform("k", lambda x: x % 10), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return g.select("o_custkey", big(F.size("k")).alias("n"), digits.alias("digits"), F.array_contains("p", "1-URGENT").alias("urgent"))


@query()
def deterministic_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """Hashes stand in for randomness; the engines' hashes differ, so rows are compared by tests."""
    k = F.col("id")
    n = spark.range(10_000).select(bucket(7, "b", 10, k).alias("bucket"), weighted_pick(7, "w", [("a", 3), ("b", 1)], k).alias("pick"))
    return n.groupBy("bucket", "pick").agg(big(F.count(F.lit(1))).alias("n"))


@query()
def checksum(spark: SparkSession, sf: str) -> DataFrame:
    """Two orders of one table have one checksum."""
    o = read(spark, sf, "orders")
    return o.agg(content_checksum(o.columns).alias("checksum")).union(o.orderBy("o_totalprice").agg(content_checksum(o.columns).alias("checksum")))
