"""Landing to gold on a small synthetic feed, twice."""

import pytest
from pyspark.sql import functions as F

from marlstone.plans import config, control, gold, ingest, maintenance, measures, report, runner
from marlstone.sources.generator import Generator, Scale
from marlstone.sources.landing import Landing
from marlstone.sources.store import TableStore
from marlstone.streaming.bronze import ingest_available

from .conftest import rows_of


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('lake')}"
    landing = Landing(spark, f"{root}/landing")
    Generator(spark, Scale(45, 4000, 80, 120, 30)).write(landing)
    lake = ingest.Lake(landing, TableStore(spark, f"{root}/lake"), config.quality_rules(), control.new_run_id())
    for call in (ingest.run_bronze, ingest.run_silver):
        done = runner.run_stage(lambda c, call=call: call(lake, c), config.feed_configs(), retries=0)
        assert {o.status for o in done} == {"succeeded"}, done
    lake.gold = gold.load(lake.store)
    return lake


@pytest.fixture(scope="module")
def star(lake):
    return {n: lake.store.read("gold", n) for n in gold.ORDER}


def test_silver_accounts_for_every_row(lake):
    s = lake.store
    log = {(r["entity"], r["layer"]): r for r in s.read("meta", "run_log").filter(F.col("run_id") == lake.run_id).collect()}
    r = log[("transactions", "silver")]
    assert r["rows_read"] == s.row_count("bronze", "br_transactions") == r["rows_written"] + r["rows_quarantined"] + r["rows_deduped"]
    assert r["rows_quarantined"] > 0
    q = s.read("quarantine", "q_transactions")
    assert q.count() == r["rows_quarantined"] and q.filter("size(_dq_rule_ids) = 0").count() == 0


def test_gold_ties_to_silver(lake, star):
    tx = lake.store.read("silver", "fact_transaction")
    assert star["fact_transaction"].count() == tx.count() == lake.gold["fact_transaction"]
    assert star["fact_transaction"].agg(F.sum("amount_minor")).first() == tx.agg(F.sum("amount_minor")).first()
    for dim, key in measures.KEYS.items():
        if dim in star and dim not in ("dim_currency",):
            d = star[dim]
            assert d.count() == d.select(key).distinct().count()
            if dim != "dim_fx_rate":
                assert d.filter(F.col(key) == -1).count() == 1
            if key in star["fact_transaction"].columns:
                assert star["fact_transaction"].join(d, key, "left_anti").count() == 0
    a, t = star["agg_merchant_daily"], star["fact_transaction"]
    assert a.agg(F.sum("attempt_count"), F.sum("attempted_amount_gbp_minor")).first() == t.agg(F.count("*"), F.sum("amount_gbp_minor")).first()
    assert a.agg(F.sum("distinct_account_count")).first()[0] > t.select("account_sk").distinct().count()


def test_money_and_flags(star):
    t = star["fact_transaction"]
    assert t.filter("fx_rate is null").count() == 0
    assert t.filter("is_approved + is_declined + is_reversed <> 1").count() == 0
    assert t.filter("fx_rate = 1 AND fx_rate_is_carried is not null").count() == 0
    assert t.filter("fx_rate_is_carried").count() > 0


def test_second_run_changes_nothing(lake, star):
    before = {n: rows_of(df.drop("loaded_ts")) for n, df in star.items()}
    for call in (ingest.run_bronze, ingest.run_silver):
        done = runner.run_stage(lambda c, call=call: call(lake, c), config.feed_configs(), retries=0)
        assert sum(o.rows for o in done if o.entity != "card_products") == 0
    gold.load(lake.store)
    for n in gold.ORDER:
        assert rows_of(lake.store.read("gold", n).drop("loaded_ts")) == before[n], n


def test_forced_reload_replaces(lake):
    c = config.config_for(config.feed_configs(), "fx_rates")
    n = lake.store.row_count("bronze", "br_fx_rates")
    ingest.run_bronze(lake, c, force_reload=True)
    assert lake.store.row_count("bronze", "br_fx_rates") == n


def test_gold_loads_before_the_first_dispute(lake, spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/lake")
    for n in lake.store.list_tables("silver"):
        if n != "fact_dispute":
            store.write(lake.store.read("silver", n).limit(300), "silver", n, "overwrite")
    done = gold.load(store)
    assert done["fact_dispute"] == 0 and done["fact_transaction"] == 300 and done["agg_merchant_daily"] > 0


def test_measures_hold_together(star):
    one = measures.evaluate(star, measures.NAMES).first()
    assert len(measures.NAMES) == 36
    assert one["Attempts"] == one["Attempts (agg)"] and abs(one["Authorisation Rate"] - one["Authorisation Rate (agg)"]) < 1e-12
    assert one["Distinct Accounts (per day)"] is None
    by = measures.evaluate(star, ["Decline Rate by Reason"], ["dim_decline_reason.decline_reason_code"]).collect()
    assert abs(sum(r["Decline Rate by Reason"] or 0 for r in by) - 1) < 1e-9
    assert [r["Decline Rate by Reason"] for r in by if r[0] == "N/A"] == [None]
    part = measures.evaluate(star, ["Decline Rate by Reason"], filters={"dim_decline_reason.decline_reason_code": ["LIMIT_EXCEEDED"]}).first()[0]
    assert 0 < part < 1
    months = measures.evaluate(star, ["Attempts", "Disputes Resolved"], ["dim_date.year_month"])
    assert months.agg(F.sum("Attempts")).first()[0] == one["Attempts"]
    with pytest.raises(ValueError):
        measures.evaluate(star, ["Disputes Raised"], ["dim_card_product.tier"])
    with pytest.raises(KeyError):
        measures.evaluate(star, ["Nope"])


def test_report_page(star):
    html = report.page(star)
    assert html.startswith("<!doctype html>") and "http" not in html and html.count("<svg") == 4
    assert report.totals(star).first()["attempts"] == star["fact_transaction"].count()
    assert report.top_merchants(star, 3).count() == 3


def test_formats():
    assert [measures.render(v, f) for v, f in ((None, measures.COUNT), (-5.0, measures.MONEY), (0.123, measures.PERCENT), (1234.4, measures.COUNT), (1.25, measures.ONE), (2.0, measures.SIGNED))] == ["—", "(£5.00)", "12.30%", "1,234", "1.2", "+2.00"]
    with pytest.raises(ValueError):
        measures.render(1.0, "??")


def test_windows_and_batches():
    tx, cust, disp, prod = (config.config_for(config.feed_configs(), e) for e in ("transactions", "customers", "disputes", "card_products"))
    days = ["2024-01-01", "2024-02-01", "2024-06-01"]
    assert ingest.select_window(tx, days, "2024-01-01") == days[1:] and ingest.select_window(tx, days, "2024-01-01", force_reload=True) == days
    assert ingest.select_window(tx, days, None, until_date="2024-02-01") == days[:2]
    assert ingest.select_scope(disp, days, "2024-06-01") == ["2024-06-01"] and ingest.select_scope(disp, days, "2024-04-01") == days[1:]
    assert ingest.select_scope(prod, days, "2024-06-01") == days
    assert ingest.batches(cust, days) == [[d] for d in days] and ingest.batches(tx, days) == [days]
    assert ingest.derive_batch_id("x", days) == "x|2024-01-01|2024-06-01"
    with pytest.raises(ValueError):
        ingest.select_window({**tx, "load_type": "odd"}, days, None)


def test_waves_stop_after_a_failure():
    def call(c):
        if c["entity"] == "accounts":
            raise RuntimeError("no")
        return 1

    done = {o.entity: o for o in runner.run_stage(call, config.feed_configs(), retries=1, wait=0)}
    assert done["accounts"].status == "failed" and done["accounts"].attempts == 2
    assert done["customers"].status == "succeeded" and done["transactions"].status == done["disputes"].status == "not_run"
    assert [len(w) for w in runner.waves(config.feed_configs())] == [2, 3, 1, 1]


def test_reconcile_and_watermarks(lake):
    got = runner.reconcile(lake.store, lake.run_id, [("transactions", "silver"), ("ghost", "silver")])
    assert got[("ghost", "silver")] == "unknown" and got[("transactions", "silver")] in ("succeeded", "skipped")
    assert control.get_watermark(lake.store, "transactions", "silver") is not None
    control.set_watermark(lake.store, "x", "bronze", "1", "b")
    control.reset_watermark(lake.store, "x")
    assert control.get_watermark(lake.store, "x") is None and control.get_watermark(lake.store, "transactions") is not None


def test_failing_rule_stops_the_mark_but_keeps_the_evidence(lake, spark):
    strict = [r for r in lake.rules if r.rule_set != "fx_rates"] + [config.quality_rules()[0].__class__("fx.none", "fx_rates", "rate", "range", {"max": 0}, severity="error")]
    bad = ingest.Lake(lake.landing, lake.store, strict, "bad-run")
    c = config.config_for(config.feed_configs(), "fx_rates")
    mark = control.get_watermark(lake.store, "fx_rates", "silver")
    with pytest.raises(Exception, match="fx.none"):
        ingest.run_silver(bad, c, force_reload=True)
    assert control.get_watermark(lake.store, "fx_rates", "silver") == mark
    assert lake.store.read("meta", "dq_results").filter("run_id = 'bad-run' AND outcome = 'failed_run'").count() == 1
    assert lake.store.read("meta", "run_log").filter("run_id = 'bad-run' AND status = 'failed'").count() == 1


def test_config_round_trip(spark):
    assert len(config.rules_from(config.rules_frame(spark, config.quality_rules()))) == 40
    assert config.config_frame(spark, config.feed_configs()).count() == 7
    with pytest.raises(KeyError):
        config.config_for(config.feed_configs(), "nope")
    with pytest.raises(ValueError):
        config.config_for([{"entity": "a", "enabled": False}], "a")
    assert config.resolve("until_date", "d", ["--until-date", "x"], {}) == "x" and config.resolve("until_date", "d", ["--until-date=y"], {}) == "y"
    assert config.resolve("until_date", "d", [], {"MARLSTONE_UNTIL_DATE": "z"}) == "z" and config.resolve("until_date", "d", [], {}) == "d"


def test_maintenance_keeps_every_table(lake):
    before = {n: lake.store.row_count("gold", n) for n in gold.ORDER}
    done = maintenance.maintain(lake.store, ["silver", "gold"], "m1", retain_hours=0)
    assert {a.status for a in done} == {"applied"} and any(a.removed for a in done)
    assert {n: lake.store.read("gold", n).count() for n in gold.ORDER} == before
    dry = maintenance.maintain(lake.store, ["gold"], "m2", dry_run=True)
    assert {a.status for a in dry} == {"dry_run"}


def test_stream_ingests_each_file_once(lake, spark, tmp_path):
    c = config.config_for(config.feed_configs(), "merchants")
    schema = spark.read.parquet(lake.landing.path("merchants")).schema
    store = TableStore(spark, f"file://{tmp_path}/lake")
    for _ in range(2):
        ingest_available(lake.landing, store, c, schema, str(tmp_path / "cp"))
    assert store.row_count("bronze", "br_merchants") == lake.store.row_count("bronze", "br_merchants")


def test_generator_is_deterministic(spark):
    from marlstone.functions.hashing import content_checksum

    g = Generator(spark, Scale(20, 500, 20, 30, 10))
    a, b = (d.agg(content_checksum(d.columns)).first()[0] for d in (g.transactions(), g.transactions().repartition(3)))
    assert a == b and g.fx_rates().select("rate_date").distinct().count() == 15
