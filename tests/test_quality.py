import datetime as dt

import pytest

from marlstone.operators import contracts, quality
from marlstone.operators.quality import Rule, gate
from marlstone.plans.config import feed_configs, quality_rules

from .conftest import rows_of


def one(spark, rule, rows, schema, refs=None, batch=""):
    g = gate(spark.createDataFrame(rows, schema), [rule], refs, batch)
    (r,) = g.results
    return g, r


CASES = [
    (Rule("r", "s", "x", "not_null"), [(1,), (None,)], 2, 1),
    (Rule("r", "s", "x", "unique"), [(1,), (1,), (2,), (None,), (None,)], 5, 2),
    (Rule("r", "s", "x", "range", {"min": 1, "max": 3}), [(0,), (1,), (3,), (4,), (None,)], 5, 2),
    (Rule("r", "s", "x", "range", {"min": 1}), [(0,), (99,)], 2, 1),
    (Rule("r", "s", "x", "enum_domain", {"values": [1, 2]}), [(1,), (3,), (None,)], 3, 1),
    (Rule("r", "s", "x", "expression", {"predicate": "x > 1"}), [(1,), (2,), (None,)], 3, 2),
    (Rule("r", "s", "x", "not_null", condition="x > 0"), [(1,), (None,), (-1,)], 1, 0),
    (Rule("r", "s", "x", "unique", condition="x = 2"), [(1,), (1,), (2,)], 1, 0),
]


@pytest.mark.parametrize("rule, rows, evaluated, failed", CASES)
def test_row_rules(spark, rule, rows, evaluated, failed):
    g, r = one(spark, rule, rows, "x int")
    assert (r.evaluated, r.failed, g.rows_in, g.rows_quarantined) == (evaluated, failed, len(rows), failed)
    assert r.outcome == ("quarantined" if failed else "passed")
    assert g.clean.count() == len(rows) - failed and g.clean.columns == ["x"]


def test_referential(spark):
    ref = {("silver", "d"): spark.createDataFrame([(1,), (1,), (2,)], "k int")}
    params = {"ref_layer": "silver", "ref_table": "d", "ref_column": "k"}
    g, r = one(spark, Rule("s.x.ref", "s", "x", "referential", params), [(1,), (3,), (None,)], "x int", ref)
    assert (r.failed, g.clean.count()) == (2, 1)
    _, r = one(spark, Rule("s.x.ref", "s", "x", "referential", params), [(1,)], "x int")
    assert r.outcome == "not_evaluated" and not r.fails_run
    g, r = one(spark, Rule("s.x.ref", "s", "x", "referential", params, severity="error"), [(1,)], "x int")
    assert r.outcome == "failed_run" and g.failed


def test_every_reason_and_the_worst_severity(spark):
    rules = [Rule("a", "s", "x", "range", {"max": 1}), Rule("b", "s", "x", "enum_domain", {"values": [1]}, severity="error")]
    g = gate(spark.createDataFrame([(1,), (5,)], "x int"), rules)
    (q,) = g.quarantined.collect()
    assert (list(q["_dq_rule_ids"]), q["_dq_severity"]) == (["a", "b"], "error")
    with pytest.raises(quality.QualityFailure, match="b"):
        g.raise_if_failed("s")


@pytest.mark.parametrize("threshold, fails", [(None, False), (40.0, True), (50.0, False)])
def test_warnings_fail_by_rate_only(spark, threshold, fails):
    _, r = one(spark, Rule("r", "s", "x", "not_null", threshold=threshold), [(1,), (None,)], "x int")
    assert r.failed_pct == 50.0 and r.fails_run is fails


def test_batch_rules_use_the_batch_date(spark):
    rows = [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 4),)]
    _, r = one(spark, Rule("r", "s", "d", "continuity", {"max_missing_days": 1}), rows, "d date")
    assert (r.outcome, r.failed, r.detail.split()[0]) == ("batch_warn", 0, "2")
    _, r = one(spark, Rule("r", "s", "d", "freshness", {"max_age_days": 3}), rows, "d date", batch="f|2024-01-01|2024-01-08")
    assert r.breached and not r.fails_run
    _, r = one(spark, Rule("r", "s", "d", "freshness", {"max_age_days": 4}), rows, "d date", batch="f|2024-01-01|2024-01-08")
    assert r.outcome == "passed"
    _, r = one(spark, Rule("r", "s", "d", "freshness", {"max_age_days": 4}), [(None,)], "d date", batch="f|2024-01-01|2024-01-08")
    assert r.breached


def test_missing_columns_and_empty_sets_are_fatal(spark):
    with pytest.raises(quality.QualityFailure):
        one(spark, Rule("r", "s", "nope", "not_null"), [(1,)], "x int")
    with pytest.raises(quality.QualityFailure):
        quality.rules_for(quality_rules(), "nothing")


def test_type_gate_survives_garbage(spark):
    df = spark.createDataFrame([("1", "2024-02-30", "x"), ("2", "2024-02-01", "y"), (None, None, None)], "amount_minor string, auth_ts string, other string")
    rules = contracts.castable_rules(df, "transactions", contracts.types_for("transactions"))
    assert [r.column for r in rules] == ["amount_minor", "auth_ts"]
    g = gate(df, rules)
    assert g.rows_quarantined == 1 and g.quarantined.first()["auth_ts"] == "2024-02-30"
    typed = contracts.apply_types(g.clean, contracts.types_for("transactions"))
    assert dict(typed.dtypes) == {"amount_minor": "bigint", "auth_ts": "timestamp", "other": "string"}
    assert contracts.castable_rules(typed, "transactions", contracts.types_for("transactions")) == []
    with pytest.raises(KeyError):
        contracts.types_for("nope")


def test_configured_rules_are_valid():
    sets = {c["dq_rule_set"] for c in feed_configs()}
    assert quality.validate_rules(quality_rules(), sets) == [] and len(quality_rules()) == 40
    bad = [Rule("a", "nope", "x", "castable", severity="error", threshold=1.0), Rule("a", "accounts", "x", "enum_domain")]
    assert len(quality.validate_rules(bad, {"accounts", "lonely"})) >= 6


def test_empty_batch(spark):
    g = gate(spark.createDataFrame([], "x int"), [Rule("r", "s", "x", "not_null")])
    assert g.rows_in == 0 and rows_of(g.clean) == [] and not g.failed
