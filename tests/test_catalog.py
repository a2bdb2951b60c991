"""Every registered query against its SQL twin."""

import pytest

from marlstone import catalog, lake_catalog  # noqa: F401


def plain(v):
    return None if v is None or v != v else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, data, name):
    df = catalog.QUERIES[name](spark, data)
    got = duck.sql(catalog.ORACLE_SQL[name])
    names = sorted(df.columns)
    assert names == sorted(got.columns)
    at = [got.columns.index(c) for c in names]
    want = sorted(repr([plain(r[i]) for i in at]) for r in got.fetchall())
    assert sorted(repr([plain(r[c]) for c in names]) for r in df.collect()) == want
    assert want


def test_rows_only_queries(spark, data):
    assert len(set(catalog.QUERIES["checksum"](spark, data).collect())) == 1
    n = {r["bucket"]: 0 for r in catalog.QUERIES["deterministic_bucket"](spark, data).collect()}
    assert len(n) == 10


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_interval_joins_stay_hash_joins(spark, data):
    plan = catalog.QUERIES["pit_join"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
