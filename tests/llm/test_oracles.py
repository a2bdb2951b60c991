"""Corpus queries against their SQL twins."""

import pytest

from marlstone.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, duck, data, name):
    df, want = queries.QUERIES[name](spark, data), duck.sql(queries.ORACLE_SQL[name])
    names = sorted(want.columns)
    at = [want.columns.index(c) for c in names]
    assert sorted(df.columns) == names
    assert sorted(repr([r[c] for c in names]) for r in df.collect()) == sorted(repr([r[i] for i in at]) for r in want.fetchall())
