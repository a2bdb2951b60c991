import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import dates, hashing, values
from marlstone.operators import keys, lookup, merge, project, security

from .conftest import rows_of


def test_lookup_keeps_every_fact_and_null_keys(spark):
    f = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    d = spark.createDataFrame([("a", 10)], "k string, sk int")
    for split in (False, True):
        got = {r["id"]: r["sk"] for r in lookup.lookup(f, d, {"k": "k"}, {"sk": "sk"}, {"sk": -1}, split).collect()}
        assert got == {1: 10, 2: -1, 3: -1}


def test_point_in_time_is_half_open(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    d = spark.createDataFrame([("a", t(1), t(5), 1), ("a", t(5), dates.OPEN_TS, 2)], "k string, valid_from timestamp, valid_to timestamp, sk int")
    f = spark.createDataFrame([(1, "a", t(1)), (2, "a", t(5)), (3, "a", dt.datetime(2023, 12, 31))], "id int, k string, at timestamp")
    assert {r["id"]: r["sk"] for r in lookup.pit_lookup(f, d, {"k": "k"}, "at", {"sk": "sk"}, {"sk": -1}).collect()} == {1: 1, 2: 2, 3: -1}


def test_merge_source_must_be_unique(spark):
    with pytest.raises(merge.DuplicateKeys):
        merge.assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_upsert_counts_only_changes(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "k int, _row_hash long")
    s = spark.createDataFrame([(1, 10), (2, 21), (3, 30)], "k int, _row_hash long")
    out = merge.upsert_if_changed(t, s, ["k"], action="__action")
    assert tuple(merge.changes(out).first()) == (1, 1, 1) and out.count() == 3


def test_surrogate_keys_agree(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"))
    a, b = keys.surrogate_keys(df, ["k"], "sk", 5), keys.surrogate_keys(df, ["k"], "sk", 5, parallel=True)
    assert rows_of(a) == rows_of(b)
    one = keys.ensure_member(a, "sk", {"sk": -1, "k": None})
    assert keys.ensure_member(one, "sk", {"sk": -1}).filter("sk = -1").count() == 1 and keys.highest_key(one, "sk") == 1005


def test_hash_ignores_column_order_and_tells_null_from_empty(spark):
    a = spark.createDataFrame([("x", None)], "p string, q string")
    b = spark.createDataFrame([(None, "x")], "q string, p string")
    c = spark.createDataFrame([("x", "")], "p string, q string")
    h = [d.select(hashing.row_hash(d.columns).alias("h")).first()["h"] for d in (a, b, c)]
    assert h[0] == h[1] != h[2]
    with pytest.raises(ValueError):
        hashing.row_hash([])


def test_deterministic_draws(spark):
    k = F.col("id")
    df = spark.range(20_000).select(hashing.uniform(1, "u", k).alias("u"), hashing.pick(1, "p", ["a", "b"], k).alias("p"), hashing.weighted_pick(1, "w", [("x", 9), ("y", 1)], k).alias("w"), hashing.chance(1, "c", 0.25, k).alias("c"))
    r = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.avg((F.col("p") == "a").cast("int")), F.avg((F.col("w") == "x").cast("int")), F.avg(F.col("c").cast("int"))).first()
    assert 0 <= r[0] < r[1] < 1 and abs(r[2] - 0.5) < 0.02 and abs(r[3] - 0.5) < 0.02 and abs(r[4] - 0.9) < 0.02 and abs(r[5] - 0.25) < 0.02
    assert rows_of(df) == rows_of(df.repartition(3))


def test_money_and_safe_division(spark):
    df = spark.createDataFrame([(100, 0), (100, 2), (105, 3), (100, 9)], "a long, d int")
    got = [r[0] for r in df.select(values.convert_minor(F.col("a"), F.lit("1.5").cast("decimal(18,8)"), values.scale_to_two_digits(F.col("d")))).collect()]
    assert got == [15000, 150, 16, None]
    one = spark.range(1)
    assert one.select(values.safe_divide(F.lit(1), F.lit(0))).first()[0] is None
    assert one.select(values.safe_divide(F.lit(None), F.lit(2))).first()[0] is None
    assert one.select(values.bps(F.lit(1), F.lit(4))).first()[0] == 2500.0
    assert [one.select(values.risk_tier(F.lit(x))).first()[0] for x in (0, 24, 25, 50, 75, 100, 101)] == ["LOW", "LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL", "UNKNOWN"]


def test_calendar_functions(spark):
    r = spark.sql("SELECT date'1900-01-01' AS d").select(dates.monday_dow(F.col("d")), dates.date_key(F.col("d")), dates.month_end(F.col("d"))).first()
    assert tuple(r) == (1, 19000101, dt.date(1900, 1, 31))


def test_warehouse_types():
    assert [values.warehouse_type(t) for t in ("bit", "varchar(20)", "datetime2(6)", "decimal(18, 8)", "bigint")] == ["boolean", "varchar(20)", "timestamp", "decimal(18,8)", "bigint"]
    with pytest.raises(ValueError):
        values.warehouse_type("geometry")


def test_masks(spark):
    df = spark.createDataFrame([("ann@x.org", "Anna Hall"), (None, "Al")], "e string, n string")
    got = security.masked(df, {"e": values.mask_email(F.col("e")), "n": values.mask_partial(F.col("n"), 1, "***", 1)}).collect()
    assert [tuple(r) for r in got] == [("aXXX@XXXX.com", "A***l"), (None, "***")]
    assert values.mask_default(F.col("x"), T.DateType()) is not None


def test_region_filter(spark):
    df = spark.createDataFrame([(1, "N"), (2, "S"), (3, None)], "id int, region string")
    access = spark.createDataFrame([("a", "N"), ("b", "*"), ("b", "N")], "principal_name string, region string")
    ids = lambda p: sorted(r["id"] for r in security.region_filter(df, access, principal=p).collect())
    assert ids("a") == [1] and ids("b") == [1, 2, 3] and ids("c") == []
    security.secure_view(df, "seen", access, {"region": F.lit("?")} if False else None)
    assert spark.sql("SELECT * FROM seen").count() == 0


def test_audit_columns(spark, tmp_path):
    spark.range(3).select(F.col("id").alias("b"), F.lit("x").alias("a"), F.lit("2024-01-01").alias("ingest_date")).write.json(str(tmp_path / "x"))
    df = project.add_audit_columns(spark.read.json(str(tmp_path / "x")), "batch|1|2")
    assert set(project.AUDIT) <= set(df.columns) and df.filter("_source_file like '%json'").count() == 3
    assert project.business_columns(df) == ["a", "b"] and project.payload_columns(df, "b") == ["a"]
    with pytest.raises(ValueError):
        project.add_audit_columns(spark.range(1).select(F.lit("d").alias("ingest_date")), "b")
