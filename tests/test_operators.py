import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starload.functions.dates import (
    in_month_before,
    month_key,
    parse_as_of,
    slice_key,
    us_date,
    us_date_from_parts,
)
from starload.functions.fingerprint import row_hash, with_row_hash
from starload.functions.sizing import broadcast_if_bounded, estimated_bytes, is_small, measured_bytes
from starload.operators.facts import with_load_stamp
from starload.operators.lookup import flatten_snowflake, lookup, lookup_surrogates, one_row_per_key
from starload.operators.slicing import referenced_rows, sample_dates, slice_all_months, slice_month
from starload.operators.standardize import retype, standardize
from starload.operators.summarize import auto_summarize, default_policy
from starload.schemas import LAYERS, TABLES, conform, empty_table, missing_columns, schema_of


# schemas


def test_declared_tables():
    counts = {layer: sum(1 for key in TABLES if key[0] == layer) for layer in LAYERS}
    assert counts == {"ods": 6, "stg": 6, "dwh": 4}
    assert all(f.dataType.simpleString() == "string" for (l, _), s in TABLES.items() if l == "ods" for f in s)
    assert len(schema_of("dwh", "customer_dim")) == 17 and len(schema_of("dwh", "sales")) == 12
    with pytest.raises(KeyError):
        schema_of("dwh", "nothing")


def test_conform_reorders_drops_and_checks(spark):
    df = spark.createDataFrame([("7", "x", "e", "c", "r")], "TerritoryId string, junk string, Continent string, Country string, Region string")
    found = conform(df, schema_of("stg", "territory"))
    assert found.schema == schema_of("stg", "territory")
    assert found.first()["TerritoryId"] == 7
    with pytest.raises(ValueError, match="Region"):
        conform(df.drop("Region"), schema_of("stg", "territory"))
    too_wide = df.withColumn("TerritoryId", F.lit(3_000_000_000))
    with pytest.raises(PySparkException):
        conform(too_wide, schema_of("stg", "territory")).collect()


def test_missing_columns(spark):
    assert missing_columns(spark.range(1), ["id", "a", "b"], ignore=["b"]) == ["a"]
    assert empty_table(spark, "dwh", "sales").schema == schema_of("dwh", "sales")


# types and dates


def test_retype_tolerant_and_strict(spark):
    df = spark.createDataFrame([("1", "2/3/2015"), ("x", "2015-02-03"), (None, None)], "a string, d string")
    found = retype(df, {"a": "bigint", "d": "us_date"}).collect()
    assert [tuple(r) for r in found] == [(1, dt.date(2015, 2, 3)), (None, None), (None, None)]
    for column, kind in (("a", "bigint"), ("d", "us_date")):
        with pytest.raises(PySparkException):
            retype(df, {column: kind}, tolerant=False).collect()
    good = retype(df.where("a = '1'"), {"a": "bigint", "d": "us_date"}, tolerant=False)
    assert tuple(good.first()) == (1, dt.date(2015, 2, 3))


def test_standardize_renames_after_typing(spark):
    df = spark.createDataFrame([("5",)], "CustomerKey string")
    found = standardize(df, {"CustomerKey": "bigint"}, {"CustomerKey": "CustomerId"})
    assert found.schema.simpleString() == "struct<CustomerId:bigint>"


@pytest.mark.parametrize("text, day", [("1/2/2015", dt.date(2015, 1, 2)), ("12/31/2017", dt.date(2017, 12, 31)), ("13/1/2015", None), ("2/30/2015", None), ("junk", None), ("1/2", None), (None, None)])
def test_us_dates(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string")
    found = df.select(us_date(F.col("t")), us_date_from_parts(F.col("t"))).first()
    assert tuple(found) == (day, day)


def test_leading_zeros_in_parts(spark):
    df = spark.createDataFrame([("01/02/2015",)], "t string")
    assert df.select(us_date_from_parts(F.col("t"))).first()[0] == dt.date(2015, 1, 2)


def test_as_of_forms():
    day = dt.datetime(2025, 5, 1)
    assert {parse_as_of(v) for v in ("20250501", "2025-05-01", "2025-05-01 00:00:00", day, day.date())} == {day}
    with pytest.raises(ValueError):
        parse_as_of("May 2025")


def test_month_helpers(spark):
    days = spark.createDataFrame([(dt.date(2015, 12, 31),), (dt.date(2016, 1, 1),)], "d date")
    found = days.select(month_key(F.col("d")), slice_key(F.col("d")), in_month_before(F.col("d"), "20160101"))
    assert [tuple(r) for r in found.collect()] == [("20151201", "20160101", True), ("20160101", "20160201", False)]


def test_month_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(dt.date(2015, 12, 31),)], "d date").write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    plan = df.where(in_month_before(F.col("d"), "20160101"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2015-12-01)" in plan and "LessThanOrEqual(d,2015-12-31)" in plan


# fingerprints


def test_fingerprints(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|b", None, None), ("a", "", "b")], "x string, y string, z string")
    plain = [r[0] for r in df.select(row_hash(df.columns)).collect()]
    safe = [r[0] for r in df.select(row_hash(df.columns, safe=True)).collect()]
    assert plain[0] == plain[1] == plain[2] != plain[3]
    assert len(set(safe)) == 4
    import hashlib

    assert plain[0] == hashlib.md5(b"a|b").hexdigest()
    assert "hash_value" in with_row_hash(df, ["x"]).columns


# lookups


def test_lookup_keeps_unmatched_and_multiplies_matches(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "key int, v string")
    found = sorted((tuple(r) for r in lookup(left, right, {"k": "key"}, ["v"]).collect()), key=str)
    assert found == [(1, "a"), (1, "b"), (2, None), (None, None)]
    safe = lookup(left, right, {"k": "key"}, {"v": "w"}, null_safe=True)
    assert (None, "n") in [tuple(r) for r in safe.collect()] and safe.columns == ["k", "w"]


def test_surrogates_by_key_only(spark):
    dim = spark.createDataFrame([(1, 1001), (1, 1001), (2, 1002)], "id int, rk int")
    assert sorted(tuple(r) for r in one_row_per_key(dim, "id", "rk").collect()) == [(1, 1001), (2, 1002)]
    facts = spark.createDataFrame([(1,), (1,), (3,)], "CustomerId int")
    found = lookup_surrogates(facts, [(dim, "id", "rk", "CustomerId")])
    assert sorted(((r["CustomerId"], r["rk"]) for r in found.collect()), key=str) == [(1, 1001), (1, 1001), (3, None)]


def test_three_level_hierarchy(spark):
    leaf = spark.createDataFrame([(1, 10), (2, 20), (3, 99)], "p int, s int")
    middle = spark.createDataFrame([(10, "ten", 100), (20, "twenty", 999)], "sk int, sname string, ck int")
    top = spark.createDataFrame([(100, "hundred")], "ck2 int, cname string")
    found = flatten_snowflake(leaf, [(middle, {"s": "sk"}, ["sname"]), (top, {"ck": "ck2"}, ["cname"])])
    assert found.columns == ["p", "s", "sname", "cname"]
    assert sorted(tuple(r) for r in found.collect()) == [(1, 10, "ten", "hundred"), (2, 20, "twenty", None), (3, 99, None, None)]


def test_broadcast_needs_a_checked_size(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    assert is_small(stored) and estimated_bytes(stored) > 0
    unknown = spark.createDataFrame([(i, "x" * 10) for i in range(100)], "a int, b string")
    assert not is_small(unknown)
    assert measured_bytes(unknown) == 100 * (16 + 24) + 1000
    hinted = broadcast_if_bounded(unknown)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint (strategy=broadcast)" in hinted
    assert broadcast_if_bounded(unknown, 0) is unknown
    import starload.functions.sizing as sizing

    original = sizing.measured_bytes
    sizing.measured_bytes = lambda df: 1 << 40
    try:
        assert broadcast_if_bounded(unknown) is unknown
    finally:
        sizing.measured_bytes = original


def test_a_dimension_beyond_what_a_small_driver_builds_is_shuffled(spark, tmp_path):
    """A hash table of 16 MB of counted keys takes the driver several times that; it had 256 MB."""
    spark.range(1_200_000).selectExpr("CAST(id AS INT) AS key", "CAST(id AS INT) AS rk").write.parquet(str(tmp_path / "dim"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        dim = spark.read.parquet(str(tmp_path / "dim"))
        assert measured_bytes(dim) == 1_200_000 * 32
        facts = spark.range(10).selectExpr("CAST(id AS INT) AS k")
        found = lookup_surrogates(facts, [(dim, "key", "rk", "k")])
        assert [tuple(r) for r in found.orderBy("k").collect()] == [(i, i) for i in range(10)]
        assert "strategy=broadcast" not in found._jdf.queryExecution().analyzed().toString()
        hinted = broadcast_if_bounded(dim.where("key < 400000"))._jdf.queryExecution().analyzed().toString()
        assert "strategy=broadcast" in hinted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_lookup_key_is_split(spark, tmp_path):
    """A third of the facts on one key: adaptive execution splits that partition."""
    facts = spark.range(0, 300_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.md5(F.col("id").cast("string")).alias("payload"))
    facts.write.parquet(str(tmp_path / "facts"))
    spark.range(300_000).selectExpr("id AS key", "id + 1000 AS rk").write.parquet(str(tmp_path / "dim"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # several map tasks, as any large table has; a partition is split by map task
        "spark.sql.files.maxPartitionBytes": "300KB",
        "spark.sql.files.openCostInBytes": "1KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dim = spark.read.parquet(str(tmp_path / "dim"))
        facts = spark.read.parquet(str(tmp_path / "facts"))
        found = lookup_surrogates(facts, [(dim, "key", "rk", "k")], broadcast_limit=0)
        total = found.selectExpr("sum(rk - k)", "count(*)", "max(length(payload))")
        assert tuple(total.collect()[0]) == (300_000_000, 300_000, 32)
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# facts


def test_load_stamp(spark):
    assert with_load_stamp(spark.range(1)).schema["processed_dttm"].dataType.simpleString() == "timestamp_ntz"


# slicing


@pytest.fixture(scope="module")
def sales(spark):
    rows = [(1, "a", dt.date(2015, 1, 31)), (2, "a", dt.date(2015, 1, 1)), (3, "b", dt.date(2015, 3, 1)), (4, "b", None)]
    return spark.createDataFrame(rows, "n int, CustomerKey string, d date")


def test_sample_date_lists(sales):
    assert [r[0] for r in sample_dates(sales.where("d IS NOT NULL"), F.col("d")).collect()] == ["20150101", "20150301"]
    following = sample_dates(sales.where("d IS NOT NULL"), F.col("d"), following=True)
    assert [r[0] for r in following.collect()] == ["20150201", "20150401"]


def test_single_month_equals_its_slice(sales):
    one = sorted(r["n"] for r in slice_month(sales, F.col("d"), "20150201").collect())
    of_all = slice_all_months(sales, F.col("d")).where("sample_date = '20150201'")
    assert one == sorted(r["n"] for r in of_all.collect()) == [1, 2]
    assert slice_month(sales, F.col("d"), "20150101").count() == 0


def test_referenced_rows_are_distinct(spark, sales):
    dim = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("c", 3)], "CustomerKey string, v int")
    found = referenced_rows(slice_all_months(sales, F.col("d")), dim, {"CustomerKey": "CustomerKey"})
    assert sorted(tuple(r) for r in found.collect()) == [("20150201", "a", 1), ("20150201", "a", 2)]


# reports


def test_default_policy_counts():
    chosen = [rule for (layer, name), schema in TABLES.items() for rule in default_policy(schema).values()]
    assert {r: chosen.count(r) for r in ("sum", "count")} == {"sum": 19, "count": 15}


def test_auto_summarize(spark):
    df = spark.createDataFrame([("x", 1, 10, 2.5), ("x", None, 20, 1.0), ("y", 3, None, None)], "g string, ItemId int, q int, w double")
    found = {r["g"]: tuple(r)[1:] for r in auto_summarize(df, ["g"]).collect()}
    assert found == {"x": (1, 30, 3.5), "y": (1, None, None)}
    assert auto_summarize(df, ["g"]).columns == ["g", "count_ItemId", "sum_q", "sum_w"]
    assert tuple(auto_summarize(df, columns=["q"]).first()) == (30,)
    with pytest.raises(ValueError, match="grouping"):
        auto_summarize(df, ["q"])
    with pytest.raises(ValueError, match="no default"):
        auto_summarize(df, columns=["g"])
