"""Histories in buckets, with fingerprints and key filters; layouts that are read in part."""

import random
from dataclasses import replace
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starload.functions.dates import us_date
from starload.functions.keyfilter import FilterShape, build_filter, maybe_in, merge_filters
from starload.operators.fingerprinted import scd2_merge_fingerprinted, touched_keys, with_fingerprint
from starload.operators.scd2 import KeyFilter, new_rows, scd2_merge
from starload.operators.slicing import sample_dates, slice_month
from starload.plans.jobs import Warehouse, backfill_months, load_dimension, run_month
from starload.schemas import empty_frame, schema_of
from starload.sources.buckets import Buckets, bucket_number, dealt, read_buckets, write_buckets
from starload.sources.clustered import (
    UNDATED,
    find_keys,
    read_by_month,
    read_month,
    slices_of,
    store_by_month,
    write_clustered,
)
from starload.sources.history import publish_history, read_history
from starload.sources.keyfilters import read_filter
from starload.sources.scratch import materialize
from starload.sources.tables import replace_table
from tests.fixtures import AS_OF, MERGED, SPEC, rows, source, stamp, target
from tests.test_backfill import DATES, HISTORY, SNAPSHOT, _content, _feeds, one_by_one, presences
from tests.test_backfill import SPEC as PAIRS
from tests.test_scd2 import by_text


@pytest.fixture
def without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_lines(df):
    """Depth and text of the operators of a plan, as it would run."""
    conf, key = df.sparkSession.conf, "spark.sql.maxMetadataStringLength"  # else filters are cut short
    before = conf.get(key)
    conf.set(key, "5000")
    text = df._jdf.queryExecution().executedPlan().toString()
    conf.set(key, before)
    found = []
    for line in text.splitlines():
        body = line.lstrip(" :+-*(0123456789)")
        found.append((len(line) - len(line.lstrip(" :+-")), body))
    return found


def below(lines, name):
    """For each operator of that name the texts of all operators below it."""
    for i, (depth, text) in enumerate(lines):
        if text.startswith(name):
            inside = []
            for inner, other in lines[i + 1 :]:
                if inner <= depth:
                    break
                inside.append(other)
            yield text, inside


# buckets


def bucketed(spark, df, path, buckets):
    write_buckets(dealt(df, buckets), path, buckets)
    return read_buckets(spark, path, df.schema, buckets)


def test_bucketed_history_is_not_shuffled(spark, tmp_path, without_broadcast):
    found, buckets = presences(11), Buckets(4, ("a", "b"))
    history = one_by_one(spark, found, PAIRS, dates=DATES[:3])
    stored = bucketed(spark, history, f"{tmp_path}/dim", buckets)
    one = materialize(spark.createDataFrame([r for r in found if r[-1] == DATES[3]], SNAPSHOT).drop("sample_date"))
    result = scd2_merge(one, stored, PAIRS, DATES[3], stamp())
    for df in (result.merged, result.close, new_rows(one, stored, PAIRS)):
        lines = plan_lines(df)
        scans = [text for _, text in lines if text.startswith("FileScan") and f"{tmp_path}/dim" in text]
        assert scans and all("Bucketed: true" in text for text in scans)
        for exchange, inside in below(lines, "Exchange hashpartitioning"):
            assert not any(f"{tmp_path}/dim" in text for text in inside), exchange
    assert by_text(map(tuple, result.full_in_buckets(buckets).collect())) == by_text(
        map(tuple, scd2_merge(one, history, PAIRS, DATES[3], stamp()).full.collect())
    )


def test_rows_of_a_bucket_lie_in_its_files(spark, tmp_path):
    df = spark.range(500).selectExpr("CAST(id AS INT) AS a", "CAST(id % 7 AS STRING) AS b")
    stored = bucketed(spark, df, f"{tmp_path}/t", Buckets(3, ("a", "b")))
    assert bucket_number(spark, f"{tmp_path}/t") == 3 and bucket_number(spark, str(tmp_path)) is None
    placed = stored.select("a", "b", F.regexp_extract("_metadata.file_name", "_([0-9]{5})\\.", 1).cast("int").alias("found"))
    wrong = placed.where(F.pmod(F.hash("a", "b"), F.lit(3)) != F.col("found")).count()
    assert wrong == 0 and placed.count() == 500 and spark.catalog.listTables() == []
    with pytest.raises(ValueError):
        Buckets(0, ("a",))


def test_warehouse_layouts_hold_the_same(spark, tmp_path):
    dates = ["20150201", "20150301", "20150401"]
    _feeds(spark, f"{tmp_path}/raw")
    plain = Warehouse(spark, f"{tmp_path}/plain", f"{tmp_path}/raw")
    backfill_months(plain, dates, stamp(), stamp())
    other = Warehouse(spark, f"{tmp_path}/other", f"{tmp_path}/raw", buckets=2, filter_bits=12)
    run_month(other, dates[0], stamp(), stamp())
    backfill_months(other, dates[1:2], stamp(), stamp())
    run_month(other, dates[2], stamp(), stamp())
    assert _content(other) == _content(plain)


def test_late_snapshot_into_buckets(spark, tmp_path):
    schema = schema_of("stg", "territory")
    whs = [Warehouse(spark, f"{tmp_path}/{n}", "", buckets=n) for n in (None, 3)]
    for wh in whs:
        for date, names in (("20150201", "ab"), ("20150401", "cb"), ("20150301", "dd")):
            staged = [(name, name, name, i) for i, name in enumerate(names)]
            replace_table(spark.createDataFrame(staged, schema), wh.path("stg", "territory"))
            load_dimension(wh, "territory", date, stamp())
    a, b = (by_text(map(tuple, wh.dimension("territory").collect())) for wh in whs)
    assert a == b and len(a) == 5


def test_closed_rows_that_no_version_reads_are_removed(spark, tmp_path):
    path, far = f"{tmp_path}/dim", "TIMESTAMP_NTZ '9999-12-31 23:59:59'"
    one = target(spark).coalesce(1)
    for complete in (False, False, True, False, False, False):
        publish_history(one, path, SPEC.end, far, complete)
    left = {p.split("/")[-2] for p in glob(f"{path}/version-*/__open=false")}
    assert left == {f"version-{i:08d}" for i in (3, 4, 5, 6)}
    assert {p.split("/")[-2] for p in glob(f"{path}/version-*/__open=true")} == {"version-00000005", "version-00000006"}
    closed = one.where(f"{SPEC.end} < {far}").count()
    assert read_history(spark, path, one.schema).count() == one.count() + 3 * closed


# fingerprints


def test_fingerprinted_merge_equals_the_merge(spark):
    found, plain, hashed = presences(12), None, None
    pick = random.Random(5)
    order = DATES[:]
    pick.shuffle(order)  # late snapshots and, below, a corrected date
    plain = empty_frame(spark, HISTORY)
    hashed = with_fingerprint(plain, PAIRS)
    for date in order + [order[2]]:
        one = spark.createDataFrame([r for r in found if r[-1] == date and pick.random() < 0.9], SNAPSHOT)
        one = materialize(one.drop("sample_date").withColumn("y", F.expr(f"IF(a = {len(date) % 3}, 5, y)")))
        a, b = scd2_merge(one, plain, PAIRS, date, stamp()), scd2_merge_fingerprinted(one, hashed, PAIRS, date, stamp())
        for name in ("insert", "close", "corrected", "rejected"):
            theirs = getattr(b, name).drop("row_hash")
            assert rows(getattr(a, name), theirs.columns) == rows(theirs, theirs.columns), name
        plain, hashed = materialize(a.full), materialize(b.full)
        assert rows(plain, plain.columns) == rows(hashed, plain.columns)
    again = with_fingerprint(hashed.drop("row_hash"), PAIRS)
    assert rows(again, again.columns) == rows(hashed, again.columns)


def test_fingerprinted_merge_with_null_keys_and_versions(spark):
    rejected = [(None, "x", "y", "1.0")]
    both = source(spark).unionByName(source(spark, rejected))
    result = scd2_merge_fingerprinted(both, with_fingerprint(target(spark), SPEC), SPEC, AS_OF, stamp())
    assert rows(result.full) == by_text(MERGED) and result.rejected.count() == 1
    with pytest.raises(ValueError, match="literal"):
        scd2_merge_fingerprinted(both, with_fingerprint(target(spark), SPEC), replace(SPEC, literal_intervals=True), AS_OF)


def test_wide_columns_are_read_for_touched_keys_only(spark, tmp_path, without_broadcast):
    stored = with_fingerprint(target(spark), SPEC)
    stored.write.parquet(f"{tmp_path}/dim")
    dim = spark.read.schema(stored.schema).parquet(f"{tmp_path}/dim")
    snapshot = materialize(source(spark))
    wide = ("model_nm", "hall_cd", "rate_no")
    narrow = plan_lines(touched_keys(snapshot, dim, SPEC, AS_OF))
    scans = [text for _, text in narrow if text.startswith("FileScan") and f"{tmp_path}/dim" in text]
    assert len(scans) == 2 and not any(name in text for text in scans for name in wide)
    result = scd2_merge_fingerprinted(snapshot, dim, SPEC, AS_OF, stamp(), broadcast_limit=1 << 20)
    lines = plan_lines(result.insert)
    first = [text for text, _ in below(lines, "BroadcastHashJoin") if "LeftSemi" in text]
    assert first, lines
    # nothing of the history is shuffled before it has met the touched keys
    for exchange, inside in below(lines, "Exchange hashpartitioning"):
        if any(f"{tmp_path}/dim" in text and any(w in text for w in wide) for text in inside):
            assert any("LeftSemi" in text for text in inside), exchange


# key filters


def answers(spark, shape, known, asked):
    keys = spark.createDataFrame([(k,) for k in known], "k string")
    found = materialize(build_filter(keys, ["k"], shape))
    df = spark.createDataFrame([(k,) for k in asked], "k string")
    return dict(maybe_in(df, ["k"], found, shape).distinct().collect())


def test_known_keys_are_always_found(spark):
    known = [f"k{i}" for i in range(3000)] + [None, ""]
    other = [f"x{i}" for i in range(3000)]
    shape = FilterShape.for_keys(3002)
    said = answers(spark, shape, known, known + other)
    assert all(said[k] for k in known)
    assert sum(said[k] for k in other) < 100
    assert FilterShape.for_keys(10**6).capacity() >= 10**6 and FilterShape.for_keys(0).blocks == 1
    none = answers(spark, shape, [], other)
    assert not any(none.values())


def test_filters_of_one_shape_merge(spark):
    shape = FilterShape(3, hashes=4)
    parts = [spark.createDataFrame([(f"{p}{i}",) for i in range(400)], "k string") for p in "ab"]
    merged = merge_filters(build_filter(parts[0], ["k"], shape).unionByName(build_filter(parts[1], ["k"], shape)))
    whole = build_filter(parts[0].unionByName(parts[1]), ["k"], shape)
    assert by_text(map(tuple, merged.collect())) == by_text(map(tuple, whole.collect()))


@pytest.mark.parametrize("full", [False, True])
def test_colliding_filter_changes_no_result(spark, full):
    src, tgt = source(spark), target(spark)
    shape = FilterShape(1, hashes=1)
    blocks = build_filter(tgt, ["MachineId"], shape)
    if full:  # every bit set: nothing is surely new
        blocks = build_filter(spark.range(400_000).selectExpr("CAST(id AS INT) AS MachineId"), ["MachineId"], shape)
        assert blocks.selectExpr("bitmap_count(bitmap)").first()[0] > 32_700
    result = scd2_merge(src, tgt, SPEC, AS_OF, stamp(), key_filter=KeyFilter(blocks, shape))
    assert rows(result.full) == by_text(MERGED)


def test_filter_of_another_key_type_is_not_asked(spark):
    wide = target(spark).withColumn("MachineId", F.col("MachineId").cast("long"))
    shape = FilterShape(1)
    key_filter = KeyFilter(build_filter(wide, ["MachineId"], shape), shape)
    assert {r["MachineId"] for r in new_rows(source(spark), wide, SPEC, key_filter).collect()} == {50, 60}


def test_surely_new_rows_skip_the_join(spark, tmp_path, without_broadcast):
    target(spark).write.parquet(f"{tmp_path}/dim")
    dim = spark.read.schema(target(spark).schema).parquet(f"{tmp_path}/dim")
    shape = FilterShape(1)
    key_filter = KeyFilter(materialize(build_filter(dim, ["MachineId"], shape)), shape)
    lines = plan_lines(new_rows(materialize(source(spark)), dim, SPEC, key_filter))
    joins = [inside for text, inside in below(lines, "SortMergeJoin") if "LeftAnti" in text]
    assert len(joins) == 1 and any("bitmap" in text for text in joins[0])


def test_stored_filter_grows_with_the_history(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), "", filter_bits=12)
    shapes = []
    for date, n in (("20150201", 50), ("20150301", 60), ("20150401", 6000)):
        staged = spark.range(n).selectExpr("'r' AS Region", "'c' AS Country", "'k' AS Continent", "CAST(id AS INT) AS TerritoryId")
        replace_table(staged, wh.path("stg", "territory"))
        load_dimension(wh, "territory", date, stamp())
        found = read_filter(spark, wh.path("keys", "territory"))
        keys = wh.dimension("territory").select("TerritoryId")
        assert maybe_in(keys, ["TerritoryId"], found.blocks, found.shape).where("NOT maybe_in").count() == 0
        shapes.append(found.shape.blocks)
    assert shapes[0] == shapes[1] < shapes[2]
    assert wh.dimension("territory").agg(F.max("territory_rk"), F.count("*")).first()[:] == (7000, 6000)


# months and key ranges


SALES = [(f"{1 + i % 12}/{1 + i % 28}/{2015 + i % 2}", f"SO{i}") for i in range(300)] + [("bad", "SO?"), (None, "SO!")]


@pytest.fixture
def by_month(spark, tmp_path):
    sales = spark.createDataFrame(SALES, "OrderDate string, OrderNumber string")
    store_by_month(sales, us_date(F.col("OrderDate")), f"{tmp_path}/sales")
    return sales, read_by_month(spark, f"{tmp_path}/sales", sales.schema)


def test_one_month_reads_one_folder(spark, tmp_path, by_month):
    sales, _ = by_month
    one = read_month(spark, f"{tmp_path}/sales", sales.schema, "20150401")
    assert by_text(map(tuple, one.collect())) == by_text(map(tuple, slice_month(sales, us_date(F.col("OrderDate")), "20150401").collect()))
    scans = [text for _, text in plan_lines(one) if text.startswith("FileScan")]
    assert len(scans) == 1 and "sample_date" in scans[0].split("PartitionFilters: ")[1].split("]")[0]
    assert len({r[0].split("/")[-2] for r in one.select("_metadata.file_path").collect()}) == 1


def test_dates_found_at_run_time_prune_folders(spark, by_month):
    sales, stored = by_month
    dates = sample_dates(sales, us_date(F.col("OrderDate")), following=True).where("sample_date LIKE '2015%'")
    found = slices_of(stored, materialize(dates))
    scans = [text for _, text in plan_lines(found) if text.startswith("FileScan") and "dynamicpruning" in text]
    assert len(scans) == 1
    expected = stored.where("sample_date LIKE '2015%'")
    assert by_text(map(tuple, found.collect())) == by_text(map(tuple, expected.collect()))
    assert 0 < found.count() < 300


def test_undated_sales_are_stored_but_in_no_slice(spark, tmp_path, by_month):
    sales, stored = by_month
    assert stored.count() == 300
    assert spark.read.parquet(f"{tmp_path}/sales").where(F.col("sample_date") == UNDATED).count() == 2
    again = sales.where("OrderNumber IN ('SO0', 'SO?')")
    store_by_month(again, us_date(F.col("OrderDate")), f"{tmp_path}/sales")
    assert spark.read.parquet(f"{tmp_path}/sales").where(F.col("sample_date") == UNDATED).count() == 1
    replaced = read_month(spark, f"{tmp_path}/sales", sales.schema, "20150201")
    assert [r["OrderNumber"] for r in replaced.collect()] == ["SO0"]


def test_point_lookups_skip_files_and_row_groups(spark, tmp_path):
    path = f"{tmp_path}/dim"
    df = spark.range(60_000).selectExpr("CAST((id * 7919) % 60000 AS INT) AS k", "uuid() AS filler", "CAST(id % 1000 AS STRING) AS s")
    write_clustered(df, path, ["k", "s"], 4, rows_hint=2_000, row_group_bytes=64 << 10)
    groups, holding = 0, 0
    for file in glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(0).statistics
            groups += 1
            holding += stats.min <= 31_007 <= stats.max
    assert groups > 8 and holding == 1
    stored = spark.read.schema("k int, filler string, s string").parquet(path)
    one = find_keys(stored, "k", [31_007])
    scans = [text for _, text in plan_lines(one) if text.startswith("FileScan")]
    assert "PushedFilters: [" in scans[0] and "31007" in scans[0]
    one.collect()
    read = one._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    assert one.count() == 1 and 0 < read < 60_000 / 8
    # a text key lies in every group's bounds; only the filters tell that it is in none
    none = find_keys(stored, "s", ["5000"])
    none.collect()
    read = none._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    assert none.count() == 0 and read < 60_000 / 4
