"""Many snapshots at once against one merge after the other."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starload.operators.backfill import scd2_backfill
from starload.operators.scd2 import Scd2Spec, drop_duplicate_keys, scd2_merge
from starload.plans.jobs import Warehouse, backfill_months, load_entity, run_month
from starload.schemas import columns, empty_frame
from starload.sources.scratch import materialize
from tests.fixtures import rows as rows_by, stamp
from tests.test_jobs import _drop

SPEC = Scd2Spec("rk", ("a", "b"))


def rows(df):
    return rows_by(df, sorted(df.columns))


HISTORY = columns(
    "rk integer, a integer, b string, x string, y integer, valid_from_dttm timestamp_ntz, "
    "valid_to_dttm timestamp_ntz, process_dttm timestamp_ntz, version_no integer"
)
SNAPSHOT = "a int, b string, x string, y int, sample_date string"
DATES = ["20240101", "20240201", "20240301", "20240401", "20240501", "20240601"]


def presences(seed):
    """Snapshots whose entities come, go, change, change back, and hold nulls."""
    pick = random.Random(seed)
    found = []
    for date in DATES:
        for a in range(6):
            for b in ("p", "q"):
                if pick.random() < 0.6:
                    found.append((a, b, pick.choice(["u", "v", None]), pick.choice([1, None]), date))
    return found


def one_by_one(spark, found, spec, target=None, dates=DATES):
    target = empty_frame(spark, HISTORY) if target is None else target
    for date in dates:
        one = spark.createDataFrame([r for r in found if r[-1] == date], SNAPSHOT).drop("sample_date")
        target = materialize(scd2_merge(one, target, spec, date, stamp()).full, "dim")
    return target


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("safe", [False, True])
def test_equals_loads_one_by_one(spark, seed, safe):
    spec = replace(SPEC, safe_fingerprint=safe)
    found = presences(seed)
    snapshots = spark.createDataFrame(found, SNAPSHOT)
    full = scd2_backfill(snapshots, empty_frame(spark, HISTORY), spec, processed=stamp()).full
    assert rows(full) == rows(one_by_one(spark, found, spec))
    assert full.schema == HISTORY


@pytest.mark.parametrize("split", [1, 4])
def test_onto_a_history(spark, split):
    found = presences(3)
    target = one_by_one(spark, found, SPEC, dates=DATES[:split])
    later = spark.createDataFrame([r for r in found if r[-1] >= DATES[split]], SNAPSHOT)
    full = scd2_backfill(later, target, SPEC, processed=stamp()).full
    assert rows(full) == rows(one_by_one(spark, found, SPEC, target, DATES[split:]))


def test_null_starts_and_ends_of_stored_rows(spark):
    found = presences(4)
    target = one_by_one(spark, found, SPEC, dates=DATES[:1]).withColumns(
        {"valid_from_dttm": F.lit(None).cast("timestamp_ntz"), "valid_to_dttm": F.lit(None).cast("timestamp_ntz")}
    )
    target = materialize(target)
    later = spark.createDataFrame([r for r in found if r[-1] > DATES[0]], SNAPSHOT)
    full = scd2_backfill(later, target, SPEC, processed=stamp()).full
    assert rows(full) == rows(one_by_one(spark, found, SPEC, target, DATES[1:]))


def test_date_and_timestamp_columns(spark):
    found = presences(5)
    text = spark.createDataFrame(found, SNAPSHOT)
    day = text.withColumn("sample_date", F.to_date("sample_date", "yyyyMMdd"))
    empty = empty_frame(spark, HISTORY)
    a, b = (scd2_backfill(s, empty, SPEC, processed=stamp()).full for s in (text, day))
    assert rows(a) == rows(b)


def test_refuses_what_single_loads_would_see_differently(spark):
    found = presences(6)
    target = one_by_one(spark, found, SPEC, dates=DATES[:3])
    early = spark.createDataFrame([r for r in found if r[-1] <= DATES[1]], SNAPSHOT)
    with pytest.raises(ValueError, match="reaches into"):
        scd2_backfill(early, target, SPEC, processed=stamp())
    with pytest.raises(ValueError, match="literal"):
        scd2_backfill(early, target, replace(SPEC, literal_intervals=True))
    with pytest.raises(ValueError, match="no date"):
        undated = spark.createDataFrame([(1, "p", "u", 1, None)], SNAPSHOT)
        scd2_backfill(undated, empty_frame(spark, HISTORY), SPEC)
    with pytest.raises(ValueError, match="missing"):
        scd2_backfill(early.drop("x"), target, SPEC)


def test_duplicates_and_incomplete_keys(spark):
    found = presences(7)
    extra = [(0, "p", "zz", 9, DATES[0]), (0, "p", "zy", 9, DATES[0]), (None, "p", "u", 1, DATES[1]), (None, "p", "u", 1, DATES[1])]
    snapshots = spark.createDataFrame(found + extra, SNAPSHOT)
    empty = empty_frame(spark, HISTORY)
    with pytest.raises(ValueError, match="more than once"):
        scd2_backfill(snapshots, empty, SPEC, processed=stamp())
    done = scd2_backfill(snapshots, empty, SPEC, processed=stamp(), duplicates="drop")
    assert sorted(tuple(r) for r in done.rejected.select("b", "sample_date").collect()) == [("p", DATES[1])] * 2
    reduced = drop_duplicate_keys(snapshots.where("a IS NOT NULL"), ["a", "b", "sample_date"])
    assert rows(done.full) == rows(one_by_one(spark, [tuple(r) for r in reduced.select("a", "b", "x", "y", "sample_date").collect()], SPEC))


def test_empty_snapshots_leave_the_history(spark):
    target = one_by_one(spark, presences(8), SPEC, dates=DATES[:2])
    none = spark.createDataFrame([], SNAPSHOT)
    assert rows(scd2_backfill(none, target, SPEC).full) == rows(target)


def test_whole_rows_are_shuffled_once(spark):
    """One exchange of attributes, whatever the number of dates; keys alone may move besides."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        snapshots = materialize(spark.createDataFrame(presences(9), SNAPSHOT))
        full = scd2_backfill(snapshots, empty_frame(spark, HISTORY), SPEC, processed=stamp()).full
        executed = full._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in executed.splitlines() if "Exchange hashpartitioning" in line]
        # the snapshots with their attributes, and the numbers; the join and all windows share this
        assert len(moved) == 2 and all("hashpartitioning(a#" in line for line in moved), executed
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _feeds(spark, root):
    _drop(spark, root, "20150201", [("11", "Ann"), ("7", "Bob")], [("1/5/2015", "1", "11"), ("1/31/2015", "1", "5")])
    _drop(spark, root, "20150301", [("11", "Anna"), ("5", "Cy")], [("2/1/2015", "1", "5"), ("2/2/2015", "8", "11")])
    _drop(spark, root, "20150401", [("11", "Anna"), (None, "Nobody")], [("3/1/2015", "1", "5"), ("3/2/2015", "8", "7")])


def _content(wh):
    found = {name: rows(wh.dimension(name)) for name in wh.dimensions}
    found["facts"] = sorted(map(str, wh.facts().collect()))
    rejected = wh.spark.read.parquet(wh.path("rejected", "customer"))
    found["rejected"] = sorted(map(str, rejected.select("FirstName", F.col("sample_date").cast("string")).collect()))
    return found


@pytest.mark.parametrize("seed", [3, 4])
def test_only_rows_that_begin_a_run_are_fetched_whole(spark, seed):
    found = presences(seed)
    first = one_by_one(spark, found, SPEC, dates=DATES[:2])
    snapshots = materialize(spark.createDataFrame([r for r in found if r[-1] in DATES[2:]], SNAPSHOT), "snapshots")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        full = scd2_backfill(snapshots, first, SPEC, processed=stamp()).full
        plan = full._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "__maybe" not in full.columns  # runs are decided before, and stored
        assert "bitmap" in plan  # the others are left out before the shuffle
        assert rows(full) == rows(one_by_one(spark, found, SPEC))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_months_at_once_leave_what_single_months_leave(spark, tmp_path):
    dates = ["20150201", "20150301", "20150401"]
    _feeds(spark, f"{tmp_path}/raw")
    single = Warehouse(spark, f"{tmp_path}/single", f"{tmp_path}/raw")
    for date in dates:
        run_month(single, date, stamp(), stamp())
    expected = _content(single)
    assert any("customer_rk=None" in r for r in expected["facts"])  # sold before the customer's own load

    whole = Warehouse(spark, f"{tmp_path}/whole", f"{tmp_path}/raw")
    backfill_months(whole, dates, stamp(), stamp())
    assert _content(whole) == expected

    mixed = Warehouse(spark, f"{tmp_path}/mixed", f"{tmp_path}/raw")
    run_month(mixed, dates[0], stamp(), stamp())
    backfill_months(mixed, dates[:0:-1], stamp(), stamp())
    assert _content(mixed) == expected
    load_entity(mixed, "customer", dates[-1], stamp())  # a later single load goes on from there
    assert rows(mixed.dimension("customer")) == expected["customer"]
