import random
from collections import defaultdict
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starload.operators.scd2 import (
    Scd2Spec,
    changed_rows,
    check_columns,
    check_keys,
    drop_duplicate_keys,
    in_key_order,
    new_rows,
    scd2_merge,
    unchanged_rows,
)
from starload.schemas import columns, empty_frame
from starload.sources.scratch import materialize
from tests.fixtures import AS_OF, MERGED, OPEN, SOURCE, SPEC, STAMP, TARGET, rows, source, stamp, target

LITERAL = replace(SPEC, literal_intervals=True)


def merge(src, tgt, as_of=AS_OF, spec=SPEC):
    return scd2_merge(src, tgt, spec, as_of, stamp())


def by_text(found):
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_golden_full_insert_close(spark):
    result = merge(source(spark), target(spark))
    assert rows(result.full) == by_text(MERGED)
    assert rows(result.insert) == by_text([r for r in MERGED if r[5].startswith("2024-08-01")])
    assert rows(result.close) == by_text([r for r in MERGED if r[6].startswith("2024-08-01")])
    assert result.corrected.count() == 0 and result.rejected.count() == 0
    assert result.full.columns == target(spark).columns


def test_golden_stamps(spark):
    result = merge(source(spark), target(spark))
    stamped = {r["processed"] for r in result.full.selectExpr("string(process_dttm) processed").collect()}
    assert stamped == {STAMP, "2024-08-02 00:00:00"}
    assert result.full.where(f"process_dttm > '{STAMP}'").count() == 6


def test_default_stamp_is_midnight_of_the_run_day(spark):
    full = scd2_merge(source(spark), target(spark), SPEC, AS_OF).insert
    found = full.selectExpr("process_dttm = date_trunc('day', localtimestamp()) AS ok").distinct().collect()
    assert [r["ok"] for r in found] == [True]


def test_branches(spark):
    src, tgt = source(spark), target(spark)
    assert {r["MachineId"] for r in new_rows(src, tgt, SPEC).collect()} == {50, 60}
    assert [r["MachineId"] for r in changed_rows(src, tgt, SPEC, AS_OF).orderBy("MachineId").collect()] == [20, 30]
    assert sorted(r["MachineId"] for r in unchanged_rows(src, tgt, SPEC, AS_OF).collect()) == [10, 20, 20, 40]


def test_sorted_by_key_and_start(spark):
    found = in_key_order(merge(source(spark), target(spark)).full, SPEC).collect()
    keys = [(r["MachineId"], r["valid_from_dttm"]) for r in found]
    assert keys == sorted(keys)


def test_without_version(spark):
    spec = replace(SPEC, version=None)
    full = merge(source(spark), target(spark).drop("version_no"), spec=spec).full
    names = [c for c in full.columns if c != "process_dttm"]
    assert rows(full, names) == by_text([r[:-1] for r in MERGED])


def test_first_load_starts_at_1001(spark):
    empty = target(spark).where("false")
    found = merge(source(spark), empty).full.orderBy("MachineId").collect()
    assert [(r["machine_rk"], r["MachineId"], r["version_no"]) for r in found] == [
        (1001 + i, key, 1) for i, key in enumerate((10, 20, 30, 50, 60))
    ]


def test_zoned_target_keeps_its_types(spark):
    tgt = target(spark).withColumn("valid_to_dttm", F.col("valid_to_dttm").cast("timestamp_ltz"))
    full = merge(source(spark), tgt).full
    assert full.schema["valid_to_dttm"].dataType == tgt.schema["valid_to_dttm"].dataType
    assert rows(full) == by_text(MERGED)


def test_same_date_rerun_changes_nothing(spark):
    once = materialize(merge(source(spark), target(spark)).full)
    again = merge(source(spark), once)
    assert rows(again.full) == by_text(MERGED)
    assert again.insert.count() == 0 and again.close.count() == 0


def test_same_date_rerun_literal_repeats_changes(spark):
    once = materialize(merge(source(spark), target(spark), spec=LITERAL).full)
    assert rows(once) == by_text(MERGED)
    assert merge(source(spark), once, spec=LITERAL).full.count() == 12


def test_same_date_correction_replaces_in_place(spark):
    once = materialize(merge(source(spark), target(spark)).full)
    fixed = [(20, "lathe", "south", "5.5")]
    result = merge(source(spark, fixed), once)
    expected = [(*r[:4], "5.5", *r[5:]) if r[1] == 20 and r[7] == 4 else r for r in MERGED]
    assert rows(result.full) == by_text(expected)
    assert rows(result.corrected) == by_text([r for r in expected if r[4] == "5.5"])
    assert result.insert.count() == 0


def test_late_snapshot_keeps_later_history(spark):
    once = materialize(merge(source(spark), target(spark)).full)
    late = merge(source(spark, [(20, "lathe", "hill", "5.5")]), once, "20240501")
    history = [r[3:8] for r in rows(late.full) if r[1] == 20]
    assert sorted(history, key=lambda r: r[2]) == [
        ("east", "8.0", "2022-03-01 00:00:00", "2023-06-15 00:00:00", 1),
        ("east", "9.0", "2023-06-15 00:00:00", "2024-02-01 00:00:00", 2),
        ("hill", "9.0", "2024-02-01 00:00:00", "2024-05-01 00:00:00", 3),
        ("hill", "5.5", "2024-05-01 00:00:00", "2024-08-01 00:00:00", 4),
        ("south", "9.0", "2024-08-01 00:00:00", OPEN, 5),
    ]
    assert [r for r in rows(late.full) if r[1] != 20] == by_text([r for r in MERGED if r[1] != 20])


def test_late_snapshot_literal_loses_the_later_row(spark):
    once = materialize(merge(source(spark), target(spark)).full)
    late = merge(source(spark, [(20, "lathe", "hill", "5.5")]), once, "20240501", LITERAL)
    assert not [r for r in rows(late.full) if r[1] == 20 and r[3] == "south"]


def test_null_key_is_rejected(spark):
    src = source(spark, [*SOURCE, (None, "ghost", "nowhere", "0")])
    result = merge(src, target(spark))
    assert rows(result.full) == by_text(MERGED)
    assert [r["model_nm"] for r in result.rejected.collect()] == ["ghost"]
    literal = merge(src, target(spark), spec=LITERAL)
    assert literal.full.count() == 11 and literal.rejected.count() == 0


def test_null_end_counts_as_open(spark):
    tgt = target(spark, [r[:6] + (None,) + r[7:] if r[1] == 30 else r for r in TARGET])
    full = merge(source(spark), tgt).full
    assert rows(full) == by_text(MERGED)
    assert merge(source(spark), tgt, spec=LITERAL).full.where("MachineId = 30").count() == 0


def test_null_start_counts_as_always_valid(spark):
    tgt = target(spark, [r[:5] + (None,) + r[6:] if r[1] == 30 else r for r in TARGET])
    mill = [r for r in rows(merge(source(spark), tgt).full) if r[1] == 30]
    assert [r[4:8] for r in mill] == [
        ("7.0", None, "2024-08-01 00:00:00", 1),
        ("7.25", "2024-08-01 00:00:00", OPEN, 2),
    ]


def test_null_shift_needs_safe_fingerprint(spark):
    tgt = target(spark, [(1001, 1, "a", None, "b", "2024-01-10 00:00:00", OPEN, OPEN, 1)])
    src = source(spark, [(1, "a", "b", None)])
    assert merge(src, tgt).close.count() == 0
    assert merge(src, tgt, spec=replace(SPEC, safe_fingerprint=True)).close.count() == 1


def test_extra_source_columns_reach_insert_only(spark):
    result = merge(source(spark).withColumn("extra", F.lit("x")), target(spark))
    assert "extra" in result.insert.columns
    assert "extra" not in result.full.columns + result.close.columns


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="hall_cd"):
        check_columns(source(spark).drop("hall_cd"), target(spark), SPEC)
    with pytest.raises(ValueError, match="hall_cd"):
        merge(source(spark).drop("hall_cd"), target(spark))


def test_key_checks(spark):
    src = source(spark, [*SOURCE, SOURCE[2], SOURCE[2], (None, "x", "y", "z")])
    found = check_keys(src, ["MachineId"])
    assert (found.incomplete_rows, found.duplicate_keys) == (1, 1)
    assert drop_duplicate_keys(src, ["MachineId"]).count() == 6
    none = check_keys(source(spark, []), ["MachineId"])
    assert (none.incomplete_rows, none.duplicate_keys) == (0, 0)


def test_specs_do_not_share_state():
    a, b = Scd2Spec("a_rk", "a"), Scd2Spec("b_rk", ["b", "c"])
    assert a.business_key == ("a",) and b.business_key == ("b", "c")
    assert "a_rk" not in b.technical
    with pytest.raises(ValueError):
        Scd2Spec("a_rk", ())


def test_composite_key(spark):
    spec = Scd2Spec("pair_rk", ("a", "b"), version=None)
    layout = columns(
        "pair_rk integer, a integer, b integer, v string, valid_from_dttm timestamp_ntz, "
        "valid_to_dttm timestamp_ntz, process_dttm timestamp_ntz"
    )
    first = [(1, 1, "x"), (1, 2, "y"), (2, 1, "z")]
    second = [(1, 2, "Y"), (2, 2, "n"), (2, 1, "z")]
    tgt = empty_frame(spark, layout)
    for day, snap in (("20250101", first), ("20250201", second)):
        tgt = materialize(merge(spark.createDataFrame(snap, "a int, b int, v string"), tgt, day, spec).full)
    found = sorted((r["a"], r["b"], r["v"], r["pair_rk"]) for r in tgt.collect())
    assert found == [(1, 1, "x", 1001), (1, 2, "Y", 1002), (1, 2, "y", 1002), (2, 1, "z", 1003), (2, 2, "n", 1004)]


def _expected_history(loads):
    """Plain restatement of the merge: rows per key as [start, end, value, version]."""
    history, surrogate = defaultdict(list), {}
    for day, snapshot in loads:
        for key in sorted(k for k in snapshot if k not in history):
            surrogate[key] = 1001 + len(surrogate)
            history[key] = [[day, OPEN, snapshot[key]]]
        for key, value in snapshot.items():
            for row in list(history[key]):
                start, end, old = row
                if start <= day < end and old != value:
                    if start == day:
                        row[2] = value
                    else:
                        row[1] = day
                        history[key].append([day, end, value])
    out = []
    for key, versions in history.items():
        for i, (start, end, value) in enumerate(sorted(versions)):
            out.append((surrogate[key], key, value, start, end, i + 1))
    return by_text(out)


@pytest.mark.parametrize("seed", range(3))
def test_random_loads_in_any_order(spark, seed):
    """Against brute force; dates come in any order and may repeat."""
    rng = random.Random(seed)
    layout = columns(
        "rk integer, id integer, v string, valid_from_dttm timestamp_ntz, "
        "valid_to_dttm timestamp_ntz, process_dttm timestamp_ntz, version_no integer"
    )
    spec = Scd2Spec("rk", ("id",))
    tgt, loads = empty_frame(spark, layout), []
    days = [datetime(2024, 1, 1) + timedelta(days=31 * rng.randrange(6)) for _ in range(5)]
    for day in days:
        snapshot = {k: rng.choice("ab") for k in range(12) if rng.random() < 0.6}
        loads.append((str(day), snapshot))
        src = spark.createDataFrame(list(snapshot.items()), "id int, v string")
        tgt = materialize(scd2_merge(src, tgt, spec, day, stamp()).full)
        names = ["rk", "id", "v", "valid_from_dttm", "valid_to_dttm", "version_no"]
        assert rows(tgt, names) == _expected_history(loads)
    per_key = defaultdict(list)
    for r in tgt.collect():
        per_key[r["id"]].append((r["valid_from_dttm"], r["valid_to_dttm"]))
    for intervals in per_key.values():
        intervals.sort()
        assert sum(str(end) == OPEN for _, end in intervals) == 1
        assert all(a[1] == b[0] for a, b in zip(intervals, intervals[1:]))


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shape(spark, tmp_path):
    """One left join for versions, one anti join for new keys; history passes through.

    By default new rows are stored and counted first; numbered in one task they are part of the plan.
    """
    for name, frame in (("dim", target(spark)), ("snap", source(spark))):
        frame.write.parquet(str(tmp_path / name))
    stored = spark.read.schema(target(spark).schema).parquet(str(tmp_path / "dim"))
    snap = spark.read.schema(source(spark).schema).parquet(str(tmp_path / "snap"))
    spec = replace(SPEC, version=None)
    merged = scd2_merge(snap, stored.drop("version_no"), spec, AS_OF, stamp(), key_method="window")
    plan = _optimized(merged.full)
    assert plan.count("Join LeftOuter") == 1 and plan.count("Join LeftAnti") == 1
    assert not any(f"Join {kind}" in plan for kind in ("FullOuter", "Cross", "Inner"))
    rest = merge(snap, stored.drop("version_no"), spec=spec)._rest
    assert "Exchange" not in _executed(rest) and "PushedFilters: [Or(" in _executed(rest)


def test_range_numbering_has_no_single_partition_exchange_of_rows(spark, tmp_path):
    """Only the per-partition counts may be gathered in one task."""
    for name, frame in (("dim", target(spark)), ("snap", source(spark))):
        frame.write.parquet(str(tmp_path / name))
    stored = spark.read.schema(target(spark).schema).parquet(str(tmp_path / "dim"))
    snap = spark.read.schema(source(spark).schema).parquet(str(tmp_path / "snap"))
    full = scd2_merge(snap, stored, SPEC, AS_OF, stamp(), key_method="range").full
    assert rows(full) == by_text(MERGED)
    windows = [line for line in _executed(full).splitlines() if "Window [" in line]
    assert windows and all("__rows" in line and "row_number" not in line for line in windows)
