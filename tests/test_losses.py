"""Rows that no step may lose or damage without a word."""

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from starload.operators.scd2 import drop_duplicate_keys
from starload.plans.jobs import Warehouse, load_dimension, load_staging
from starload.schemas import empty_table
from starload.sources.csv_feed import read_csv, read_slices, write_csv, write_slices
from workload.inputs import ALL, CUTS, PERIODS, REST


def test_rows_without_a_key_are_no_copies(spark):
    rows = [(1, "a"), (1, "b"), (None, "x"), (None, "x"), (None, "y")]
    found = drop_duplicate_keys(spark.createDataFrame(rows, "k int, v string"), ["k"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(1, "b"), *rows[2:]], key=str)


def test_rejected_rows_are_all_kept_and_replaced(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path), "")
    schema = empty_table(spark, "stg", "territory").schema

    def load(day, keys):
        rows = [tuple(k if f.name == "TerritoryId" else "x" for f in schema.fields) for k in keys]
        load_staging(wh, "territory", spark.createDataFrame(rows, schema))
        load_dimension(wh, "territory", day, duplicates="drop")

    load("20250101", [1, 1, None, None, None])
    rejected = wh.path("rejected", "territory")
    assert spark.read.parquet(rejected).count() == 3
    load("20250201", [1, None])
    load("20250101", [1, None, None])
    assert sorted(r[0] for r in spark.read.parquet(rejected).groupBy("sample_date").count().select("count").collect()) == [1, 2]
    load("20250101", [1])
    assert spark.read.parquet(rejected).count() == 1
    assert wh.dimension("territory").count() == 1


def text_schema(*names):
    return StructType([StructField(n, StringType()) for n in names])


@pytest.mark.parametrize("line", ["1,2,3", "4"])
def test_rows_of_the_wrong_width_fail(spark, tmp_path, line):
    (tmp_path / "f.csv").write_text(f"a,b\n1,2\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path / "f.csv"), text_schema("a", "b")).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path / "f.csv"), text_schema("b")).collect()


def test_line_breaks_are_kept_or_refused(spark, tmp_path):
    rows = spark.createDataFrame([("North\nEast", 'say "x", y'), (None, "b")], "a string, b string")
    with pytest.raises(Exception, match="line break"):
        write_csv(rows, str(tmp_path / "no"))
    write_csv(rows, str(tmp_path / "yes"), multi_line=True)
    back = read_csv(spark, str(tmp_path / "yes"), rows.schema, multi_line=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_slices_are_read_by_name(spark, tmp_path):
    rows = spark.createDataFrame([("1", "2", "20250101")], "a string, b string, sample_date string")
    write_slices(rows, str(tmp_path / "s"))
    back = read_slices(spark, str(tmp_path / "s"), text_schema("b", "a"))
    assert back.collect()[0].asDict() == {"a": "1", "b": "2", "sample_date": "20250101"}


def test_periods_of_each_query_cover_all_rows():
    def covers(cuts):
        return cuts[0][1] is None and cuts[-1][2] is None and all(a[2] == b[1] for a, b in zip(cuts, cuts[1:], strict=False))

    assert covers(PERIODS) and covers((CUTS[0], CUTS[REST])) and covers((CUTS[ALL],))
