import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starload.schemas import columns, schema_of
from starload.sources import scratch
from starload.sources.csv_feed import feed_path, read_csv, read_feed, read_slice, read_slices, write_csv, write_feed, write_slices
from starload.sources.tables import (
    append_table,
    current_version,
    map_columns,
    publish,
    read_current,
    read_table,
    replace_batch,
    replace_table,
    truncate_table,
)

PAIR = columns("a string, b string")


def test_csv_by_name_with_quotes(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('b,extra,a\n"x, ""y""",1,2\n"back\\\\slash \\"q\\"",,\n')
    found = sorted((tuple(r) for r in read_csv(spark, str(path), PAIR).collect()), key=str)
    assert found[1] == (None, 'back\\slash "q"')
    assert read_csv(spark, str(path), PAIR).columns == ["a", "b"]


def test_csv_roundtrip_keeps_awkward_text(spark, tmp_path):
    values = [("plain", 'say "hi", ok'), (None, "tail\\"), (None, "a,b"), ("\\\"", " space ")]
    df = spark.createDataFrame(values, PAIR)
    write_csv(df, str(tmp_path / "x.csv"))
    back = read_csv(spark, str(tmp_path / "x.csv"), PAIR)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(values, key=str)


def test_csv_line_breaks_need_multi_line(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('a,b\n"one\ntwo",x\n')
    assert read_csv(spark, str(path), PAIR, multi_line=True).first()["a"] == "one\ntwo"


def test_csv_missing_column(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("a,c\n1,2\n")
    with pytest.raises(ValueError, match="b"):
        read_csv(spark, str(path), PAIR)


def test_feed_folder(spark, tmp_path):
    df = spark.createDataFrame([("1", "Region", "Country", "Continent")], schema_of("ods", "territory"))
    write_feed(df, str(tmp_path), "territory", "20150201", "drop")
    assert feed_path("r", "territory", "20150201", "drop") == "r/drop_20150201/drop_Territories_20150201.csv"
    assert read_feed(spark, str(tmp_path), "territory", "20150201", "drop").collect() == df.collect()


def test_slices(spark, tmp_path):
    df = spark.createDataFrame([("1", "x", "20150101"), ("2", "y", "20150201")], "a string, b string, sample_date string")
    path = str(tmp_path / "slices")
    write_slices(df, path)
    assert sorted(read_slices(spark, path, PAIR).collect()) == sorted(df.collect())
    assert [tuple(r) for r in read_slice(spark, path, PAIR, "20150201").collect()] == [("2", "y")]


def test_slices_rebalance_hint(spark):
    df = spark.range(1).withColumn("sample_date", F.lit("x")).hint("rebalance", F.col("sample_date"))
    assert "RebalancePartitions" in df._jdf.queryExecution().analyzed().toString()


def test_replace_append_truncate_by_path_and_name(spark, tmp_path):
    df = spark.range(3)
    for target in (str(tmp_path / "t"), "starload_test_table"):
        append_table(df, target)  # the first write creates the table
        append_table(df, target)
        assert read_table(spark, target).count() == 6
        replace_table(df, target)
        assert read_table(spark, target).count() == 3
        truncate_table(spark, target, df.schema)
        assert read_table(spark, target).count() == 0 and read_table(spark, target).columns == ["id"]
    spark.sql("DROP TABLE starload_test_table")


def test_map_columns(spark):
    df = spark.createDataFrame([("5", "x", "y")], "k string, v string, unmapped string")
    found = map_columns(df, {"v": "b", "k": "a"}, PAIR)
    assert [tuple(r) for r in found.collect()] == [("5", "x")]


def test_published_table_may_read_itself(spark, tmp_path):
    path, schema = str(tmp_path / "dim"), spark.range(1).schema
    assert current_version(spark, path) is None and read_current(spark, path, schema).count() == 0
    publish(spark.range(2), path)
    for _ in range(3):
        publish(read_current(spark, path, schema).union(spark.range(1)), path)
    assert read_current(spark, path, schema).count() == 5
    assert len([p for p in (tmp_path / "dim").iterdir() if p.name.startswith("version-")]) == 2


def test_failed_publish_leaves_the_version_before(spark, tmp_path):
    path, schema = str(tmp_path / "dim"), spark.range(1).schema
    publish(spark.range(2), path)
    with pytest.raises(PySparkException):
        publish(spark.range(2).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path)
    assert read_current(spark, path, schema).count() == 2
    publish(spark.range(4), path)
    assert read_current(spark, path, schema).count() == 4


def test_batch_is_replaced(spark, tmp_path):
    path = str(tmp_path / "facts")
    replace_batch(spark.range(3), path, "sample_date", "20150101")
    replace_batch(spark.range(3), path, "sample_date", "20150201")
    replace_batch(spark.range(1), path, "sample_date", "20150101")
    found = read_table(spark, path, columns("id long, sample_date string")).groupBy("sample_date").count()
    assert sorted(map(tuple, found.collect())) == [("20150101", 1), ("20150201", 3)]


def test_scratch_folder(spark, tmp_path, monkeypatch):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" and self.value else default

    class Session:
        def __init__(self, value, master):
            self.conf = Conf(value)
            self.sparkContext = type("C", (), {"master": master, "applicationId": "app"})()

    assert scratch.scratch_root(Session("hdfs://shared/cp/", "yarn")) == "hdfs://shared/cp"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session(None, "yarn"))
    assert scratch.scratch_root(Session(None, "local[2]")) == scratch.scratch_root(Session(None, "local[2]"))
