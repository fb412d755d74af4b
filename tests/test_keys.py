from pyspark.sql import Window
from pyspark.sql import functions as F

from starload.operators.keys import assign_surrogate_keys, max_key


def _numbers(df):
    return [tuple(r) for r in df.orderBy("k").collect()]


def test_max_key_and_default(spark):
    dim = spark.createDataFrame([(1005,), (1002,)], "rk int")
    assert max_key(dim, "rk").first()[0] == 1005
    assert max_key(dim.where("false"), "rk").first()[0] == 1000
    assert max_key(dim.where("false"), "rk", 5).first()[0] == 5


def test_methods_agree_on_uneven_text_keys(spark):
    keys = spark.range(5000).select(F.concat(F.when(F.col("id") > 100, "same-prefix-").otherwise(""), "id").alias("k"))
    window = assign_surrogate_keys(keys, ["k"], "rk", 7, "window")
    ranged = assign_surrogate_keys(keys, ["k"], "rk", 7, "range", partitions=13)
    assert _numbers(window) == _numbers(ranged)
    assert ranged.agg(F.min("rk"), F.max("rk"), F.count_distinct("rk")).first()[:] == (8, 5007, 5000)


def test_range_numbers_hot_keys_densely(spark):
    """A third of the rows share the first order column; the second splits them."""
    data = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    found = assign_surrogate_keys(data, ["k", "id"], "rk", 0, "range", partitions=8)
    expected = data.withColumn("rk", F.row_number().over(Window.orderBy("k", "id")))
    assert found.exceptAll(expected.select(found.columns)).count() == 0
    assert found.count() == 9000


def test_range_of_nothing(spark):
    none = spark.range(0).withColumnRenamed("id", "k")
    assert assign_surrogate_keys(none, ["k"], "rk", 1, "range").count() == 0


def test_auto_uses_one_task_only_for_few_counted_rows(spark):
    """A generator has next to no size by Spark's estimate, so rows are counted."""
    few = spark.range(100).withColumnRenamed("id", "k")
    plan = assign_surrogate_keys(few, ["k"], "rk")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" in plan
    many = spark.range(150_000).withColumnRenamed("id", "k")
    numbered = assign_surrogate_keys(many, ["k"], "rk")
    assert "row_number" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    assert numbered.where("rk <> k + 1001").count() == 0

def test_unknown_method(spark):
    import pytest

    with pytest.raises(ValueError):
        assign_surrogate_keys(spark.range(1), ["id"], "rk", 0, "hash")
