"""Layouts that let a reader skip most of a table: months as folders, keys as ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starload.functions.dates import slice_key
from starload.operators.slicing import SAMPLE_DATE
from starload.sources.tables import replace_batches

#: Value of rows whose date is missing or unreadable, which no slice holds.
UNDATED = "undated"


def store_by_month(sales: DataFrame, day: Column, path: str) -> None:
    """Store sales in a folder for each sample date, in one job.

    The sample date is the first day of the month after ``day``, so a slice is a folder. A
    month of the table that ``sales`` has no rows of stays; one it has rows of is replaced. Rows
    without a usable date are kept in a folder of their own.
    """
    key = F.coalesce(slice_key(day), F.lit(UNDATED))
    replace_batches(sales.withColumn(SAMPLE_DATE, key), path, SAMPLE_DATE)


def read_by_month(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All slices, with their sample date as the folder column; a filter on it prunes folders."""
    whole = StructType([*schema.fields, StructField(SAMPLE_DATE, StringType())])
    # by length, as a comparison would be passed on to the side that prunes and take its place
    return spark.read.schema(whole).parquet(path).where(F.length(SAMPLE_DATE) == 8)


def read_month(spark: SparkSession, path: str, schema: StructType, sample_date: str) -> DataFrame:
    """The slice of one sample date: no other folder is listed into a task."""
    return read_by_month(spark, path, schema).where(F.col(SAMPLE_DATE) == sample_date).select(*schema.names)


def slices_of(stored: DataFrame, dates: DataFrame) -> DataFrame:
    """The slices whose sample dates ``dates`` holds in its column of that name.

    The dates are found when the query runs and prune the folders of the scan before it starts.
    """
    wanted = dates.select(F.col(SAMPLE_DATE).alias("__wanted")).distinct()
    wanted = wanted.where("__wanted >= '0'")  # every date; Spark prunes by a filtered side only
    # one short row for each month, whatever the sales
    return stored.join(F.broadcast(wanted), stored[SAMPLE_DATE] == wanted["__wanted"], "left_semi")


def write_clustered(
    df: DataFrame, path: str, key: Sequence[str], files: int, rows_hint: int | None = None, row_group_bytes: int = 16 << 20
) -> None:
    """Write ``df`` in ranges of ``key``, sorted, with a Bloom filter on each key column.

    A file holds one range of keys and a row group a part of it, so a filter on keys skips
    files and groups by their bounds; where bounds overlap, as for a second key column, the
    Bloom filter of a group says that a key is not there. ``rows_hint`` is the number of
    different keys in a row group that filters are made for.
    """
    writer = df.repartitionByRange(files, *key).sortWithinPartitions(*key).write.mode("overwrite")
    writer = writer.option("parquet.block.size", row_group_bytes)
    for name in key:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        if rows_hint:
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", rows_hint)
    writer.parquet(path)


def find_keys(df: DataFrame, key: str, values: Sequence[int | str]) -> DataFrame:
    """Rows of a stored table whose key is one of a few given values, by a filter on the scan."""
    return df.where(F.col(key).isin(list(values)))
