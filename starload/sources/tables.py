"""Columnar tables: reading, replacing, appending, emptying, publishing versions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.functions.names import quoted
from starload.schemas import conform, empty_frame

VERSION_PREFIX = "version-"
LOADED_MARKER = "_LOADED"


def read_table(
    spark: SparkSession, source: str, schema: StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Table by catalog name, or by path when ``source`` contains a slash."""
    if "/" not in source:
        return spark.table(source)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(source)


def map_columns(df: DataFrame, mapping: Mapping[str, str], schema: StructType) -> DataFrame:
    """Project ``{source: destination}`` pairs; unmapped columns are dropped."""
    return conform(
        df.selectExpr(*[f"{quoted(s)} AS {quoted(d)}" for s, d in mapping.items()]), schema
    )


def replace_table(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Replace the whole content; the first write creates the table."""
    writer = df.write.format(fmt).mode("overwrite")
    writer.save(target) if "/" in target else writer.saveAsTable(target)


def append_table(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    writer = df.write.format(fmt).mode("append")
    writer.save(target) if "/" in target else writer.saveAsTable(target)


def truncate_table(spark: SparkSession, target: str, schema: StructType, fmt: str = "parquet") -> None:
    replace_table(empty_frame(spark, schema), target, fmt)


def replace_batch(df: DataFrame, path: str, by: str, value: str, fmt: str = "parquet") -> None:
    """Append with a guard: the batch ``by=value`` of a table is written or replaced.

    Loading the same batch again leaves one copy of it. The rows go straight to
    the folder of their batch, without a shuffle.
    """
    df.write.format(fmt).mode("overwrite").save(f"{path}/{by}={value}")


def replace_batches(df: DataFrame, path: str, by: str, fmt: str = "parquet") -> None:
    """Write or replace every batch that ``df`` has rows of, in one job.

    The rebalance hint gathers a batch into few files and lets adaptive execution split a
    large one. A batch without rows stays as it is.
    """
    writer = df.hint("rebalance", F.col(by)).write.format(fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(by).save(path)


def drop_batch(spark: SparkSession, path: str, by: str, value: str) -> None:
    """Remove the batch ``by=value`` of a table, if there is one."""
    folder, file_system = hadoop_path(spark, f"{path}/{by}={value}")
    file_system.delete(folder, True)


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """Path and file system objects, whatever store the path lives on."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty marker file."""
    marker, file_system = hadoop_path(spark, path)
    file_system.create(marker, True).close()


def complete_versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of the versions that were written to the end, oldest first."""
    pattern, file_system = hadoop_path(spark, f"{path}/{VERSION_PREFIX}*/{LOADED_MARKER}")
    folders = [s.getPath().getParent() for s in file_system.globStatus(pattern) or []]
    return sorted((int(f.getName()[len(VERSION_PREFIX) :]), f.toString()) for f in folders)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest complete version, or None before the first load."""
    versions = complete_versions(spark, path)
    return versions[-1][1] if versions else None


def read_current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Newest complete version; an empty frame before the first load."""
    folder = current_version(spark, path)
    if folder is None:
        return empty_frame(spark, schema)
    return spark.read.schema(schema).parquet(folder)


def publish(df: DataFrame, path: str, keep: int | None = 2) -> str:
    """Write ``df`` as the next version of a table that ``df`` may itself read.

    A version counts only once its marker file exists, so a failed write leaves
    readers on the version before. The newest ``keep`` versions are retained.
    """
    spark = df.sparkSession
    versions = complete_versions(spark, path)
    number = versions[-1][0] + 1 if versions else 1
    folder = f"{path}/{VERSION_PREFIX}{number:08d}"
    df.write.mode("overwrite").parquet(folder)
    mark(spark, f"{folder}/{LOADED_MARKER}")
    if keep is not None:
        for _, old in (versions + [(number, folder)])[:-keep]:
            stale, file_system = hadoop_path(spark, old)
            file_system.delete(stale, True)
    return folder
