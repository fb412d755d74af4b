"""Stored dimensions whose closed rows are written once.

Each load writes one version: its open rows, and the rows it closed. The content
of the table is the open rows of the newest version plus the closed rows of all
versions since the last complete rewrite. A monthly load therefore writes in
proportion to the open rows, however long the history has grown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.schemas import empty_frame
from starload.sources.buckets import Buckets, bucket_number, read_buckets, write_buckets
from starload.sources.tables import LOADED_MARKER, VERSION_PREFIX, complete_versions, hadoop_path, mark

COMPLETE_MARKER = "_COMPLETE"  # the version holds all closed rows, not only its own
OPEN_COLUMN = "__open"


def _has(spark: SparkSession, path: str) -> bool:
    folder, file_system = hadoop_path(spark, path)
    return file_system.exists(folder)


def _parts(spark: SparkSession, path: str, open_only: bool) -> list[str]:
    folders = [folder for _, folder in complete_versions(spark, path)]
    parts = [f"{folders[-1]}/{OPEN_COLUMN}=true"] if folders else []
    if not open_only:
        for folder in reversed(folders):
            parts.append(f"{folder}/{OPEN_COLUMN}=false")
            if _has(spark, f"{folder}/{COMPLETE_MARKER}"):
                break
    return [part for part in parts if _has(spark, part)]


def read_history(
    spark: SparkSession,
    path: str,
    schema: StructType,
    open_only: bool = False,
    key: Sequence[str] = (),
) -> DataFrame:
    """Content of the table, or its open rows; an empty frame before the first load.

    Open rows stored in buckets of ``key`` are read as such.
    """
    parts = _parts(spark, path, open_only)
    if open_only and key and parts:
        number = bucket_number(spark, parts[0].rsplit("/", 1)[0])
        if number:
            return read_buckets(spark, parts[0], schema, Buckets(number, tuple(key)))
    return spark.read.schema(schema).parquet(*parts) if parts else empty_frame(spark, schema)


def publish_history(
    df: DataFrame,
    path: str,
    end: str,
    open_end: str,
    complete: bool,
    keep: int = 2,
    buckets: Buckets | None = None,
) -> str:
    """Write the next version of a history that ``df`` may itself read.

    With ``complete`` the rows replace the whole table. Otherwise ``df`` holds all
    open rows and the rows closed by this load, and earlier closed rows stay where
    they are. A version counts once its marker exists, so a failed load leaves
    readers on the version before and is overwritten by the next attempt. Open
    rows are retained for the newest ``keep`` versions, closed rows from the newest
    complete rewrite that those versions read. With ``buckets`` the rows are written where
    they are, in buckets of the key.
    """
    spark = df.sparkSession
    versions = complete_versions(spark, path)
    number = versions[-1][0] + 1 if versions else 1
    folder = f"{path}/{VERSION_PREFIX}{number:08d}"
    is_open = F.coalesce(F.col(end) >= F.expr(open_end), F.lit(True))
    marked = df.withColumn(OPEN_COLUMN, is_open)
    if buckets:
        write_buckets(marked, folder, buckets, [OPEN_COLUMN])
    else:
        # gathered into few files, while a large side is still split over tasks
        dealt = marked.hint("rebalance", F.col(OPEN_COLUMN))
        dealt.write.mode("overwrite").partitionBy(OPEN_COLUMN).parquet(folder)
    if complete:
        mark(spark, f"{folder}/{COMPLETE_MARKER}")
    mark(spark, f"{folder}/{LOADED_MARKER}")
    folders = [old for _, old in versions] + [folder]
    rewritten = [i for i, old in enumerate(folders) if _has(spark, f"{old}/{COMPLETE_MARKER}")]
    oldest = len(folders) - keep
    # closed rows before the last rewrite that every retained version can see are read by none
    dead = max((i for i in rewritten if i <= oldest), default=0)
    for i, old in enumerate(folders[: max(0, oldest)]):
        parts = [f"{OPEN_COLUMN}=true"] + ([f"{OPEN_COLUMN}=false"] if i < dead else [])
        for part in parts:
            stale, file_system = hadoop_path(spark, f"{old}/{part}")
            file_system.delete(stale, True)
    return folder
