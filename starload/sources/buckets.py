"""Tables stored in buckets of a key, so that a join on the key moves only its other side.

The number of buckets and the key are part of the folder's marker, not of a catalog: a
session that reads the folder names it a table for a moment, takes the bucketed relation and
forgets the name again. Nothing but the files has to outlive a session.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starload.functions.names import quoted
from starload.sources.tables import hadoop_path, mark

_MARKER = "_BUCKETS-"


@dataclass(frozen=True)
class Buckets:
    """Number of buckets, and the columns whose hash names the bucket of a row."""

    number: int
    key: tuple[str, ...]

    def __post_init__(self) -> None:
        if self.number < 1 or not self.key:
            raise ValueError("buckets need a number and a key")


def dealt(df: DataFrame, buckets: Buckets) -> DataFrame:
    """``df`` with the rows of a bucket in one task, which then writes one file for it."""
    return df.repartition(buckets.number, *buckets.key)


def write_buckets(
    df: DataFrame, path: str, buckets: Buckets, partition_by: Sequence[str] = ()
) -> None:
    """Replace the folder ``path`` by the rows of ``df`` in buckets.

    Rows are written where they are: ``dealt`` rows, and rows of a join on the key of a
    bucketed table, give one file for each bucket, others up to one for each bucket and task.
    """
    spark = df.sparkSession
    name = f"starload_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").mode("overwrite").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets.number, *buckets.key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # of the name only: the files lie outside the warehouse
    mark(spark, f"{path}/{_MARKER}{buckets.number}")


def bucket_number(spark: SparkSession, path: str) -> int | None:
    """Number of buckets of the folder, or None where it has none."""
    pattern, file_system = hadoop_path(spark, f"{path}/{_MARKER}*")
    found = file_system.globStatus(pattern) or []
    return max((int(f.getPath().getName()[len(_MARKER) :]) for f in found), default=None)


def read_buckets(spark: SparkSession, path: str, schema: StructType, buckets: Buckets) -> DataFrame:
    """Rows of a folder of bucket files; a join or grouping by the key needs no exchange of them."""
    name = f"starload_{uuid.uuid4().hex}"
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(quoted(k) for k in buckets.key)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet "
        f"CLUSTERED BY ({keys}) INTO {buckets.number} BUCKETS LOCATION '{place}'"
    )
    try:
        return spark.table(name)  # analysed now; the frame holds the relation, not the name
    finally:
        spark.sql(f"DROP TABLE {name}")
