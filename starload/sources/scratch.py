"""Intermediate results written to the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``; a local run without one gets its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL_ROOTS.setdefault(context.applicationId, tempfile.mkdtemp(prefix="starload-"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the scratch folder, removed when the session's JVM ends."""
    path = f"{scratch_root(spark)}/starload-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    return f"{path}/{label}"


def materialize(df: DataFrame, label: str = "frame", compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return a frame over the files.

    Values that depend on how rows were partitioned are frozen this way: a lost
    executor re-reads files and cannot renumber rows. ``compression`` is that of the session
    unless another is named, such as ``zstd`` for the largest tables.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
