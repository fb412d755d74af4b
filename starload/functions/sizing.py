"""Size checks made before data is broadcast or brought into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MB = 1024 * 1024
SMALL_BYTES = 10 * MB
#: Counted bytes up to which a table is broadcast. The driver collects it, builds a hash table of
#: several times that size and serializes it; lookups of a query, and loads side by side, add up.
BROADCAST_LIMIT_BYTES = 16 * MB


def estimated_bytes(df: DataFrame) -> int | None:
    """Size Spark itself plans with, or None where it gives no statistics."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # Spark Connect has no JVM plan handle
        return None


def is_small(df: DataFrame, limit: int = SMALL_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def measured_bytes(df: DataFrame) -> int:
    """Upper bound on the row data of ``df``, counted by one partial aggregate."""
    fixed, texts = 0, []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            texts.append(F.coalesce(F.sum(F.octet_length(field.name)), F.lit(0)))
            fixed += 24
        else:
            fixed += 16
    total = F.count(F.lit(1)) * F.lit(fixed)
    for text in texts:
        total = total + text
    return int(df.agg(total.alias("n")).first()["n"])


def fits_auto_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own threshold makes it broadcast ``df`` without being asked."""
    try:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    except AttributeError:
        return False
    return is_small(df, limit)


def broadcast_if_bounded(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its counted size is under ``limit``.

    Small inputs are left to Spark's own threshold. Larger ones are measured, and
    above the limit the join stays a shuffle join, where adaptive execution splits
    hot keys of the streamed side. A limit of 0 switches measuring off.
    """
    if limit <= 0 or fits_auto_broadcast(df):
        return df
    return F.broadcast(df) if measured_bytes(df) <= limit else df
