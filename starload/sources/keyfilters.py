"""Key filters stored next to a history, one version for each load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.keyfilter import BITMAP, BLOCK, FilterShape, build_filter, merge_filters
from starload.operators.scd2 import KeyFilter
from starload.schemas import columns
from starload.sources.tables import current_version, publish

_SCHEMA = columns(f"{BLOCK} long, {BITMAP} binary, blocks long, hashes integer")


def read_filter(spark: SparkSession, path: str) -> KeyFilter | None:
    """The newest stored filter, or None."""
    folder = current_version(spark, path)
    if folder is None:
        return None
    stored = spark.read.schema(_SCHEMA).parquet(folder)
    shape = stored.select("blocks", "hashes").first()
    return KeyFilter(stored.select(BLOCK, BITMAP), FilterShape(shape["blocks"], shape["hashes"])) if shape else None


def publish_filter(found: DataFrame, shape: FilterShape, path: str) -> None:
    shaped = found.select(BLOCK, BITMAP, F.lit(shape.blocks).cast("long").alias("blocks"), F.lit(shape.hashes).alias("hashes"))
    publish(shaped.coalesce(max(1, shape.bytes // (32 << 20))), path)


def renew_filter(
    spark: SparkSession, path: str, added: DataFrame, known: DataFrame, key: Sequence[str], entities: int, bits: int
) -> None:
    """Add the keys of ``added`` to the stored filter.

    Only these keys are read; bits of the versions before are united with theirs. A filter
    that would hold more than its capacity, or that does not exist yet, is built anew from
    ``known`` and ``added`` for twice the ``entities`` it has to hold.
    """
    before = read_filter(spark, path)
    if before is not None and entities <= before.shape.capacity(bits):
        more = build_filter(added.select(*key), key, before.shape)
        publish_filter(merge_filters(before.blocks.unionByName(more)), before.shape, path)
        return
    shape = FilterShape.for_keys(2 * entities, bits)
    keys = known.select(*key).unionByName(added.select(*key))
    publish_filter(build_filter(keys, key, shape), shape, path)
