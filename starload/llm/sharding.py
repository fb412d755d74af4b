"""Sharding by longest processing time.

Documents with equal texts stay together. Items, largest first, go to the shard that holds
least, which a heap gives. An item is a group that is heavy, or a bundle of light groups by
the hash of their text. Heavy means at least one part in ``units`` of all bytes or of all
rows, so there are at most twice ``units`` heavy groups, and ``units`` bundles, however
large the corpus: that many sizes reach the driver and that many shard numbers go back.
With fewer groups than units nearly every group is an item of its own.

A group larger than a shard's share fills one shard, as it may not be split. Null and empty
texts hold no bytes, count as one group and weigh 1 a row. Repeated rows are rows like
others. An empty table gives no rows. Of the input only id and text are read, whatever
other columns are called.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.llm.common import read_table
from starload.sources.scratch import materialize


def longest_first(items: Iterable[tuple[object, int]], shards: int) -> dict[object, int]:
    """Shard of each (item, size): the largest item goes to the least-loaded shard first."""
    loads = [(0, k) for k in range(shards)]
    placed = {}
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, k = heapq.heappop(loads)
        placed[item] = k
        heapq.heappush(loads, (load + size, k))
    return placed


def assign_shards(
    docs: DataFrame, shards: int = 16, units_per_shard: int = 1024, identity: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Columns doc_id, size, text_crc32, shard and slot; slots follow the id within a shard."""
    spark, units = docs.sparkSession, shards * units_per_shard
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = materialize(
        docs.select(
            F.col(identity).alias("doc_id"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.unhex(F.sha2(body, 256)).alias("group"),
        ).withColumn("bundle", F.pmod(F.xxhash64("group"), F.lit(units)).cast("int")),
        "shard_rows",
    )
    total = narrow.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    least_bytes, least_rows = math.ceil((total["bytes"] or 0) / units), math.ceil(total["rows"] / units)
    groups = narrow.groupBy("group").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.first("bundle").alias("bundle")
    )
    heavy = (F.col("bytes") >= max(1, least_bytes)) | (F.col("rows") >= max(2, least_rows))
    items = (
        groups.withColumn("group", F.when(heavy, F.col("group")))
        .groupBy("group", F.when(F.col("group").isNull(), F.col("bundle")).alias("bundle"))
        .agg(F.sum("bytes").alias("bytes"))
        .collect()
    )
    sizes = [((r["group"] is None, bytes(r["group"]) if r["group"] else r["bundle"]), r["bytes"]) for r in items]
    placed = longest_first(sizes, shards)
    of_group = [(bytearray(key), k) for (bundled, key), k in placed.items() if not bundled]
    of_bundle = [(key, k) for (bundled, key), k in placed.items() if bundled]
    by_group = F.broadcast(spark.createDataFrame(of_group, "group binary, own int"))
    by_bundle = F.broadcast(spark.createDataFrame(of_bundle, "bundle int, shared int"))
    placed_rows = (
        narrow.join(by_group, "group", "left")
        .join(by_bundle, "bundle", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own", "shared").alias("shard"))
    )
    return numbered(placed_rows)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with slot: 0, 1, ... within each shard.

    Rows are dealt by ranges of (shard, id), so a shard is spread over tasks; the position
    within a range is frozen in files, and the number of rows in the ranges before is added.
    """
    order = ["shard", "doc_id", "text_crc32"]
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = materialize(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("range"), position.alias("position")),
        "shard_slots",
    )
    parts = dealt.groupBy("range", "shard").agg(F.count(F.lit(1)).alias("rows"), F.min("position").alias("first"))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "range", "shard", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("offset")
    )
    return dealt.join(F.broadcast(offsets), ["range", "shard"]).select(
        *rows.columns, (F.col("position") + F.col("offset")).alias("slot")
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return assign_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
