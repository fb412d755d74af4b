"""Dense surrogate keys in business-key order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.sources.scratch import materialize

# Fixed value: the seed of a dimension without rows, so that its first key is 1001.
EMPTY_SEED = 1000

# Up to so many counted rows one task numbers them.
SMALL_ROWS = 100_000

_ROW_BITS = 33  # monotonically_increasing_id keeps the row in its low 33 bits


def max_key(dim: DataFrame, surrogate: str, default: int = EMPTY_SEED) -> DataFrame:
    """One row: the highest surrogate in use, or the default for an empty dimension."""
    top = F.coalesce(F.max(surrogate).cast("long"), F.lit(default).cast("long"))
    return dim.agg(top.alias("max_key"))


def assign_surrogate_keys(
    df: DataFrame,
    order_by: Sequence[str],
    surrogate: str,
    seed: Column | int = EMPTY_SEED,
    method: str = "auto",
    partitions: int | None = None,
) -> DataFrame:
    """Number the rows ``seed + 1 … seed + n`` in the order of ``order_by``.

    Rows are dealt to ranges of the order, sorted and written out once, with their place in
    their range; a row's number is that place after the rows of all ranges before. Only the
    counts of ranges, one row for each, are gathered. Where adaptive execution is on it
    decides how many ranges a few rows need; ``partitions`` fixes their number.

    ``range`` counts the ranges when the result is read, ``auto`` at once: up to
    ``SMALL_ROWS`` counted rows, for which an estimate of their size is no bound, are numbered
    by a ``row_number`` over the file. ``window`` is a global ``row_number`` in any case,
    which sorts everything in one task.
    """
    if method not in ("auto", "window", "range"):
        raise ValueError(f"unknown numbering method {method!r}")
    base = F.lit(seed).cast("long") if isinstance(seed, int) else seed.cast("long")
    in_order = F.row_number().over(Window.orderBy(*order_by))
    if method == "window":
        return df.withColumn(surrogate, base + in_order)

    ranges = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    ranged = ranges.sortWithinPartitions(*order_by).withColumn("__row", F.monotonically_increasing_id())
    ranged = materialize(ranged, "numbered").withColumn("__part", F.shiftright("__row", _ROW_BITS))
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    if method == "auto":
        found = counts.collect()  # one row for each range
        if sum(r["__rows"] for r in found) <= SMALL_ROWS:
            return ranged.drop("__part", "__row").withColumn(surrogate, base + in_order)
        counts = df.sparkSession.createDataFrame(found, counts.schema)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    local = F.col("__row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return (
        # one row for each range, so the broadcast is bounded by their number
        ranged.join(F.broadcast(offsets), "__part")
        .withColumn(surrogate, base + F.col("__before") + local)
        .drop("__part", "__row", "__before")
    )
