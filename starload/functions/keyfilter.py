"""Bloom filters of keys as small tables that merge, built and asked by SQL functions.

A filter is a table of blocks. The hash of a key names one block, and further hashes name
bits in it, so asking about a key is one equal join on the block number and a few bit
tests. Blocks are bitmaps; two filters of one shape merge by uniting the bitmaps of each
block. A key that was put in always answers yes; one that was not answers yes now and then.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.names import quoted

# Fixed value: bits of one bitmap of Spark's bitmap functions.
BLOCK_BITS = 32_768
BLOCK, BITMAP = "block", "bitmap"
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class FilterShape:
    """``blocks`` bitmaps in all, ``hashes`` bits for each key."""

    blocks: int
    hashes: int = 7

    def __post_init__(self) -> None:
        if self.blocks < 1 or self.hashes < 1:
            raise ValueError("a filter needs a block and a hash")

    @classmethod
    def for_keys(cls, keys: int, bits: int = 12, hashes: int = 7) -> FilterShape:
        """Shape with about ``bits`` bits for each of ``keys`` keys."""
        return cls(max(1, -(-keys * bits // BLOCK_BITS)), hashes)

    def capacity(self, bits: int = 12) -> int:
        """How many keys it holds at ``bits`` bits each."""
        return self.blocks * BLOCK_BITS // bits

    @property
    def bytes(self) -> int:
        return self.blocks * (BLOCK_BITS // 8 + 32)


def _places(key: Sequence[str], shape: FilterShape) -> tuple[str, list[str]]:
    """Block and bits of a key in SQL, null parts included."""
    names = ", ".join(quoted(k) for k in key)
    block = f"PMOD(XXHASH64({names}), {shape.blocks}L)"
    return block, [f"PMOD(XXHASH64({names}, {i}), {BLOCK_BITS}L)" for i in range(1, shape.hashes + 1)]


def build_filter(keys: DataFrame, key: Sequence[str], shape: FilterShape) -> DataFrame:
    """Rows ``block, bitmap`` for the keys of a frame; bitmaps combine before the shuffle."""
    block, bits = _places(key, shape)
    placed = keys.selectExpr(f"{block} AS {BLOCK}", f"EXPLODE(ARRAY({', '.join(bits)})) AS bit")
    return placed.groupBy(BLOCK).agg(F.bitmap_construct_agg("bit").alias(BITMAP))


def merge_filters(filters: DataFrame) -> DataFrame:
    """One filter from the blocks of several filters of one shape."""
    return filters.groupBy(BLOCK).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def maybe_in(
    df: DataFrame, key: Sequence[str], found: DataFrame, shape: FilterShape, name: str = "maybe_in"
) -> DataFrame:
    """``df`` with the flag ``name``: false only where the filter surely never held the key.

    Key columns must have the types they had when the filter was built. The shape bounds the
    size of a filter; up to ``BROADCAST_BYTES`` it is broadcast, beyond it is joined by block.
    """
    block, bits = _places(key, shape)
    asked = df.selectExpr("*", f"{block} AS __block")
    blocks = found.selectExpr(f"{BLOCK} AS __of", f"{BITMAP} AS __bits")
    if shape.bytes <= BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    tests = [
        f"SHIFTRIGHT(CAST(CONV(HEX(SUBSTRING(__bits, CAST({b} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT),"
        f" CAST({b} % 8 AS INT)) & 1 = 1"
        for b in bits
    ]
    joined = asked.join(blocks, asked["__block"] == blocks["__of"], "left")
    flag = f"COALESCE({' AND '.join(f'({t})' for t in tests)}, false) AS {quoted(name)}"
    return joined.selectExpr(*[quoted(c) for c in df.columns], flag)
