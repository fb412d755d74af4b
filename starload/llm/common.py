"""Helpers shared by the operators: text batches, word hashes, freed scratch tables."""

from __future__ import annotations

import gc
import os
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Upper bound on the text that one step inside a task holds besides its Arrow batch; a longer
#: single text is still taken whole.
SLICE_BYTES = 4 << 20
#: Entries of a per-task word cache before it starts afresh.
CACHE_WORDS = 200_000
#: Upper bound on an Arrow batch sent to Python, unless the session names a lower one; a longer
#: single row is still a batch of its own.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it, if they have no other."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: whole texts make batches of a fixed row count unbounded."""
    current = spark.conf.get(BATCH_SETTING)
    digits = current.rstrip("bB")
    if not digits.isdigit() or not 0 < int(digits) <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


def map_batches(df: DataFrame, run, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, whose workers can import this package."""
    _importable(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class WordHashes(dict):
    """64-bit hash of a word (bytes), kept until the cache is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of each value over all its 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` consecutive words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:count].copy()
    for k in range(1, width):
        out *= MULTIPLIER
        out += hashes[k : k + count]
    return mix(out)


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces whose ``column`` holds about ``limit`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def with_text_columns(
    df: DataFrame,
    text: str,
    name: str,
    fields: T.StructType,
    compute: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    drop_text: bool = False,
) -> DataFrame:
    """``df`` and a struct column ``name`` computed from the text column, row by row.

    ``compute()`` runs once per task and gives a function from a text array to one array
    per field. No row moves; all other columns pass through unchanged. A column called
    ``name`` in the input is replaced. ``drop_text`` leaves the text out of the result.
    """
    kept = [c for c in df.columns if c != name]
    source = df.select(*[df[c] for c in kept])
    passed = [c for c in kept if not (drop_text and c == text)]
    schema = T.StructType([*[source.schema[c] for c in passed], T.StructField(name, fields)])
    names = fields.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = compute()
        for batch in batches:
            for part in byte_slices(batch, text):
                arrays = step(part.column(text))
                struct = pa.StructArray.from_arrays(arrays, names=names)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in passed], struct], names=[*passed, name])

    return map_batches(source, run, schema)


def release(df: DataFrame) -> None:
    """Delete the scratch files that a materialized frame reads."""
    spark = df.sparkSession
    for file in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that nothing holds any more.

    It does so when the driver's garbage is collected, which a driver with little to do
    puts off for long; a job of many steps would keep the files of all of them. The last
    query is held until another one has run.
    """
    gc.collect()
    spark.range(1).count()
    spark._jvm.System.gc()
    time.sleep(0.5)
