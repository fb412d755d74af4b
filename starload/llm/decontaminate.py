"""Benchmark decontamination with an FM-index of each shard of the training texts.

A task cuts its documents into shards of bounded size. The words of a shard, numbered by
their first appearance, make one stream with an end mark after each different text; its
suffix array, Burrows-Wheeler transform and a wavelet matrix over the transform make the
FM-index. All windows of the benchmark are searched backwards at once by ranks in the
matrix; rows found are walked back to the nearest sampled position of the stream, which gives
the places of every occurrence. Places merge to spans for each text.

The benchmark is a query set against all rows. It is cut into blocks by a hash of its rows, as
many as its bytes need, and each block is broadcast by itself and then freed; every block
searches all documents, so nothing but the time depends on the size of the benchmark. No row is
shuffled. Memory of a task is that of one shard, one Arrow batch and one block; a text or
an item longer than a shard or block is taken whole.

Windows are ``width`` consecutive words of an item, or all its words where it has fewer. A
null or empty text has no words, and an item without words no window. Equal texts of a
shard stand once in its index and get the same result. Repeated items, and several texts
under one item id, count as one item; an item without an id has the empty id. Extra columns pass
through, one called like the result column is replaced. An empty benchmark finds nothing;
an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import byte_slices, map_batches, read_table, text_bytes, with_text_columns
from starload.sources.scratch import materialize

WINDOW = 10
#: Text of one index, and of one block of the benchmark.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 2 << 20
#: Every such position of a stream is kept with the index; an occurrence is walked back to one.
SAMPLE_EVERY = 16
#: A word holds ASCII letters, digits and all characters beyond ASCII; letters are lowered.
FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
END, PAD = 0, -1

SPANS = T.ArrayType(T.ArrayType(T.IntegerType(), False), False)
OVERLAP = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType(), False)),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


# the index of one shard


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order; the last symbol must occur nowhere else.

    The first sort compares as many symbols as fit 62 bits. After it only suffixes that
    still tie are sorted, by the ranks of what follows, twice as far each time.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    depth = max(1, 62 // bits)
    key = symbols.astype(np.int64)
    for k in range(1, min(depth, n)):
        key <<= bits
        key[:-k] |= symbols[k:]
    order = np.argsort(key)
    ordered = key[order]
    begins = np.empty(n, bool)
    begins[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=begins[1:])
    place = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = place
    tied = np.flatnonzero(~begins | np.append(~begins[1:], False))
    while len(tied):
        starts = order[tied]
        key = rank[starts] << 32 | rank[starts + depth]
        sort = np.argsort(key)
        starts, key = starts[sort], key[sort]
        order[tied] = starts
        begins = np.empty(len(tied), bool)
        begins[0] = True
        np.not_equal(key[1:], key[:-1], out=begins[1:])
        rank[starts] = np.maximum.accumulate(np.where(begins, tied, 0))
        tied = tied[~begins | np.append(~begins[1:], False)]
        depth *= 2
    return order


class Bits:
    """Bit vector with ranks: ones before each 64-bit word, and the words themselves."""

    __slots__ = ("words", "before")

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones in front of each position."""
        word, low = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << low) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def test(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """Ranks and access over a sequence of small numbers, one bit vector a binary digit."""

    def __init__(self, values: np.ndarray, top: int):
        self.levels: list[tuple[int, Bits, int]] = []
        values = values.astype(np.int32)
        for shift in range(max(1, top.bit_length()) - 1, -1, -1):
            ones = (values >> shift & 1).astype(bool)
            zeros = len(values) - int(np.count_nonzero(ones))
            self.levels.append((shift, Bits(ones), zeros))
            values = np.concatenate([values[~ones], values[ones]])
        # where each symbol begins once all digits are dealt out
        self.first = np.zeros(top + 1, np.int64)
        self.first[values[::-1]] = np.arange(len(values) - 1, -1, -1)

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in front of each position."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where(symbols >> shift & 1, zeros + ones, at - ones)
        return at - self.first[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each position, and how often it stands in front of it."""
        symbols = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            hit, ones = bits.test(at), bits.rank(at)
            symbols |= hit.astype(np.int64) << shift
            at = np.where(hit, zeros + ones, at - ones)
        return symbols, at - self.first[symbols]


class FMIndex:
    """Backward search over the words of several texts; no occurrence crosses an end mark."""

    def __init__(self, texts: list[list[bytes]]):
        numbers: dict[bytes, int] = defaultdict(count(1).__next__)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(self.lengths + 1) - 1
        self.begins = ends - self.lengths
        size = int(ends[-1]) + 1 if len(ends) else 0
        stream = np.zeros(size, np.int64)
        inner = np.ones(size, bool)
        inner[ends] = False
        every = map(numbers.__getitem__, chain.from_iterable(texts))
        stream[inner] = np.fromiter(every, np.int64, count=int(self.lengths.sum()))
        self.numbers = dict(numbers)
        top = len(numbers)
        # end marks differ from one another, so that every comparison ends at one
        distinct = stream + (len(ends) - 1)
        distinct[ends] = np.arange(len(ends))
        order = suffix_array(distinct)
        before = stream[order - 1]  # the suffix of the first word follows the last end mark
        self.matrix = WaveletMatrix(before, top)
        self.smaller = np.zeros(top + 2, np.int64)
        np.cumsum(np.bincount(stream, minlength=top + 1), out=self.smaller[1:])
        sampled = order % SAMPLE_EVERY == 0
        sampled |= np.isin(order, self.begins)  # no walk has to cross an end mark
        self.sampled, self.samples = Bits(sampled), order[sampled]
        self.size = size

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[low, high)`` of each phrase: word numbers, filled with ``PAD`` in front."""
        last = phrases[:, -1]
        low, high = self.smaller[last], self.smaller[last + 1]
        for column in range(phrases.shape[1] - 2, -1, -1):
            go = np.flatnonzero((low < high) & (phrases[:, column] != PAD))
            if not len(go):
                break
            word = phrases[go, column]
            base = self.smaller[word]
            low[go] = base + self.matrix.rank(word, low[go])
            high[go] = base + self.matrix.rank(word, high[go])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the stream of each row."""
        found = np.empty(len(rows), np.int64)
        open_rows, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(open_rows):
            hit = self.sampled.test(rows)
            found[open_rows[hit]] = self.samples[self.sampled.rank(rows[hit])] + steps
            open_rows, rows = open_rows[~hit], rows[~hit]
            word, earlier = self.matrix.access(rows)
            rows = self.smaller[word] + earlier
            steps += 1
        return found


# the benchmark


@dataclass(frozen=True)
class Phrases:
    """Different windows of a block of items, and the items each belongs to."""

    words: list[bytes]
    windows: np.ndarray
    lengths: np.ndarray
    owner_begins: np.ndarray
    owners: np.ndarray
    items: list[str]


def phrases_of(rows: Iterable[tuple[str, bytes | None]], width: int) -> Phrases:
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    names: dict[str, int] = defaultdict(count().__next__)
    windows, owners = [np.empty((0, width), np.int64)], []
    for item, text in rows:
        found = np.array([numbers[w] for w in words_of(text)], np.int64)
        if not len(found):
            continue
        if len(found) < width:
            found = np.concatenate([np.full(width - len(found), PAD), found])
        windows.append(np.lib.stride_tricks.sliding_window_view(found, width))
        owners += [names[item]] * len(windows[-1])
    distinct, which = np.unique(np.concatenate(windows), axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.reshape(-1), np.array(owners, np.int64)], axis=1), axis=0)
    begins = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
    lengths = (distinct != PAD).sum(axis=1)
    return Phrases(list(numbers), distinct, lengths, begins, pairs[:, 1], list(names))


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``begins`` and have ``sizes``."""
    offsets = np.cumsum(sizes) - sizes
    return np.repeat(begins - offsets, sizes) + np.arange(int(sizes.sum()))


def occurrences(texts: list[list[bytes]], phrases: Phrases) -> list[tuple[list[list[int]], list[str]]]:
    """For each text the merged spans ``[begin, end]`` of its hit words, and the items found."""
    result: list[tuple[list[list[int]], list[str]]] = [([], []) for _ in texts]
    if not any(texts) or not len(phrases.windows):
        return result
    index = FMIndex(texts)
    number = np.array([index.numbers.get(w, END) for w in phrases.words], np.int64)
    asked = np.where(phrases.windows == PAD, PAD, number[phrases.windows])
    possible = np.flatnonzero((asked != END).all(axis=1))  # every word stands in the shard
    if not len(possible):
        return result
    low, high = index.search(asked[possible])
    sizes = high - low
    which = np.repeat(possible, sizes)
    at = index.locate(_spread(low, sizes))
    if not len(at):
        return result
    text = np.searchsorted(index.begins, at, side="right") - 1

    pairs = np.unique(np.stack([text, which], axis=1), axis=0)
    owned = phrases.owner_begins[pairs[:, 1] + 1] - phrases.owner_begins[pairs[:, 1]]
    owner = phrases.owners[_spread(phrases.owner_begins[pairs[:, 1]], owned)]
    for t, o in np.unique(np.stack([np.repeat(pairs[:, 0], owned), owner], axis=1), axis=0).tolist():
        result[t][1].append(phrases.items[o])

    edge = np.zeros(index.size + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + phrases.lengths[which], -1)
    covered = np.cumsum(edge) > 0  # end marks are never covered, so spans end with their text
    turns = np.flatnonzero(np.diff(covered, prepend=False))
    for begin, end in turns.reshape(-1, 2).tolist():
        t = int(np.searchsorted(index.begins, begin, side="right")) - 1
        base = int(index.begins[t])
        result[t][0].append([begin - base, end - base])
    return result


# tables


def merge_spans(spans: list[list[int]]) -> list[list[int]]:
    """Spans in order, those that overlap or touch as one."""
    merged: list[list[int]] = []
    for begin, end in sorted(spans):
        if merged and begin <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([begin, end])
    return merged


def _search_block(docs: DataFrame, text: str, name: str, block, more: bool) -> DataFrame:
    """``docs`` with what one block finds added to the struct ``name``; the text stays if ``more`` follow."""
    passed = [c for c in docs.columns if c != name and (more or c != text)]
    first = name not in docs.columns
    schema = T.StructType([*[docs.schema[c] for c in passed], T.StructField(name, OVERLAP)])
    kind = pa.struct(
        [("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = block.value
        for batch in batches:
            for part in byte_slices(batch, text, SHARD_BYTES):
                distinct: dict[bytes | None, int] = {}
                place = [distinct.setdefault(t, len(distinct)) for t in text_bytes(part.column(text))]
                words = [words_of(t) for t in distinct]
                found = occurrences(words, phrases)
                rows = [{"n_words": len(words[p]), "spans": found[p][0], "items": found[p][1]} for p in place]
                if not first:
                    for row, old in zip(rows, part.column(name).to_pylist(), strict=True):
                        row["spans"] = merge_spans(old["spans"] + row["spans"])
                        row["items"] = list(dict.fromkeys(old["items"] + row["items"]))
                arrays = [*[part.column(c) for c in passed], pa.array(rows, kind)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*passed, name])

    return map_batches(docs, run, schema)


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    name: str = "overlap",
    width: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without their text, and the struct ``name``: n_words, spans of hit words, items found.

    A span ``[begin, end]`` counts words from 0, its end not included.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item")
    items = benchmark.where(F.col("text").isNotNull()).select(key, "text").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    found = docs.drop(name)
    for i in range(blocks):
        # rows of one block: its bytes are bounded, whatever the benchmark's
        rows = items.where(F.col("block") == i).select("item", F.col("text").cast("binary")).collect()
        block = spark.sparkContext.broadcast(phrases_of(((r[0], bytes(r[1])) for r in rows), width))
        found = _search_block(found, text, name, block, i + 1 < blocks)
        if i + 1 < blocks:
            found = materialize(found, "overlap")
            block.unpersist()
    return found


def without_spans(docs: DataFrame, overlap: str = "overlap", text: str = "text", name: str = "cleaned") -> DataFrame:
    """Texts with the words of their spans, and what stands between these, cut out.

    ``docs`` holds the text and the struct of ``find_overlaps``; the result has the struct
    ``name`` with the field ``text`` instead of the text. What stood around a cut stays.
    """
    packed = "__spans_and_text"
    spans = F.array_join(F.transform(F.col(f"{overlap}.spans"), lambda s: F.array_join(s.cast("array<string>"), ",")), ";")
    joined = docs.withColumn(packed, F.concat(F.coalesce(spans, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit(""))))

    def cut(row: bytes) -> bytes:
        head, _, whole = row.partition(b"\n")
        if not head:
            return whole
        word = np.frombuffer(whole.translate(FOLD), np.uint8) != 0x20
        edges = np.flatnonzero(np.diff(word, prepend=False, append=False)).reshape(-1, 2)
        kept, at = [], 0
        for span in head.split(b";"):
            begin, end = map(int, span.split(b","))
            kept.append(whole[at : edges[begin, 0]])
            at = int(edges[end - 1, 1])
        return b"".join([*kept, whole[at:]])

    def steps():
        return lambda texts: [pa.array([cut(t) for t in text_bytes(texts)], pa.binary()).cast(pa.string())]

    fields = T.StructType([T.StructField("text", T.StringType())])
    return with_text_columns(joined.drop(text), packed, name, fields, steps, drop_text=True)


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_overlaps(docs, read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("overlap.spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    items = F.array_join(F.array_sort("overlap.items"), ",")
    return found.select(
        "doc_id",
        "overlap.n_words",
        n_hit.alias("n_hit"),
        F.size("overlap.items").cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (F.size("overlap.spans") > 0).alias("contaminated"),
    )


OP12_SQL = """
WITH d AS (
    SELECT doc_id, regexp_extract_all(
               translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents),
b AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
               translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM starts),
places AS (
    SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM d, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m),
found AS (
    SELECT DISTINCT p.doc_id, p.i, p.m, windows.item_id
    FROM (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM places) p JOIN windows USING (m, win)),
hits AS (SELECT doc_id, COUNT(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, COUNT(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(names, '')) AS items_sha256,
       COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""
