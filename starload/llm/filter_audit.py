"""Audit of filters that interact: decision diagrams over failure masks.

Each document has a mask of the filters it fails. Counted masks of a part of the corpus make
one ordered decision diagram: a level for each filter, a low edge for passing it, a high edge
for failing it, and in each node the weight of the documents that go through it. The path
that passes every filter gives, level by level, what each step of that filter order keeps and
removes. Exchanging two neighbouring levels turns the diagram of one order into that of the
next; all orders are visited by such swaps alone, each order differing from the one before
in two neighbours, and no document is read again.

Documents are counted by Spark: a text is reduced to a digest and a mask in the task that
reads it, so that only small rows are shuffled; equal texts meet as counts by digest, which
combine before the shuffle, and never as rows. A part reaches Python as at most one row for
each mask.

A null text is empty and fails the first filter. A null part is the empty string. Rows
without an id have no smaller id and are none, so they never count as copies; rows that
share an id and a text are no copies of one another either. A label counts for every row with its
id, and several labels of one id count if one of them does. Columns other than id, text, part
and labels are ignored. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import _importable, read_table, text_bytes, with_text_columns

FILTERS = "ABCDE"
UPPER = bytes(range(65, 91))
MARKS = b"#$%&*|"
#: Weights carried by every node: documents, those labelled good, those labelled toxic.
MEASURES = 3

TRAITS = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("mask", T.IntegerType())])
STEPS = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("filter_order", T.StringType()),
        T.StructField("step", T.IntegerType()),
        *[
            T.StructField(name, T.LongType())
            for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
        ],
    ]
)


# one text


def own_failures(text: bytes) -> int:
    """Bits 0 to 3: the filters A to D that a text fails by itself."""
    words = text.split()
    size = len(text)
    letters = size - len(text.translate(None, UPPER))
    continuation = np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80)
    few = len(words) < 100
    dull = 100 * len(set(words)) < 80 * len(words)
    loud = 100 * letters > 10 * (size - int(continuation))
    marked = len(text.translate(None, MARKS)) < size
    return few | dull << 1 | loud << 2 | marked << 3


def with_traits(docs: DataFrame, text: str = "text", name: str = "traits") -> DataFrame:
    """``docs`` without their texts, and a struct of the text's digest and own failures."""

    def steps():
        def step(texts: pa.Array) -> list[pa.Array]:
            found = [t or b"" for t in text_bytes(texts)]
            digests = [hashlib.sha256(t).digest() for t in found]
            return [pa.array(digests, pa.binary()), pa.array([own_failures(t) for t in found], pa.int32())]

        return step

    return with_text_columns(docs, text, name, TRAITS, steps, drop_text=True)


# counted masks


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the flags ``good`` and ``toxic`` of their ``doc_id``."""
    flags = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
        .where("good OR toxic")
    )
    # rows without an id match nothing, and are dealt by their digest instead of one null key
    spread = rows.withColumn("spread", F.expr("IF(doc_id IS NULL, xxhash64(digest), 0)"))
    flags = flags.withColumn("zero", F.lit(0).cast("long"))
    joined = spread.join(flags, (spread["doc_id"] == flags["label_id"]) & (spread["spread"] == flags["zero"]), "left")
    return joined.selectExpr(*rows.columns, "COALESCE(good, false) AS good", "COALESCE(toxic, false) AS toxic")


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Rows ``part, mask, n, n_good, n_toxic``: bit 4 of the mask marks a copy of a smaller id's text.

    Rows with one id and text are counted first, dealt by id and digest, so a text with very
    many copies is spread; the second count combines before its shuffle and leaves a text
    one row for each part and label.
    """
    key = F.coalesce(F.col(part), F.lit("")).cast("string").alias("part")
    rows = with_traits(docs.select("doc_id", key, "text")).selectExpr("doc_id", "part", "traits.digest", "traits.mask")
    own = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    text = ["digest", "mask", "part", "good", "toxic"]
    numbered = F.expr("IF(doc_id IS NOT NULL, STRUCT(doc_id, n), NULL)")
    texts = (
        labelled(own, labels)
        .groupBy(*text)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.expr("IF(doc_id IS NULL, n, 0)")).alias("n_unnamed"),
            F.min(numbered).alias("first"),
        )
    )
    # a text has as many rows here as it has parts and labels, each with its own smallest id
    first = F.min("first.doc_id").over(Window.partitionBy("digest"))
    split = texts.withColumn("smallest", first).selectExpr(
        *text,
        "n_unnamed + IF(first.doc_id = smallest, first.n, 0) AS n_first",
        "n",
    )
    kinds = split.selectExpr(
        "part",
        "good",
        "toxic",
        "explode(array(struct(mask AS mask, n_first AS n), struct(mask + 16 AS mask, n - n_first AS n))) AS kind",
    )
    return (
        kinds.where("kind.n > 0")
        .groupBy("part", F.col("kind.mask").alias("mask"))
        .agg(
            F.sum("kind.n").alias("n"),
            F.sum(F.expr("IF(good, kind.n, 0)")).alias("n_good"),
            F.sum(F.expr("IF(toxic, kind.n, 0)")).alias("n_toxic"),
        )
    )


# the diagram of one part


class Node:
    """Weight of the documents that reach it, and its passing and failing successor."""

    __slots__ = ("weight", "low", "high")

    def __init__(self, weight: tuple[int, ...], low: Node | None = None, high: Node | None = None):
        self.weight, self.low, self.high = weight, low, high


def _plus(*nodes: Node | None) -> tuple[int, ...]:
    present = [n.weight for n in nodes if n is not None]
    return tuple(map(sum, zip(*present, strict=True))) if present else (0,) * MEASURES


class Diagram:
    """Ordered decision diagram whose paths are masks and whose leaves hold their weights.

    An edge that no document takes leads nowhere, and nodes of a level with the same
    successors are one.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], variables: Sequence[int]):
        self.order = list(variables)
        self.total = {
            v: tuple(map(sum, zip((0,) * MEASURES, *[w for m, w in counts.items() if m >> v & 1], strict=True)))
            for v in variables
        }
        self.root = self._build(counts, 0, {})

    def _build(self, counts: dict[int, tuple[int, ...]], level: int, known: dict) -> Node | None:
        if not counts:
            return None
        if level == len(self.order):
            weight = tuple(map(sum, zip(*counts.values(), strict=True)))
            return self._shared(known, level, weight, None, None)
        bit = self.order[level]
        low = self._build({m: w for m, w in counts.items() if not m >> bit & 1}, level + 1, known)
        high = self._build({m: w for m, w in counts.items() if m >> bit & 1}, level + 1, known)
        return self._shared(known, level, _plus(low, high), low, high)

    @staticmethod
    def _shared(known: dict, level: int, weight: tuple[int, ...], low: Node | None, high: Node | None) -> Node:
        key = (level, weight, id(low), id(high))
        if key not in known:
            known[key] = Node(weight, low, high)
        return known[key]

    def _level(self, level: int) -> list[Node]:
        nodes = [self.root] if self.root else []
        for _ in range(level):
            nodes = list({id(s): s for n in nodes for s in (n.low, n.high) if s is not None}.values())
        return nodes

    def swap(self, level: int) -> None:
        """Exchange the variables of ``level`` and the next; only nodes of these two change."""
        known: dict = {}

        def joined(low: Node | None, high: Node | None) -> Node | None:
            if low is None and high is None:
                return None
            return self._shared(known, level + 1, _plus(low, high), low, high)

        for node in self._level(level):
            below = [(n.low, n.high) if n is not None else (None, None) for n in (node.low, node.high)]
            (pass_pass, pass_fail), (fail_pass, fail_fail) = below
            node.low, node.high = joined(pass_pass, fail_pass), joined(pass_fail, fail_fail)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the path that passes all: variable, weight kept and weight removed of each level."""
        found, node, nothing = [], self.root, (0,) * MEASURES
        for variable in self.order:
            low, high = (node.low, node.high) if node is not None else (None, None)
            found.append((variable, low.weight if low else nothing, high.weight if high else nothing))
            node = low
        return found

    def sole(self, variable: int) -> int:
        """Documents that fail this filter and no other."""
        node = self.root
        for v in self.order:
            if node is not None:
                node = node.high if v == variable else node.low
        return node.weight[0] if node is not None else 0


def neighbour_swaps(n: int) -> list[int]:
    """Levels whose swaps lead through all orders of ``n`` variables, each met once.

    The last variable sweeps from one end to the other; between sweeps the others make
    their next swap.
    """
    if n < 2:
        return []
    inner = neighbour_swaps(n - 1)
    found: list[int] = []
    for i in range(len(inner) + 1):
        found += range(n - 2, -1, -1) if i % 2 == 0 else range(n - 1)
        if i < len(inner):
            # the sweeping variable stands in front after each sweep down
            found.append(inner[i] + (i % 2 == 0))
    return found


def audit(counts: dict[int, tuple[int, ...]], names: str = FILTERS) -> list[tuple]:
    """Rows ``order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    diagram = Diagram(counts, range(len(names)))
    sole = [diagram.sole(v) for v in range(len(names))]
    orders = [(tuple(diagram.order), diagram.steps())]
    for level in neighbour_swaps(len(names)):
        diagram.swap(level)
        orders.append((tuple(diagram.order), diagram.steps()))
    shapley = [0] * len(names)
    for _, steps in orders:
        for v, _, removed in steps:
            shapley[v] += removed[0]
    rows = []
    for order, steps in orders:
        label = "".join(names[v] for v in order)
        for i, (v, kept, removed) in enumerate(steps, 1):
            redundant = diagram.total[v][0] - removed[0]
            rows.append((label, i, kept[0], removed[0], redundant, sole[v], removed[1], removed[2], shapley[v]))
    return rows


def audit_filters(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """Steps of every filter order for every part of ``part, mask, n, n_good, n_toxic``."""
    _importable(counts.sparkSession)

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pydict()
        weights = {
            m: (n, good, toxic)
            for m, n, good, toxic in zip(rows["mask"], rows["n"], rows["n_good"], rows["n_toxic"], strict=True)
        }
        found = audit(weights, names)
        columns = [pa.array([rows["part"][0]] * len(found), pa.string())]
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
        columns += [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.Table.from_arrays(columns, names=STEPS.fieldNames())

    return counts.groupBy("part").applyInArrow(run, STEPS)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return audit_filters(mask_counts(docs, read_table(spark, sf_dir, "labels")))


OP13_SQL = """
WITH base AS (
    SELECT doc_id, COALESCE(lang, '') AS part, COALESCE(text, '') AS text,
           regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
           MIN(doc_id) OVER (PARTITION BY COALESCE(text, '')) AS first_id
    FROM documents),
flags AS (SELECT doc_id, MAX(quality = 1) AS good, MAX(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failing AS (
    SELECT part,
           CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails,
           COALESCE(good, false) AS good, COALESCE(toxic, false) AS toxic
    FROM base LEFT JOIN flags USING (doc_id)),
kinds AS (
    SELECT part, fails, COUNT(*) AS n, COUNT(*) FILTER (WHERE good) AS n_good,
           COUNT(*) FILTER (WHERE toxic) AS n_toxic
    FROM failing GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, step FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
counted AS (
    SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
           SUM(CASE WHEN NOT regexp_matches(fails, '[' || substr(filter_order, 1, step) || ']') THEN n ELSE 0 END) AS kept,
           SUM(CASE WHEN out THEN n ELSE 0 END) AS removed,
           SUM(CASE WHEN contains(fails, substr(filter_order, step, 1)) AND NOT out THEN n ELSE 0 END) AS redundant,
           SUM(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END) AS unique_fails,
           SUM(CASE WHEN out THEN n_good ELSE 0 END) AS good_lost,
           SUM(CASE WHEN out THEN n_toxic ELSE 0 END) AS toxic_lost
    FROM (SELECT *, contains(fails, substr(filter_order, step, 1))
                    AND NOT regexp_matches(fails, '[' || substr(filter_order, 1, step - 1) || '_]') AS out
          FROM kinds, steps) k
    GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted"""
