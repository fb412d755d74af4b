"""Approximate nearest neighbours by inner product, over balanced posting lists.

Entries are put on a sphere by one more component, and questions get a zero in it, so that the
largest inner product is the smallest distance. Centroids are fitted on a bounded sample by k-means with a price on
large clusters. Every vector is filed under its nearest centroid and under up to
``replicas`` others that are nearly as near, so that neighbours across a border are found in
either list. Centroids are few by construction and are searched in each task by a graph in
memory. A query takes the lists in the order of their reach, which is its product with the
centroid plus what the spread of the list along the query may add. What it finds in the first
of them bounds the rest: it goes on to every list whose reach comes up to its last result.

Equal vectors are one entry with its smallest ids, as many as a result can name, so a
vector that a third of all rows hold costs no more than any other. Lists are split into
parts of ``part`` entries and the queries of a list into blocks, and a task scores one block
against one part in double precision; nothing else is gathered by key.

Vectors that are null, empty, zero, hold null or non-finite components, or aren't of the most
common length take no part, nor do rows without an id. Rows that repeat id and vector are
one; an id with several vectors is a candidate with its best, and a query with each. With
fewer candidates than ``neighbours`` all are returned. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.llm.common import _importable, map_batches, read_table
from starload.sources.scratch import materialize


@dataclass(frozen=True)
class Index:
    """Neighbours to return, and the parameters of the index.

    At most ``sample`` vectors, and ``sample_bytes`` of them, fit the centroids; there are
    half the square root of the number of vectors, ``centroids`` at most. ``spread`` is the
    ratio of distances for filing, ``probe`` the number of spreads that an entry may stand off
    its centroid along a query, and ``beam`` the number of centroids that the graph search
    keeps. A query reads ``first`` lists, and lists of ``margin`` times the entries that make
    sure of a full result, whatever their reach.
    """

    neighbours: int = 20
    sample: int = 16_384
    sample_bytes: int = 32 << 20
    centroids: int = 4_096
    degree: int = 16
    replicas: int = 8
    spread: float = 1.2
    probe: float = 2.5
    beam: int = 128
    margin: int = 8
    first: int = 4
    part: int = 4_096
    block: int = 2_048


def usable_vectors(table: DataFrame, identity: str, vector: str) -> DataFrame:
    """Columns vec_id, vector (packed doubles), squared norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed, norms = [], [], []
            for i, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i is None or not values or None in values:
                    continue
                v = np.array(values, np.float64) + 0.0  # no negative zero
                if np.isfinite(v).all() and v.any():
                    ids.append(i)
                    packed.append(v.tobytes())
                    norms.append(float(v @ v))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(packed, pa.binary()), pa.array(norms, pa.float64())],
                names=["vec_id", "vector", "norm"],
            )

    rows = table.select(F.col(identity).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    found = materialize(map_batches(rows, run, "vec_id long, vector binary, norm double"), "vectors")
    lengths = found.groupBy(F.octet_length("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return found.where(F.octet_length("vector") == (lengths[0]["n"] if lengths else 0))


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def lifted(x: np.ndarray, bound: float) -> np.ndarray:
    """``x`` with the component that brings every row to the squared norm ``bound``."""
    return np.column_stack([x, np.sqrt(np.maximum(0, bound - (x * x).sum(1)))])


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T))


def balanced_means(x: np.ndarray, number: int, rounds: int = 10) -> np.ndarray:
    """K-means whose clusters pay for their size, so that lists come out alike."""
    rng = np.random.default_rng(7)
    centres = x[rng.choice(len(x), number, replace=False)].copy()
    sizes, scale = np.full(number, len(x) / number), None
    for _ in range(rounds):
        d = distances(x, centres) ** 2
        scale = scale or float(np.median(d.min(1)))
        own = (d + 0.1 * scale * (sizes * number / len(x) - 1)).argmin(1)
        sizes = np.bincount(own, minlength=number).astype(float)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        filled = sizes > 0
        centres[filled] = sums[filled] / sizes[filled, None]
    return centres


@dataclass(frozen=True)
class Centroids:
    """Centroids, a graph of their neighbours, where to start, and the norm that vectors are lifted to."""

    centres: np.ndarray
    graph: np.ndarray
    start: np.ndarray
    bound: float

    def nearest(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and distances of the centroids that a best-first search keeps, nearest first."""
        beam = min(beam, len(self.centres))
        rows = np.arange(len(x))
        squares = (self.centres * self.centres).sum(1)
        own = (x * x).sum(1)

        def reach(who: np.ndarray, at: np.ndarray) -> np.ndarray:
            dots = np.einsum("bd,bkd->bk", x[who], self.centres[at])
            return np.maximum(0, own[who, None] + squares[at] - 2 * dots)

        kept = np.tile(self.start, (len(x), 1))
        far = reach(rows, kept)
        met = np.zeros((len(x), len(self.centres)), bool)
        met[rows[:, None], kept] = True
        done = np.zeros(kept.shape, bool)
        while True:
            order = np.argsort(far, axis=1, kind="stable")[:, :beam]
            kept, far, done = (np.take_along_axis(a, order, 1) for a in (kept, far, done))
            todo = ~done & np.isfinite(far)
            who = np.flatnonzero(todo.any(1))
            if not len(who):
                return kept, np.sqrt(far)
            place = todo[who].argmax(1)
            done[who, place] = True
            beside = self.graph[kept[who, place]]
            d = np.where(met[who[:, None], beside], np.inf, reach(who, beside))
            met[who[:, None], beside] = True
            more = np.zeros((len(x), beside.shape[1]), np.int64)
            more_far = np.full(more.shape, np.inf)
            more[who], more_far[who] = beside, d
            kept = np.concatenate([kept, more], 1)
            far = np.concatenate([far, more_far], 1)
            done = np.concatenate([done, np.zeros(more.shape, bool)], 1)


def fit_centroids(entries: DataFrame, dim: int, index: Index) -> Centroids:
    stats = entries.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("bound")).first()
    size = min(index.sample, max(256, index.sample_bytes // (8 * dim)))
    rows = entries.orderBy(F.xxhash64("vector"), "vector").limit(size).select("vector").collect()
    x = lifted(np.frombuffer(b"".join(bytes(r["vector"]) for r in rows), np.float64).reshape(-1, dim), stats["bound"])
    number = int(min(max(1, round(stats["n"] ** 0.5 / 2)), index.centroids, len(x)))
    centres = balanced_means(x, number)
    near = np.argsort(distances(centres, centres), axis=1, kind="stable")[:, 1 : index.degree + 1]
    # Links both ways where there is room, and a few far ones, keep the graph connected.
    rng = np.random.default_rng(11)
    far = rng.integers(0, number, (number, 4))
    graph = np.concatenate([near, far, np.roll(np.arange(number), 1)[:, None]], 1)
    for i, beside in enumerate(graph):  # a link that repeats another leads back to its own end
        kept, first = np.unique(beside, return_index=True)
        graph[i] = np.concatenate([beside[np.sort(first)], np.full(len(beside) - len(kept), i)])
    start = np.unique(rng.integers(0, number, 8))
    return Centroids(centres, graph, start, float(stats["bound"]))


def filed(entries: DataFrame, centroids, dim: int, index: Index) -> DataFrame:
    """Columns vector, ids, list and ``off``, the squared distance from the centroid, once for each
    centroid within the ratio."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centroids.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x = _matrix(batch.column("vector"), dim)
                numbers, d = c.nearest(lifted(x, c.bound), 4 * index.replicas)
                wanted = d <= index.spread * d[:, :1] + 1e-12
                wanted[:, index.replicas :] = False
                row, place = np.nonzero(wanted)
                lists = numbers[row, place]
                off = ((x[row] - c.centres[lists, :-1]) ** 2).sum(1)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("vector"), taken.column("ids"), pa.array(lists.astype(np.int32)), pa.array(off)],
                    names=["vector", "ids", "list", "off"],
                )

    return map_batches(entries.select("vector", "ids"), run, "vector binary, ids array<long>, list int, off double")


def by_reach(q: np.ndarray, c: Centroids, widths: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and reach of the lists that questions may read, farthest reach first.

    A question's length changes no order, so it is searched for at the length of the sphere.
    """
    lengths = np.sqrt((q * q).sum(1, keepdims=True))
    on_sphere = np.column_stack([q * (c.bound**0.5 / lengths), np.zeros(len(q))])
    numbers, _ = c.nearest(on_sphere, beam)
    reach = np.take_along_axis(q @ c.centres[:, :-1].T + lengths * widths, numbers, 1)
    order = np.argsort(-reach, axis=1, kind="stable")
    return np.take_along_axis(numbers, order, 1), np.take_along_axis(reach, order, 1)


def probes(
    questions: DataFrame, centroids, dim: int, index: Index, sizes: np.ndarray, widths: np.ndarray, further: bool
) -> DataFrame:
    """Columns vector, list, bound of ``questions`` (vector, bound): the lists to read first, or those
    after them whose reach comes up to the bound."""
    # An entry is in ``replicas`` lists at most, so these hold k + 1 different ones at least.
    least = index.margin * (index.neighbours + 1) * index.replicas

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centroids.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                numbers, reach = by_reach(_matrix(batch.column("vector"), dim), c, widths, index.beam)
                held = sizes[numbers]
                wanted = np.cumsum(held, axis=1) - held < least
                wanted[:, : index.first] = True
                if further:
                    wanted = ~wanted & (reach >= batch.column("bound").to_numpy()[:, None])
                row, place = np.nonzero(wanted)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("vector"), pa.array(numbers[row, place].astype(np.int32)), taken.column("bound")],
                    names=["vector", "list", "bound"],
                )

    return map_batches(questions.select("vector", "bound"), run, "vector binary, list int, bound double")


def nearest(
    table: DataFrame, is_query: Column, index: Index = Index(), identity: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Columns query_id, rank, vec_id, score for each row where ``is_query`` (of vec_id) holds."""
    spark, k = table.sparkSession, index.neighbours
    rows = usable_vectors(table, identity, vector)
    width = rows.select(F.octet_length("vector").alias("n")).limit(1).collect()
    dim = width[0]["n"] // 8 if width else 1
    by_id = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    # The k + 1 smallest ids of a vector are all that a result can name, its own id left out.
    entries = (
        rows.distinct()
        .withColumn("n", by_id)
        .where(F.col("n") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("norm").alias("norm"))
    )
    entries = materialize(entries, "entries")
    asked = materialize(rows.where(is_query).select("vector", F.col("vec_id").alias("query_id")).distinct(), "queries")
    if not width:
        return asked.selectExpr("query_id", "1 AS rank", "query_id AS vec_id", "0D AS score")
    centroids = spark.sparkContext.broadcast(fit_centroids(entries, dim, index))
    postings = materialize(filed(entries, centroids, dim, index), "postings")
    lists = postings.groupBy("list").agg(
        F.count(F.lit(1)).alias("n"), F.avg("off").alias("mean"), F.max("off").alias("most")
    )
    sizes = np.zeros(len(centroids.value.centres), np.int64)
    widths = np.zeros(len(sizes))
    for r in lists.collect():
        sizes[r["list"]] = r["n"]
        # Entries far off, as the longest are, widen their list, without their lone distance deciding alone.
        widths[r["list"]] = index.probe * (r["mean"] ** 0.5 + r["most"] ** 0.5) / 2 / dim**0.5
    parts = lists.select("list", F.ceil(F.col("n") / index.part).alias("parts"))
    keys = ["list", "part", "block"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        """Of a part the best entries, k + 1 at most and none under its bound, for each query of a block."""
        x, q = _matrix(left["vector"], dim), _matrix(right["vector"], dim)
        first = np.array([i[0] for i in left["ids"].to_pylist()], np.int64)
        bounds = right["bound"].to_numpy()
        take = min(k + 1, len(x))
        who, which, value = [], [], []
        for at in range(0, len(q), 256):
            s = q[at : at + 256] @ x.T
            for i, row in enumerate(s if take else ()):
                near = np.flatnonzero(row >= max(bounds[at + i], np.partition(row, len(row) - take)[len(row) - take]))
                best = near[np.lexsort((first[near], -row[near]))[:take]]
                who.append(np.full(len(best), at + i))
                which.append(best)
                value.append(row[best])
        a, b = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (who, which))
        scores = np.concatenate(value) if value else np.empty(0)
        return pa.table({"asked": right["vector"].take(a), "ids": left["ids"].take(b), "score": pa.array(scores)})

    def search(asking: DataFrame) -> DataFrame:
        """Rows (asked, ids, score) of the lists that ``asking`` (vector, list, bound) names."""
        blocks = asking.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / index.block).alias("blocks"))
        shape = F.broadcast(parts.join(blocks, "list"))  # a row for each list
        dealt = postings.join(shape, "list").select(
            "list",
            F.pmod(F.xxhash64("vector"), "parts").alias("part"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
            "vector",
            "ids",
        )
        asked_of = asking.join(shape, "list").select(
            "list",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("vector"), "blocks").alias("block"),
            "vector",
            "bound",
        )
        both = dealt.groupBy(*keys).cogroup(asked_of.groupBy(*keys))
        return both.applyInArrow(score, "asked binary, ids array<long>, score double")

    def best(found: DataFrame) -> DataFrame:
        """The k + 1 best entries of each query, with their place ``n``.

        An entry filed in several lists comes back from each, and its products may differ in
        the last bit.
        """
        order = Window.partitionBy("asked").orderBy(F.desc("score"), F.col("ids")[0])
        once = found.groupBy("asked", "ids").agg(F.max("score").alias("score"))
        return once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)

    # The first lists give each query a score that anything further has to reach.
    _importable(spark)
    questions = asked.select("vector").distinct().withColumn("bound", F.lit(float("-inf")))
    probing = (centroids, dim, index, sizes, widths)
    first_lists = materialize(probes(questions, *probing, further=False), "first_lists")
    near_found = materialize(best(search(first_lists)), "near_found")
    reached = near_found.where(F.col("n") == k + 1).select(
        F.col("asked").alias("vector"), (F.col("score") - F.abs("score") * 1e-9).alias("bound")
    )
    bounded = questions.drop("bound").join(reached, "vector", "left")
    bounded = bounded.withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    further = search(materialize(probes(bounded, *probing, further=True), "further_lists"))
    merged = materialize(best(near_found.drop("n").union(further)).drop("n"), "merged")
    named = (
        asked.join(merged, asked["vector"] == merged["asked"])
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .where("vec_id <> query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return named.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
