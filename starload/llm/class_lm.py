"""Scoring with Brown class-based bigrams.

``P(word | word before) = P(class | class before) * P(word | class)``. Classes are found by
exchange: words move to the class that raises the likelihood of the class bigrams most. The
words that make up at least a documented share of all tokens (so their number is bounded by
its inverse) exchange among themselves until few move; every other word of the corpus is
then placed by the same criterion from all its neighbours among them. Counts, classes,
transitions and emissions come from all training documents and all their words.

The corpus is encoded once: each block of texts becomes one row with its own small
dictionary of words and the tokens as numbers in it. Later steps read these rows instead of
texts, and a word is looked up once for each block rather than once for each token. A
document's score is a sum over its class pairs and its words, so no token is joined with
anything.

Unknown words share, in each class, the mass that absolute discounting takes from the known
ones, and the class after an unknown word is drawn from all classes alike. All
probabilities, one unknown type included, add up to 1.

Null and empty texts are the end token only. An empty table gives no rows; without training
texts there is no model and scores are null. Repeated rows count as often as they occur.
Only id and text are read, whatever other columns are called.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import byte_slices, map_batches, read_table, release, sweep, text_bytes
from starload.sources.scratch import materialize

#: The end token as a word; no word holds white space.
END = b"\n"


@dataclass(frozen=True)
class Brown:
    """Number of classes, share of tokens that makes a word exchange, rounds, smoothing.

    ``leading`` is the inverse of the share: at most so many words exchange. ``block`` is the
    text of an encoded row in bytes. ``backoff`` is the weight, in tokens, of the class
    frequencies in the transitions of a class, and ``discount`` what each known word gives up.
    """

    classes: int = 32
    leading: int = 16_384
    rounds: int = 12
    block: int = 8 << 20
    backoff: float = 5.0
    discount: float = 0.5


BLOCK_SCHEMA = "block long, ids array<long>, held array<boolean>, lengths array<int>, words binary, tokens binary, train binary"


def encode_blocks(docs: DataFrame, model: Brown) -> DataFrame:
    """Blocks of texts: ids, held-out flags, tokens of each, distinct words, tokens, training counts.

    ``docs`` has doc_id, text and held. Words are joined by spaces; the end token is the
    first word of each block.
    """
    limit = model.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in byte_slices(batch, "text", limit):
                places: defaultdict[bytes, int] = defaultdict()
                places.default_factory = places.__len__  # a word met first takes the next place
                places[END]
                lengths, pieces = [], []
                held = part.column(2).to_pylist()
                for text in text_bytes(part.column(1)):
                    words = (text or b"").lower().split()
                    pieces.append(np.fromiter(map(places.__getitem__, words), np.uint32, len(words)))
                    pieces.append(np.zeros(1, np.uint32))
                    lengths.append(len(words) + 1)
                places.default_factory = None
                tokens = np.concatenate(pieces)
                training = np.repeat(~np.array(held, bool), lengths)
                counts = np.bincount(tokens[training], minlength=len(places)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task << 32 | made], pa.int64()),
                        pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        pa.array([held], pa.list_(pa.bool_())),
                        pa.array([lengths], pa.list_(pa.int32())),
                        pa.array([b" ".join([w for w in places if w != END])], pa.binary()),
                        pa.array([tokens.tobytes()], pa.binary()),
                        pa.array([counts.tobytes()], pa.binary()),
                    ],
                    names=["block", "ids", "held", "lengths", "words", "tokens", "train"],
                )
                made += 1

    return map_batches(docs.select("doc_id", "text", "held"), run, BLOCK_SCHEMA)


def _words(data: bytes) -> list[bytes]:
    return [END, *data.split()]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """One block at a time, so that no second copy of a whole batch is made; lists as arrays of Arrow."""
    for i in range(batch.num_rows):
        yield tuple(
            column[i].values if pa.types.is_list(column.type) else column[i].as_py() for column in batch.columns
        )


def word_counts(blocks: DataFrame) -> DataFrame:
    """Rows (block, place, word, n): each word of a block, and how often it stands in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, words, train in _rows(batch):
                listed, counts = _words(words), np.frombuffer(train, np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(listed), name, np.int64)),
                        pa.array(np.arange(len(listed), dtype=np.int32)),
                        pa.array(listed, pa.binary()),
                        pa.array(counts.astype(np.int64)),
                    ],
                    names=["block", "place", "word", "n"],
                )

    return map_batches(blocks.select("block", "words", "train"), run, "block long, place int, word binary, n long")


def _training_pairs(lengths: pa.Array, held: pa.Array, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token and the token before it, in training texts; before the first stands the end token."""
    before = np.empty_like(tokens)
    before[0] = 0
    before[1:] = tokens[:-1]  # each text ends with the end token
    training = np.repeat(~np.asarray(held), np.asarray(lengths))
    return before[training], tokens[training]


def leading_pairs(blocks: DataFrame, leading: list[bytes]) -> DataFrame:
    """Rows (first, second, n): neighbours among the leading words, by their numbers."""
    shared = blocks.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(leading)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.value
        for batch in batches:
            for lengths, held, words, tokens in _rows(batch):
                own = np.array([numbers.get(w, -1) for w in _words(words)], np.int64)
                a, b = _training_pairs(lengths, held, np.frombuffer(tokens, np.uint32))
                a, b = own[a], own[b]
                both = (a >= 0) & (b >= 0)
                keys, counts = np.unique(a[both] * len(numbers) + b[both], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((keys // len(numbers)).astype(np.int32)),
                        pa.array((keys % len(numbers)).astype(np.int32)),
                        pa.array(counts.astype(np.int64)),
                    ],
                    names=["first", "second", "n"],
                )

    rows = map_batches(
        blocks.select("lengths", "held", "words", "tokens"), run, "first int, second int, n long"
    )
    return rows.groupBy("first", "second").agg(F.sum("n").alias("n"))


def _gain(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def best_class(
    pairs: np.ndarray, rows: np.ndarray, columns: np.ndarray, right: np.ndarray, left: np.ndarray, own: int, stay: int
) -> int:
    """Class that a word fits best.

    ``right`` and ``left`` count the classes after and before the word, ``own`` the word after
    itself; ``pairs``, ``rows`` and ``columns`` are class bigrams and their sums. A word that
    is in them is taken out of class ``stay`` first (-1: it isn't in them).
    """
    if stay >= 0:
        pairs, rows, columns = pairs.copy(), rows.copy(), columns.copy()
        pairs[stay] -= right
        pairs[:, stay] -= left
        pairs[stay, stay] -= own
        rows[stay] -= right.sum() + own
        columns[stay] -= left.sum() + own
    follow, precede = np.flatnonzero(right), np.flatnonzero(left)
    gain = (_gain(pairs[:, follow] + right[follow]) - _gain(pairs[:, follow])).sum(1)
    gain += (_gain(pairs[precede] + left[precede, None]) - _gain(pairs[precede])).sum(0)
    # Where a class follows or precedes itself both changes meet in one cell.
    d = np.diagonal(pairs)
    gain += _gain(d + right + left + own) - _gain(d + right) - _gain(d + left) + _gain(d)
    gain -= _gain(rows + right.sum() + own) - _gain(rows)
    gain -= _gain(columns + left.sum() + own) - _gain(columns)
    best = int(np.argmax(gain))
    return stay if stay >= 0 and gain[best] <= gain[stay] + 1e-9 else best


def best_classes(
    pairs: np.ndarray, rows: np.ndarray, columns: np.ndarray, word: np.ndarray, side: np.ndarray, n: np.ndarray
) -> np.ndarray:
    """What ``best_class`` gives for words that are not in ``pairs``, for many words at once.

    ``word`` numbers the words from 0, ascending, each with an entry; ``side`` is the class after
    the word, or that before it plus the number of classes, and ``n`` how often. Where rounding
    could decide between classes the word goes through ``best_class``.
    """
    number = len(pairs)
    words = int(word[-1]) + 1
    both = np.bincount(word * 2 * number + side, n, words * 2 * number).reshape(words, 2 * number)
    right, left = both[:, :number], both[:, number:]
    beside = np.hstack([pairs, pairs.T]).T  # of each side the counts with every class
    cells, which = np.unique(n * 2 * number + side, return_inverse=True)
    known = beside[cells % (2 * number)]
    table = _gain(known + (cells // (2 * number))[:, None]) - _gain(known)
    starts = np.searchsorted(word, np.arange(words))
    gain = np.add.reduceat(table[which], starts)
    w, c = np.nonzero((right > 0) & (left > 0))
    own, after, before = np.diagonal(pairs)[c], right[w, c], left[w, c]
    gain[w, c] += _gain(own + after + before) - _gain(own + after) - _gain(own + before) + _gain(own)
    for sums, total in ((rows, right.sum(1)), (columns, left.sum(1))):
        size, which = np.unique(total, return_inverse=True)
        gain -= (_gain(sums + size[:, None]) - _gain(sums))[which]
    best = gain.argmax(1)
    close = 1e-14 * max(1.0, _gain(columns).max(), _gain(rows).max())
    met: dict[bytes, int] = {}
    for k in np.flatnonzero((gain >= gain.max(1, keepdims=True) - close).sum(1) > 1):
        key = both[k].tobytes()
        if key not in met:
            met[key] = best_class(pairs, rows, columns, right[k], left[k], 0, -1)
        best[k] = met[key]
    return best


def class_bigrams(pairs: DataFrame, classes: list[int], number: int) -> np.ndarray:
    """Matrix of class bigrams of the leading pairs."""
    shared = pairs.sparkSession.sparkContext.broadcast(np.array(classes, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = shared.value, np.zeros(number * number, np.int64)
        for batch in batches:
            first, second, n = (batch.column(i).to_numpy() for i in range(3))
            total += np.bincount(own[first] * number + own[second], n, number * number).astype(np.int64)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    cells = map_batches(pairs, run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(number * number)
    for r in cells:
        out[r["cell"]] = r["n"]
    return out.reshape(number, number)


def exchange(pairs: DataFrame, words: int, model: Brown) -> list[int]:
    """Classes of the leading words after the exchange.

    In each round all words of one half (by number, alternating) choose their best class
    given the others, in parallel; the driver holds one class for each word and the matrix.
    """
    number = model.classes
    side = F.explode(
        F.array(
            F.struct(F.col("first").alias("word"), F.col("second").alias("other"), F.lit(True).alias("after")),
            F.struct(F.col("second").alias("word"), F.col("first").alias("other"), F.lit(False).alias("after")),
        )
    )
    sides = pairs.select(side.alias("s"), "n").select("s.*", "n")
    beside = materialize(
        sides.groupBy("word").agg(
            *[
                F.collect_list(F.when(F.col("after") == after, F.struct("other", "n"))).alias(name)
                for after, name in ((True, "right"), (False, "left"))
            ]
        ),
        "neighbours",
    )
    flat = beside.select(
        "word", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("right", "left") for c in ("other", "n")]
    )
    classes = [i % number for i in range(words)]
    for turn in range(2 * model.rounds):
        matrix = class_bigrams(pairs, classes, number)
        shared = pairs.sparkSession.sparkContext.broadcast((matrix, np.array(classes, np.int64)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matrix, own = shared.value
            rows, columns = matrix.sum(1), matrix.sum(0)
            for batch in batches:
                lists = [batch.column(i) for i in range(5)]
                found = []
                for k in range(batch.num_rows):
                    word = lists[0][k].as_py()
                    others = [np.asarray(lists[i][k].values) for i in (1, 2, 3, 4)]
                    itself = int(others[1][others[0] == word].sum())
                    sides = [
                        np.bincount(own[o[o != word]], n[o != word], number) for o, n in (others[:2], others[2:])
                    ]
                    found.append(best_class(matrix, rows, columns, *sides, itself, int(own[word])))
                yield pa.RecordBatch.from_arrays(
                    [lists[0], pa.array(found, pa.int32())], names=["word", "class"]
                )

        moved = 0
        half = flat.where(F.pmod(F.col("word"), F.lit(2)) == turn % 2)
        for r in map_batches(half, run, "word int, class int").collect():
            moved += classes[r["word"]] != r["class"]
            classes[r["word"]] = r["class"]
        if turn >= 4 and moved * 200 < words:
            break
    return classes


def context_classes(blocks: DataFrame, leading: list[bytes], classes: list[int], matrix: np.ndarray) -> DataFrame:
    """Columns word, class of all words that don't lead: placed by their neighbours that do."""
    number = len(matrix)
    own = dict(zip(leading, classes, strict=True))
    shared = blocks.sparkSession.sparkContext.broadcast((own, matrix))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = shared.value
        for batch in batches:
            for lengths, held, words, tokens in _rows(batch):
                listed = _words(words)
                klass = np.array([own.get(w, -1) for w in listed], np.int64)
                a, b = _training_pairs(lengths, held, np.frombuffer(tokens, np.uint32))
                a, b = a.astype(np.int64), b.astype(np.int64)
                after = (klass[a] < 0) & (klass[b] >= 0)
                before = (klass[a] >= 0) & (klass[b] < 0)
                cells = np.concatenate(
                    [a[after] * 2 * number + klass[b[after]], (b[before] * 2 + 1) * number + klass[a[before]]]
                )
                cells, counts = np.unique(cells, return_counts=True)
                place = cells // (2 * number)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(listed, pa.binary()).take(pa.array(place)),
                        pa.array((cells % (2 * number)).astype(np.int16)),
                        pa.array(counts.astype(np.int32)),
                    ],
                    names=["word", "side", "n"],
                )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, matrix = shared.value
        rows, columns = matrix.sum(1), matrix.sum(0)
        for batch in batches:
            found = []
            for start in range(0, batch.num_rows, 5_000):
                part = batch.slice(start, 5_000)
                side, n = (part.column(i).flatten().to_numpy().astype(np.int64) for i in (1, 2))
                word = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column(1)).to_numpy())
                found.append(best_classes(matrix, rows, columns, word, side, n))
            classes = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(classes.astype(np.int32))], names=["word", "class"]
            )

    sides = map_batches(blocks.select("lengths", "held", "words", "tokens"), count, "word binary, side short, n int")
    # blocks have added up their own counts; dealt by word, both sums need no further shuffle
    sums = sides.repartition("word").groupBy("word", "side").agg(F.sum("n").alias("n"))
    lists = sums.groupBy("word").agg(F.collect_list(F.struct("side", "n")).alias("s"))
    return map_batches(lists.select("word", "s.side", "s.n"), place, "word binary, class int")


def scores(docs: DataFrame, held_out: Column, model: Brown = Brown(), identity: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents where ``held_out`` holds teach nothing.
    """
    spark, number = docs.sparkSession, model.classes
    rows = docs.select(
        F.col(identity).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held"),
    )
    blocks = materialize(encode_blocks(rows, model), "blocks")
    totals = word_counts(blocks).where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = materialize(totals, "vocabulary")
    del totals
    sweep(spark)
    size = vocabulary.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    tokens, types = size["tokens"] or 0, size["types"]
    frequent = vocabulary.where(F.col("n") * model.leading >= max(1, tokens)).orderBy(F.desc("n"), "word").collect()
    leading = [bytes(r["word"]) for r in frequent]
    pairs = materialize(leading_pairs(blocks, leading), "leading_pairs")
    classes = exchange(pairs, len(leading), model) if leading else []
    matrix = class_bigrams(pairs, classes, number) if leading else np.zeros((number, number))
    placed = context_classes(blocks, leading, classes, matrix)
    own = spark.createDataFrame([(bytearray(w), c) for w, c in zip(leading, classes, strict=True)], "word binary, own int")
    known = (
        vocabulary.join(placed, "word", "left")
        .join(F.broadcast(own), "word", "left")
        .select("word", "n", F.coalesce("own", "class", F.lit(0)).alias("class"))
    )
    known = materialize(known, "word_classes")
    release(vocabulary)
    del placed
    sweep(spark)
    stats = known.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()
    class_tokens, class_types = np.zeros(number), np.zeros(number)
    for r in stats:
        class_tokens[r["class"]], class_types[r["class"]] = r["n"], r["types"]

    looked_up = (
        word_counts(blocks)
        .drop("n")
        .join(known.hint("shuffle_hash"), "word")  # a row for each word: its hash table is small, the blocks need no sort
        .groupBy("block")
        .agg(F.collect_list(F.struct("place", "n", "class")).alias("k"))
        .select("block", F.col("k.place").alias("place"), F.col("k.n").alias("n"), F.col("k.class").alias("class"))
    )
    looked_up = materialize(looked_up, "block_words")
    release(known)
    sweep(spark)
    ready = blocks.drop("words", "train").join(looked_up, "block", "left")
    shared = spark.sparkContext.broadcast((tokens, types, class_tokens, class_types))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each text: counts, base score, emissions, and its class pairs as cells and counts."""
        total, kinds, class_n, class_v = shared.value
        side = number + 1  # the last class stands for unknown words
        for batch in batches:
            for ids, held, lengths, data, place, n, klass in _rows(batch):
                seen = np.frombuffer(data, np.uint32).astype(np.int64)
                width = int(seen.max()) + 1
                count, own = np.zeros(width, np.int64), np.full(width, number, np.int64)
                if place is not None:
                    at, inside = np.asarray(place), np.asarray(place) < width
                    count[at[inside]], own[at[inside]] = np.asarray(n)[inside], np.asarray(klass)[inside]
                c = count[seen]
                base = np.log10((count + 0.5) / (total + 0.5 * (kinds + 1)))[seen]
                with np.errstate(divide="ignore", invalid="ignore"):
                    emission = np.log10((count - model.discount) / np.append(class_n, 1)[own])
                emission = np.where(count > 0, emission, 0.0)[seen]
                after = own[seen]
                before = np.empty_like(after)
                before[0], before[1:] = own[0], after[:-1]
                ends = np.cumsum(lengths)
                starts = ends - np.asarray(lengths)
                cells = before * side + after
                found_cells, found_counts = [], []
                for a, b in zip(starts, ends, strict=True):
                    k, m = np.unique(cells[a:b], return_counts=True)
                    found_cells.append(k.astype(np.int16))
                    found_counts.append(m.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        held,
                        lengths.cast(pa.int64()),
                        pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(base, starts)),
                        pa.array(np.add.reduceat(emission, starts)),
                        pa.array(found_cells, pa.list_(pa.int16())),
                        pa.array(found_counts, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "emission", "cells", "counts"],
                )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, emission double,"
        " cells array<short>, counts array<int>"
    )
    wanted = ready.select("ids", "held", "lengths", "tokens", "place", "n", "class")
    texts = materialize(map_batches(wanted, summarise, schema), "text_sums")
    for frame in (blocks, looked_up):
        release(frame)
    cells = np.zeros((number + 1) ** 2)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((number + 1) ** 2, np.int64)
        for batch in batches:
            k, m = batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()
            total += np.bincount(k, m, len(total)).astype(np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["cell", "n"])

    training = texts.where("NOT held_out").select("cells", "counts")
    for r in map_batches(training, add_up, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        cells[r["cell"]] = r["n"]
    table = spark.sparkContext.broadcast(transitions(cells.reshape(number + 1, number + 1), class_tokens, class_types, model))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = table.value.ravel()
        for batch in batches:
            lists = batch.column(6)
            values = logs[lists.flatten().to_numpy()] * batch.column(7).flatten().to_numpy()
            sums = np.add.reduceat(values, lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()) if len(values) else []
            score = pa.array(batch.column(5).to_numpy() + sums, pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), score],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    out = map_batches(
        texts, finish, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    score = F.col("score") if tokens else F.lit(None).cast("double")
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score",
        score.alias("score"),
    )


def transitions(cells: np.ndarray, class_tokens: np.ndarray, class_types: np.ndarray, model: Brown) -> np.ndarray:
    """Log10 of the next class given the one before; the last column is an unknown word, whose
    emission is in it, and the last row stands after one."""
    known = cells[:-1, :-1]
    total = max(1.0, class_tokens.sum())
    overall = class_tokens / total
    following = known + model.backoff * overall
    sums = following.sum(1, keepdims=True)
    following = np.where(sums > 0, following / np.maximum(sums, 1e-300), overall)
    following = np.vstack([following, overall])
    unknown = following @ (model.discount * class_types / np.maximum(class_tokens, 1))
    with np.errstate(divide="ignore"):
        return np.log10(np.maximum(np.column_stack([following, unknown]), 1e-300))


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return scores(docs, held_out)
