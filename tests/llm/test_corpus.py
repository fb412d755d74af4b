"""Sharding, mixing, near copies and the language model, against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starload.llm import class_lm, mixing, near_copies, sharding
from starload.llm.common import read_table
from starload.llm.components import connected_components

from .conftest import AWKWARD, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(FOLD))


# Sharding


def check_shards(rows, texts, shards):
    by_text, loads, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 1 and r["text_crc32"] == zlib.crc32(text.encode())
        by_text[text].add(r["shard"])
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < shards
    return loads


def test_shards_are_balanced_and_groups_whole(spark):
    texts = dict(read_table(spark, SF, "documents").select("doc_id", "text").collect())
    rows = sharding.op1_sharding(spark, SF).collect()
    assert len(rows) == len(texts)
    loads = check_shards(rows, texts, 16)
    groups = Counter()
    for t in texts.values():
        groups[t] += len((t or "").encode()) + 1
    ideal = sum(loads.values()) / 16
    assert max(loads.values()) <= max(max(groups.values()), ideal) * 4 / 3


def test_heavy_groups_and_bundles(docs_of):
    rows = [(i, "hot") for i in range(300)] + [(1000 + i, f"text {i}" * (1 + i % 5)) for i in range(600)]
    docs = docs_of(rows).withColumn("shard", F.lit("x"))
    found = sharding.assign_shards(docs, shards=4, units_per_shard=8).collect()
    loads = check_shards(found, dict((i, t) for i, t in rows), 4)
    assert len(found) == 900 and max(loads.values()) < 1.2 * sum(loads.values()) / 4


def test_shard_edge_cases(docs_of):
    assert sharding.assign_shards(docs_of([])).count() == 0
    found = sharding.assign_shards(docs_of(AWKWARD), shards=3).collect()
    assert len(found) == len(AWKWARD)
    empty = {r["shard"] for r in found if r["doc_id"] in (1, 2)}
    assert len(empty) == 1


def test_longest_first_is_the_greedy_schedule():
    random.seed(2)
    items = [(i, random.randint(1, 50)) for i in range(60)]
    loads = [0] * 5
    expected = {}
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        k = min(range(5), key=lambda j: (loads[j], j))
        expected[item], loads[k] = k, loads[k] + size
    assert sharding.longest_first(items, 5) == expected


# Mixing


def test_mixing_equals_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = sorted(duckdb.sql(mixing.OP7_SQL).fetchall())
    found = mixing.op7_mixing(spark, SF)
    rows = sorted(tuple(r) for r in found.select("doc_id", "size", "source_size", "target", "taken").collect())
    assert rows == expected


def level(sizes, weights, most):
    """Targets by lowering the level of the sources that aren't full, again and again."""
    total, full = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        target = [most * s if i in full else rest * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if target[i] > most * s + 1e-9}
        if not over:
            return target
        full |= over


def test_targets_and_words_taken(docs_of):
    random.seed(4)
    rows, i = [], 0
    for source, n in (("a", 3), ("b", 50), ("c", 200), ("d", 20), (None, 70), ("é", 5)):
        for _ in range(n):
            rows.append((i, "w " * random.randint(0, 40), "en", source))
            i += 1
    docs = docs_of(rows).withColumn("times", F.lit(9)).withColumn("mix_key", F.lit("k"))
    taken = mixing.mix_sources(docs)
    assert taken.columns == docs.columns
    by_source, sizes = Counter(), Counter()
    for _, text, _, source in rows:
        sizes[source] += len(text.split())
    for r in taken.collect():
        by_source[r["source"]] += len(r["text"].split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    targets = level([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 3)
    for s, t in zip(order, targets, strict=True):
        assert abs(by_source[s] - t) <= 20, (s, by_source[s], t)
    assert max(Counter(r["doc_id"] for r in taken.collect()).values()) <= 3
    assert sorted(taken.select("doc_id").collect()) == sorted(mixing.mix_sources(docs).select("doc_id").collect())


def test_mixing_edge_cases(docs_of):
    assert mixing.mix_sources(docs_of([])).count() == 0
    assert mixing.mix_sources(docs_of([(1, None), (2, "")])).count() == 0
    assert mixing.mix_sources(docs_of(AWKWARD)).where("text IS NULL").count() == 0


# Near copies


def set_of(text, width=5):
    w = words_of(text)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def components_of(texts):
    ids = sorted(texts)
    sets, label = {i: set_of(texts[i]) for i in ids}, {i: i for i in ids}
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if x == old else x for i, x in label.items()}
    return label, {i: len(s) for i, s in sets.items()}


def check_components(found, texts):
    label, size = components_of(texts)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == len(texts)
    assert {i: r["component_id"] for i, r in rows.items()} == label
    assert {i: r["n_shingles"] for i, r in rows.items()} == size


def test_near_copies_of_all_documents(spark):
    texts = dict(read_table(spark, SF, "documents").select("doc_id", "text").collect())
    check_components(near_copies.op6_near_copies(spark, SF), texts)


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_passages_and_hot_groups(docs_of, seed):
    random.seed(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [random.choice(words) for _ in range(30)]
    bases = [[random.choice(words) for _ in range(random.choice((6, 40, 80)))] for _ in range(8)]
    texts = {}
    for i in range(160):
        w = list(bases[0] if i % 2 else random.choice(bases))
        for _ in range(random.choice((0, 1, 1, 2, 4))):
            w[random.randrange(len(w))] = random.choice(words)
        if i % 3 == 0:
            w = w + passage
        texts[i] = " ".join(w)
    texts |= {200: "a b", 201: "A b", 202: "a b c", 203: None, 204: " ", 205: "a b c d e", 206: "a b c d e f"}
    join = near_copies.Join(sample=60, costly=3, listed=150, leading=2, rounds=1)
    check_components(near_copies.near_copies(docs_of(list(texts.items())), join), texts)


def test_variants_too_far_apart_meet_few_others(docs_of, monkeypatch):
    """Many variants of one text, most of them not similar to it or to each other, are not paired with each other."""
    random.seed(3)
    base = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(base)}
    for i in range(1, 121):
        w = list(base)
        for k in random.sample(range(150), 1 if i % 4 == 0 else 7):
            w[k] = f"x{i}y{k}"
        texts[i] = " ".join(w)
    met, verified = [], near_copies.verified

    def counted(pairs, *others):
        met.append(pairs.count())
        return verified(pairs, *others)

    monkeypatch.setattr(near_copies, "verified", counted)
    join = near_copies.Join(sample=120, leading=2, rounds=1)
    check_components(near_copies.near_copies(docs_of(list(texts.items())), join), texts)
    assert sum(met) <= 5 * len(texts)


def test_first_shared_place_bounds_the_sizes():
    """The first element that a similar pair shares stands early enough in both for their sizes."""
    rng = np.random.default_rng(1)
    join, seen = near_copies.Join(), 0
    for _ in range(2000):
        both = np.arange(rng.integers(30, 60)) * 2 + 41
        a, b = (np.unique(np.append(both, rng.choice(60, rng.integers(0, 10)) * 2)) for _ in "ab")
        shared = np.intersect1d(a, b)
        if 100 * len(shared) >= 75 * (len(a) + len(b) - len(shared)):
            for x, y in ((a, b), (b, a)):
                at = np.searchsorted(x, shared[0])
                upto = duckdb.sql(f"SELECT {near_copies.farthest(str(at), str(len(x)), join).replace('DIV', '//')}")
                assert len(y) <= upto.fetchall()[0][0]
                seen += at > 0
    assert seen > 100


def test_components_are_joined_by_links_between_them(spark):
    known = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "node long, component long")
    found = spark.createDataFrame([(2, 6), (3, 7), (7, 9), (1, 2), (20, 21)], "a long, b long")
    label = {r["node"]: r["component"] for r in near_copies.joined_components(known, found).collect()}
    assert label == {1: 1, 2: 1, 5: 1, 6: 1, 3: 3, 7: 3, 8: 3, 9: 3, 20: 20, 21: 20}


def test_near_copy_edge_cases(docs_of):
    assert near_copies.near_copies(docs_of([])).count() == 0
    docs = docs_of(AWKWARD).withColumn("size", F.lit("x")).withColumn("component", F.lit(1))
    rows = near_copies.near_copies(docs).collect()
    assert len(rows) == len(AWKWARD)
    assert {r["component_id"] for r in rows if r["doc_id"] in (4, 7)} == {4}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]


def test_stage_keeps_one_of_each_group(docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(3, text), (1, text + " x"), (1, text + " x"), (2, "other words are here today"), (None, text), (5, None)])
    kept = corpus_pipeline.keep_one_copy(None, docs, "")
    assert kept.columns == docs.columns
    # the row without an id is a near copy of others; the two rows with id 1 are one document
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [1, 2, 5]


def test_stage_keeps_different_texts_under_one_id(docs_of):
    texts = [" ".join(f"{name}{i}" for i in range(60)) for name in "abc"]
    rows = [(7, texts[0]), (7, texts[1]), (None, texts[2]), (None, texts[2] + " x"), (9, texts[1])]
    kept = corpus_pipeline.keep_one_copy(None, docs_of(rows), "").collect()
    assert sorted((r["doc_id"] or -1, r["text"][0]) for r in kept) == [(-1, "c"), (7, "a"), (7, "b")]


def test_prefix_lemma():
    """With any lengths chosen, similar sets share enough of their prefixes."""
    rng = np.random.default_rng(0)
    for _ in range(300):
        base = rng.choice(1000, 60, replace=False)
        a = np.unique(np.append(base[: rng.integers(50, 61)], rng.integers(1000, 2000, rng.integers(0, 5))))
        b = np.unique(np.append(base[rng.integers(0, 4) :], rng.integers(1000, 2000, rng.integers(0, 5))))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        held = np.where(rng.random(2000) < rng.choice([0, 0.2, 0.5, 0.95]), rng.integers(3, 60, 2000), 0)
        costs = near_copies.Costs(np.flatnonzero(held).astype(np.uint64), held[held > 0])
        join = near_copies.Join()
        (a, of_a), (b, of_b) = (near_copies.in_order(s.astype(np.uint64), costs) for s in (a, b))
        (la, na), (lb, nb) = (near_copies.prefix(cost, join) for cost in (of_a, of_b))
        assert len(np.intersect1d(a[:la], b[:lb])) >= min(na, nb) >= near_copies.base(min(len(a), len(b)), join)
        for elements, cost in ((a, of_a), (b, of_b)):
            assert (held[elements.astype(int)] == cost).all() and (np.diff(cost) >= 0).all()


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (200, 200)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    label = {r["node"]: r["component"] for r in found}
    assert {label[i] for i in range(61)} == {0} and label[101] == label[100] == 100 and 200 not in label


# Language model


def test_model_counts_and_gain(spark):
    texts = dict(read_table(spark, SF, "documents").select("doc_id", "text").collect())
    rows = class_lm.op2_class_lm(spark, SF).collect()
    tokens = {i: [*words_of(t), "\n"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, kinds = sum(count.values()), len(count)
    assert len(rows) == len(texts)
    for r in rows:
        ws = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"]) == (held[r["doc_id"]], len(ws))
        assert (r["n_known"], r["train_tokens"]) == (sum(count[w] > 0 for w in ws), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_probabilities_add_up_and_score_is_their_product(docs_of):
    random.seed(8)
    docs = [(i, " ".join(random.choice(["a b", "c d", "e", "f g h"]) for _ in range(30))) for i in range(40)]
    model = class_lm.Brown(classes=4)
    known = "abcdefgh"
    probes = [(1000 + k, w) for k, w in enumerate([*known, "zzz"])]  # one-word texts, and the empty one
    rows = class_lm.scores(docs_of([*docs, *probes, (2000, None)]), F.col("doc_id") >= 1000, model).collect()
    score = {r["doc_id"]: r["score"] for r in rows}
    # P(w, end) summed over w is P(first word = w) P(end | w); with P(end) first it can't pass 1.
    assert 0 < sum(10 ** score[i] for i, _ in probes) + 10 ** score[2000] <= 1 + 1e-9
    assert {r["n_known"] for r in rows if r["doc_id"] == 1008} == {1}
    cells, tokens, types = np.random.default_rng(0).integers(0, 9, (5, 5)), np.array([9.0, 4, 7, 2]), np.array([3.0, 1, 2, 1])
    table = 10 ** class_lm.transitions(cells, tokens, types, model)
    within = (tokens - model.discount * types) / tokens
    assert np.allclose((table[:, :4] * within).sum(1) + table[:, 4], 1)


def test_exchange_finds_the_best_single_move():
    rng = np.random.default_rng(3)
    pairs, classes, number = rng.integers(0, 6, (9, 9)), rng.integers(0, 3, 9), 3

    def likelihood(c):
        m = np.zeros((number, number))
        np.add.at(m, (c[:, None].repeat(9, 1), c[None].repeat(9, 0)), pairs)
        f = lambda x: np.where(x > 0, x * np.log(np.maximum(x, 1)), 0).sum()
        return f(m) - f(m.sum(1)) - f(m.sum(0)), m

    for w in range(9):
        _, m = likelihood(classes)
        others = np.arange(9) != w
        right = np.bincount(classes[others], pairs[w][others], number)
        left = np.bincount(classes[others], pairs[:, w][others], number)
        got = class_lm.best_class(m, m.sum(1), m.sum(0), right, left, int(pairs[w, w]), int(classes[w]))
        best = [likelihood(np.where(np.arange(9) == w, k, classes))[0] for k in range(number)]
        assert math.isclose(best[got], max(best), rel_tol=1e-9)


def test_words_are_placed_many_at_once():
    """As one by one, ties between empty or equal classes included, without a call for each word."""
    rng = np.random.default_rng(5)
    for number, most in ((4, 3), (32, 50), (32, 100_000)):
        pairs = rng.integers(0, most, (number, number)).astype(float)
        pairs[:, 3] = pairs[3] = 0
        pairs[1], pairs[:, 1] = pairs[0], pairs[:, 0]
        sums = pairs, pairs.sum(1), pairs.sum(0)
        words = [np.sort(rng.choice(2 * number, rng.integers(1, 2 * number), replace=False)) for _ in range(500)]
        counts = [rng.integers(1, 40, len(w)) for w in words]
        word = np.repeat(np.arange(500), list(map(len, words)))
        got = class_lm.best_classes(*sums, word, np.concatenate(words), np.concatenate(counts))
        both = [np.bincount(w, n, 2 * number) for w, n in zip(words, counts, strict=True)]
        assert got.tolist() == [class_lm.best_class(*sums, b[:number], b[number:], 0, -1) for b in both]


def test_words_are_not_placed_one_by_one(docs_of, monkeypatch):
    pairs = np.random.default_rng(6).integers(1, 1000, (8, 8)).astype(float)
    monkeypatch.setattr(class_lm, "best_class", None)
    word, side = np.arange(3000) // 3, np.tile([0, 5, 11], 1000)
    assert len(class_lm.best_classes(pairs, pairs.sum(1), pairs.sum(0), word, side, 1 + word % 7)) == 1000


def test_model_edge_cases(docs_of):
    assert class_lm.scores(docs_of([]), F.lit(False)).count() == 0
    rows = class_lm.scores(docs_of(AWKWARD).withColumn("held", F.lit(1)), F.lit(False)).collect()
    assert len(rows) == len(AWKWARD) and {r["train_tokens"] for r in rows} == {sum(len(words_of(a[1])) + 1 for a in AWKWARD)}
    untaught = class_lm.scores(docs_of(AWKWARD), F.lit(True)).collect()
    assert {r["score"] for r in untaught} == {None} and {r["n_known"] for r in untaught} == {0}
