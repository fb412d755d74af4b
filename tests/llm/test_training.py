"""Fill-in-middle, decontamination and the filter audit."""

import hashlib
import itertools
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starload.llm import decontaminate, filter_audit, infilling, registry
from starload.llm.common import BATCH_BYTES, BATCH_SETTING, bound_batches, read_table
from workload.compare import difference

from .conftest import AWKWARD, SF

TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wide(docs):
    """Extra columns, some named like those that the operators make."""
    return docs.withColumns({c: F.lit(1) for c in ("infilling", "overlap", "traits", "form", "item", "block", "n", "good")})


@pytest.fixture(scope="module")
def duck():
    import duckdb

    found = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        found.register(name, pq.read_table(f"{SF}/{name}.parquet"))
    return found


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_decontaminate", "op13_filter_audit"])
def test_queries_match_sql(spark, duck, name):
    ours = registry.QUERIES[name](spark, SF).toArrow()
    assert difference(ours, duck.sql(registry.ORACLE[name]).to_arrow_table()) is None


def test_batches_are_bounded_in_bytes(spark):
    before = spark.conf.get(BATCH_SETTING)
    try:
        spark.conf.set(BATCH_SETTING, "64m")
        bound_batches(spark)
        assert spark.conf.get(BATCH_SETTING) == f"{BATCH_BYTES}b"
        spark.conf.set(BATCH_SETTING, "1000b")
        bound_batches(spark)
        assert spark.conf.get(BATCH_SETTING) == "1000b"
    finally:
        spark.conf.set(BATCH_SETTING, before)


# fill-in-middle


def planned(text, key):
    """Straight from the definition, by strings."""
    tokens = TOKEN.findall(text)
    digest = sha(f"1:{'' if key is None else key}")
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(tokens)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


PIECES = st.lists(st.sampled_from(["a", "bc", "Z", " ", "\n", "<", ">", "P", "<P", "S>", "<M>", "é", "中", "\U0001f600", "\x00", "1"]))


@settings(max_examples=300, deadline=None)
@given(PIECES.map("".join) | st.text(), st.integers(-5, 10**12) | st.none())
def test_any_text_is_rearranged_and_restored(text, key):
    n, form, prefix, middle, output = infilling.rearrange(text.encode(), key)
    assert (n, form, prefix, middle, output.decode()) == planned(text, key)
    assert infilling.restore(output, form) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.binary(), st.integers(0, 300), st.integers(0, 300))
def test_rotation(data, i, j):
    i, j = sorted((min(i, len(data)), min(j, len(data))))
    buffer = bytearray(data)
    infilling.rotate(buffer, i, j, len(data))
    assert bytes(buffer) == data[:i] + data[j:] + data[i:j]


def test_long_blocks_rotate_in_pieces():
    data = np.random.default_rng(1).bytes(5 * infilling.SWAP_BYTES + 77)
    buffer, cut = bytearray(data), infilling.SWAP_BYTES * 2 + 5
    infilling.rotate(buffer, 3, cut, len(data))
    assert bytes(buffer) == data[:3] + data[cut:] + data[3:cut]


def test_malformed_outputs_restore_to_null():
    assert infilling.restore(b"<P>a<M>b", "psm") is None
    assert infilling.restore(b"a", "spm") is None
    assert infilling.restore(b"a", "other") is None


def test_infilling_of_awkward_rows(docs_of):
    rows = [*AWKWARD, (8, "a <S> b"), (9, "word " * 60_000)]
    docs = wide(docs_of(rows))
    found = infilling.fill_in_middle(docs)
    assert found.columns == [c for c in docs.columns if c not in ("text", "infilling")] + ["infilling"]
    got = sorted((r["doc_id"] or 0, *r["infilling"]) for r in found.collect())
    expected = sorted((r[0] or 0, *planned(r[1] or "", r[0])) for r in rows)
    assert got == expected
    flat = found.select("doc_id", "infilling.output", "infilling.form", F.lit("x").alias("restored"))
    back = infilling.restore_texts(flat, "output", "form").collect()
    assert sorted((r["doc_id"] or 0, r["restored"]["text"]) for r in back) == sorted((r[0] or 0, r[1] or "") for r in rows)
    assert infilling.fill_in_middle(docs.where("false")).collect() == []


# decontamination


def expected_overlap(text, items, width=10):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    hit, names = set(), set()
    for name, item in items:
        theirs = WORD.findall((item or "").translate({c: c + 32 for c in range(65, 91)}))
        size = min(width, len(theirs))
        for i in range(len(theirs) - size + 1 if size else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == theirs[i : i + size]:
                    hit.update(range(at, at + size))
                    names.add(name or "")
    return len(words), hit, sorted(names)


def covered(spans):
    assert all(a[1] < b[0] for a, b in itertools.pairwise(spans))  # merged and in order
    return {i for begin, end in spans for i in range(begin, end)}


WORDS = st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=5), st.lists(WORDS, max_size=4), st.integers(1, 5))
def test_index_finds_every_place(texts, items, width):
    phrases = decontaminate.phrases_of([(str(i), b" ".join(w)) for i, w in enumerate(items)], width)
    found = decontaminate.occurrences(texts, phrases)
    named = [(str(i), b" ".join(w).decode()) for i, w in enumerate(items)]
    for words, (spans, names) in zip(texts, found, strict=True):
        _, hit, expected = expected_overlap(b" ".join(words).decode(), named, width)
        assert (covered(spans), sorted(names)) == (hit, expected)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=80))
def test_suffix_array(values):
    symbols = np.array([v + 1 for v in values] + [0], np.int64)
    order = decontaminate.suffix_array(symbols)
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())


def test_wavelet_ranks():
    values = np.random.default_rng(2).integers(0, 21, 1000)
    matrix = decontaminate.WaveletMatrix(values, 20)
    at = np.arange(1001)
    for symbol in range(21):
        expected = np.concatenate([[0], np.cumsum(values == symbol)])
        assert (matrix.rank(np.full(1001, symbol), at) == expected).all()
    symbols, earlier = matrix.access(np.arange(1000))
    assert (symbols == values).all()
    assert earlier.tolist() == [int((values[:i] == v).sum()) for i, v in enumerate(values)]


PASSAGE = "The quick Brown fox, jumps over the lazy dog and then runs far away from all of it"
ITEMS = [("q1", PASSAGE), ("q2", "tiny Item"), ("q3", None), ("q4", "..."), ("q1", "other text here"), ("q2", "tiny Item"), (None, "no id here")]
DIRTY = [
    *AWKWARD,
    (10, "Before. " + PASSAGE.upper() + " after"),
    (11, "Before. " + PASSAGE.upper() + " after"),
    (12, "tiny-item; tiny item tinyitem"),
    (13, "no  ID\nhere, other text here"),
    (14, "jumps over the lazy dog and then runs far away jumps over"),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_overlaps_by_brute_force(spark, docs_of, block_bytes):
    benchmark = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = wide(docs_of(DIRTY))
    found = decontaminate.find_overlaps(docs, benchmark, block_bytes=block_bytes).collect()
    assert len(found) == len(DIRTY)
    texts = dict((i, t) for i, t, *_ in DIRTY)
    for r in found:
        n, hit, names = expected_overlap(texts[r["doc_id"]], ITEMS)
        o = r["overlap"]
        assert (o["n_words"], covered(o["spans"]), sorted(o["items"])) == (n, hit, names)
    assert sum(bool(r["overlap"]["spans"]) for r in found) == 5


def test_overlaps_with_empty_tables(spark, docs_of):
    benchmark = spark.createDataFrame([], "item_id string, text string")
    found = decontaminate.find_overlaps(docs_of(DIRTY), benchmark).collect()
    assert len(found) == len(DIRTY) and not any(r["overlap"]["spans"] or r["overlap"]["items"] for r in found)
    assert decontaminate.find_overlaps(docs_of(DIRTY).where("false"), benchmark).collect() == []


def test_spans_are_cut_from_texts(spark, docs_of):
    benchmark = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = docs_of(DIRTY)
    found = decontaminate.find_overlaps(docs.withColumn("copy", F.col("text")), benchmark)
    cleaned = decontaminate.without_spans(found.withColumnRenamed("copy", "text"))
    texts = {r["doc_id"]: r["cleaned"]["text"] for r in cleaned.where("doc_id >= 8").collect()}
    assert texts == {10: "Before.  after", 11: "Before.  after", 12: " tinyitem", 13: "", 14: DIRTY[-1][1].replace("jumps over the lazy dog and then runs far away", "")}


# the filter audit


def audited(docs, labels):
    """Every order applied to every document, one filter after the other."""
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, t in labels if t == 1}
    fails = []
    for i, text, lang in docs:
        text = text or ""
        words = SPACED.findall(text)
        mine = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs),
        }
        fails.append((lang or "", {k for k, v in mine.items() if v}, i in good, i in toxic))
    rows = []
    for part in {f[0] for f in fails}:
        here = [f for f in fails if f[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        mine = []
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, letter in enumerate(order, 1):
                out = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                removed_by[letter] += len(out)
                failing = sum(letter in f[1] for f in here)
                sole = sum(f[1] == {letter} for f in here)
                mine.append((letter, [part, "".join(order), step, len(left), len(out), failing - len(out), sole,
                                      sum(f[2] for f in out), sum(f[3] for f in out)]))
        rows += [tuple(row + [removed_by[letter]]) for letter, row in mine]
    return sorted(rows)


def test_swaps_visit_every_order_once():
    for n in range(6):
        order, seen = list(range(n)), {tuple(range(n))}
        for level in filter_audit.neighbour_swaps(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert len(seen) == len(list(itertools.permutations(range(n))))


COUNTS = st.dictionaries(st.integers(0, 31), st.tuples(*[st.integers(1, 9)] * 3), max_size=32)


@settings(max_examples=60, deadline=None)
@given(COUNTS)
def test_swapped_diagram_is_the_diagram_of_its_order(counts):
    diagram = filter_audit.Diagram(counts, range(5))
    for level in filter_audit.neighbour_swaps(5)[:40]:
        diagram.swap(level)
        fresh = filter_audit.Diagram(counts, diagram.order)
        assert diagram.steps() == fresh.steps()
        assert [diagram.sole(v) for v in range(5)] == [counts.get(1 << v, (0,))[0] for v in range(5)]


LONG = " ".join(f"w{i}" for i in range(120))
AUDITED = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "fr"), (3, LONG, "fr"), (None, LONG, "en"), (None, LONG, None),
    (4, None, "en"), (5, "", ""), (6, "A B # c", None), (7, "a " * 200, "en"), (8, LONG + " $", "fr"),
    (9, LONG.upper(), "en"), (10, LONG.upper(), "en"), (1, LONG, "en"), (11, "é\x0b中 | x", "fr"), (12, "x" * 50_000, "fr"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (9, None, 1), (None, 1, 1), (7, 1, None), (99, 1, 1)]


def test_audit_by_brute_force(spark, docs_of):
    docs = wide(docs_of([(i, t, lang) for i, t, lang in AUDITED]))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("digest", F.lit("x"))
    found = filter_audit.audit_filters(filter_audit.mask_counts(docs, labels)).collect()
    assert sorted(tuple(r) for r in found) == audited(AUDITED, LABELS)


def test_audit_of_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of([(i, t, lang) for i, t, lang in AUDITED])
    assert filter_audit.audit_filters(filter_audit.mask_counts(docs.where("false"), labels)).collect() == []
    found = filter_audit.audit_filters(filter_audit.mask_counts(docs, labels)).collect()
    assert sorted(tuple(r) for r in found) == audited(AUDITED, [])
