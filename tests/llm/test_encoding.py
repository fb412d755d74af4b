"""BPE encoding against the tokenizers library; language identification."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starload.llm import bpe, langid
from starload.llm.common import map_batches, read_table

from .conftest import AWKWARD, SF


@pytest.fixture(scope="module")
def reference():
    found = Tokenizer.from_file(bpe.word_file())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(bpe.load_vocabulary(bpe.word_file()))


def same(own, reference, text):
    ids = reference.encode(text, add_special_tokens=False).ids
    packed = own.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert own.decode(packed) == reference.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(own, reference, text):
    same(own, reference, text)


def test_texts_that_are_hard_to_merge(own, reference):
    random.seed(3)
    alphabet = "etaoins'  <|>.,ABCΣςİéß中\x1c\x85"
    for _ in range(1500):
        same(own, reference, "".join(random.choice(alphabet) for _ in range(random.randint(0, 60))))
    for text in ("a" * 3000, "ab" * 999, "the" * 500, "x<|endoftext|>Y<|startoftext|><|endoftext", "it's WE'LL don't"):
        same(own, reference, text)


def test_query_equals_library_on_all_documents(spark, reference):
    texts = dict(read_table(spark, SF, "documents").select("doc_id", "text").collect())
    rows = bpe.op8_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        decoded = reference.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_words_are_encoded_once(own, reference):
    """A word among others is not encoded again for each stretch of text that holds it."""
    t, met = bpe.Tokenizer(own.pieces.words.encoder.v), []
    make = t.pieces.words.make
    t.pieces.words.make = lambda word: met.append(word) or make(word)
    text = "fooblarg fooblarg, (fooblarg) fooblarg. fooblarg's \"fooblarg\" 7fooblarg7"
    ids = reference.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(t.encode(text), "<u4").tolist() == ids and met.count("fooblarg") == 1


def test_one_python_step_whose_tables_go_with_its_task(spark, docs_of):
    """Ids and decoded text come from one process, which keeps no tokenizer for the steps after it."""
    found = bpe.digests(docs_of(AWKWARD), bpe.word_file())
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert found.count() == len(AWKWARD)
    found.collect()

    def held(batches):
        import gc

        list(batches)
        kinds = ("Tokenizer", "Encoder", "Pieces")
        n = sum(type(o).__name__ in kinds and type(o).__module__ == bpe.__name__ for o in gc.get_objects())
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    assert {r["n"] for r in map_batches(spark.range(8).repartition(8), held, "n long").collect()} == {0}


def test_awkward_rows_and_clashing_columns(spark, docs_of, reference):
    docs = docs_of(AWKWARD).withColumn("encoded", F.lit(1)).withColumn("ids", F.lit("x"))
    found = bpe.encode_texts(docs, bpe.word_file())
    assert set(docs.columns) == set(found.columns)
    for r in found.collect():
        ids = reference.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["encoded"]["ids"], "<u4").tolist() == ids and r["ids"] == "x"
    assert bpe.digests(docs_of([]), bpe.word_file()).count() == 0


def test_languages_of_held_out_documents(spark):
    found = langid.op10_language(spark, "/root/testdata/sf0.01").toPandas()
    truth = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang").toPandas()
    held = found[found.held_out].merge(truth, on="doc_id")
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() >= 0.97
    assert found.score.between(0, 1).all() and len(found) == len(truth)


def test_language_edge_cases(docs_of):
    english = "the house and the garden of the old man were there when we came to see them again"
    german = "das haus und der garten des alten mannes waren da als wir sie wieder besuchen wollten"
    labelled = docs_of([(i, english, "en") for i in range(3)] + [(9, german, "de"), (10, None, "fr"), (11, "abc", None)])
    content = langid.dictionaries(labelled.select("text", "lang"))
    assert sorted(content) == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, english[:40]), (5, german[:40]), (6, english * 2000)]
    docs = docs_of(rows).withColumn("language", F.lit(0))
    found = {r["doc_id"]: r["language"] for r in langid.identify(docs, content).collect()}
    assert [found[i]["lang"] for i in range(1, 7)] == ["und", "und", "und", "en", "de", "en"]
    assert found[1]["score"] == 0 and 0.5 < found[4]["score"] <= 1
    assert langid.identify(docs, {}).where("language.lang <> 'und'").count() == 0
    assert langid.identify(docs_of([]), content).count() == 0
