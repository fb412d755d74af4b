"""Voting rules and the site classifier."""

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from starload.llm import quality_rules, site_quality
from starload.llm.common import read_table

from .conftest import AWKWARD, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """Straight from the definition."""
    words = WORD.findall(text or "")
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_counts_of_all_documents(spark):
    texts = dict(read_table(spark, SF, "documents").select("doc_id", "text").collect())
    rows = quality_rules.op9_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert not (r["base_failed"] and r["kept"])


def test_counts_of_awkward_rows(docs_of):
    rows = [*AWKWARD, (8, "a b c d e f g h " * 3), (9, "x\n\nx\n \nx y"), (10, "é|é \x0b#<>")]
    docs = docs_of(rows).withColumn("rule_features", F.lit(1))
    found = quality_rules.with_features(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        f = r["rule_features"]
        assert (f["n_words"], f["word_chars"], f["n_symbols"], f["n_dup_lines"], f["n_repeat_words"]) == counts(r["text"])


def test_votes_separate_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality_rules.op9_quality_rules(spark, sf).where("NOT base_failed")
    both = judged.join(read_table(spark, sf, "labels"), "doc_id").toPandas()
    good, bad = both[both.quality == 1], both[both.quality == 0]
    assert good.kept.mean() >= 0.99 and bad.kept.mean() <= 0.1


def test_expectation_maximisation_learns_which_rules_are_right():
    rng = np.random.default_rng(1)
    rules = tuple(quality_rules.Rule(n, "false", "false") for n in "abcd")
    good = rng.random(20_000) < 0.85
    right = np.array([0.95, 0.9, 0.9, 0.6])
    agree = rng.random((20_000, 4)) < right
    votes = np.where(rng.random((20_000, 4)) < 0.2, 0, np.where(agree == good[:, None], 1, -1))
    patterns = Counter("".join("-0+"[v + 1] for v in row) for row in votes)
    model = quality_rules.estimate(dict(patterns), rules)
    assert np.abs(np.array(list(model.accuracy.values())) - right).max() < 0.04 and abs(model.prior - 0.85) < 0.03
    assert quality_rules.estimate({}, rules).posterior == {}


def test_pipeline_stage_keeps_columns_and_drops_junk(docs_of):
    prose = " ".join(f"word{i} and so on" for i in range(30))
    junk = " ".join(f"w{i}###" for i in range(80))
    docs = docs_of([(i, f"{prose} {i}") for i in range(40)] + [(99, junk), (98, None), (97, "")])
    kept = corpus_pipeline.keep_by_rules(None, docs, "")
    assert kept.columns == docs.columns and sorted(r[0] for r in kept.select("doc_id").collect()) == list(range(40))
    assert quality_rules.keep_good(docs.limit(0)).count() == 0


def labelled(spark, docs_of, n=400):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(0, 60)}" for _ in range(60)]
        toxic, bad = i % 7 == 0, i % 5 == 1
        if toxic:
            words[int(rng.integers(1, 50))] = "nasty"
        if bad:
            words = [w + "###" for w in words]
        rows.append((i, " ".join(words), "en", f"site{i % 4}"))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, int(toxic)))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_learns_shape_and_words(spark, docs_of):
    docs, labels = labelled(spark, docs_of)
    found = site_quality.judge(docs, labels).collect()
    assert len(found) == 400
    wrong = [r["doc_id"] for r in found if r["judged"]["kept"] == (r["doc_id"] % 7 == 0 or r["doc_id"] % 5 == 1)]
    assert len(wrong) <= 4, wrong


def test_sparse_sections_shrink_to_their_site(spark, docs_of):
    rows = [(i, None, "x" if i else "rare", "s") for i in range(50)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    found = site_quality.judge(docs_of(rows), labels).collect()
    section = {r["lang"]: r["judged"]["section_good"] for r in found}
    assert abs(section["rare"] - section["x"]) < 0.05


def test_classifier_edge_cases(spark, docs_of):
    docs = docs_of(AWKWARD).withColumn("judged", F.lit(1)).withColumn("evidence", F.lit(2))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert site_quality.judge(docs, none).where("judged.kept").count() == len(AWKWARD)
    odd = spark.createDataFrame([(4, 1, None), (4, 0, 0), (None, 1, 1), (6, None, None), (5, 1, 0)], none.schema)
    assert site_quality.judge(docs, odd).count() == len(AWKWARD)
    assert site_quality.keep_good(docs_of([]), odd).count() == 0


def test_classifier_query_on_labels(spark):
    sf = "/root/testdata/sf0.01"
    both = site_quality.op4_quality_classifier(spark, sf).join(
        read_table(spark, sf, "labels").withColumnRenamed("toxic", "is_toxic"), "doc_id"
    ).toPandas()
    clean = both[(both.quality == 1) & (both.is_toxic == 0)]
    assert clean.kept.mean() >= 0.98 and both[both.is_toxic == 1].kept.mean() <= 0.2
