"""Document quality with hierarchical empirical Bayes.

A logistic classifier gives the evidence of a text, for good quality and for toxicity. Its
lexicon and its weights are fitted on a bounded sample of labelled rows. Sums over all
documents of a site and of a section of it (host and path of a page; source and language
here) give posteriors for both: the mean of a site is shrunk toward the global one and the
mean of a section toward its site's, by strengths estimated from how much sites and
sections differ. The prior odds of a document are those of its section without the document
itself, and its own evidence is added. Sums are combined before they are shuffled, and only
one row for each section is joined back.

A null or empty text has no evidence and gets the posterior of its section. Null sites and
sections are sites and sections of their own. Without labels nothing is rejected. Rows that
repeat an id in ``labels`` count once, by their largest toxic and smallest quality value;
null labels teach nothing. Of several texts under one labelled id one is learnt from, the same
in every run. Repeated documents are judged alike; extra columns pass through, and one called
like the result column is replaced.
"""

from __future__ import annotations

import string
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm import quality_rules
from starload.llm.common import read_table, text_bytes, with_text_columns
from starload.sources.scratch import materialize

PUNCTUATION = string.punctuation
FOLD = bytes.maketrans(
    (string.ascii_uppercase + PUNCTUATION).encode(), (string.ascii_lowercase + " " * len(PUNCTUATION)).encode()
)
HEADS = ("good", "toxic")
#: Numbers that describe the shape of a text.
SHAPE = 10

EVIDENCE = T.StructType([T.StructField(h, T.DoubleType()) for h in HEADS])
VECTOR = T.StructType(
    [T.StructField("shape", T.ArrayType(T.DoubleType())), T.StructField("words", T.ArrayType(T.IntegerType()))]
)


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample and the lexicon, and the least evidence that a word needs.

    ``sample`` labelled rows are used, those with the smallest hashes. A word enters the
    lexicon of a head if both the documents that hold it and the contexts (words before it)
    that it has tell the head by a log-likelihood ratio of ``ratio``, and ``share`` of its
    contexts are in such documents. Documents are counted so that one long text is not
    enough, contexts so that many copies of a text weigh no more than one.
    """

    sample: int = 20_000
    candidates: int = 1_000
    lexicon: int = 256
    share: float = 0.6
    ratio: float = 20.0


@dataclass(frozen=True)
class Evidence:
    """Lexicon (word to place), weights of the heads, and the log odds of the labelled sample.

    Weights are those of the shape of a text, of each word of the lexicon, and the constant.
    """

    places: dict[bytes, int] = field(default_factory=dict)
    weights: dict[str, list[float]] = field(default_factory=dict)
    base: dict[str, float] = field(default_factory=dict)


def _vectors(places: dict[bytes, int]):
    """Step that gives the shape of each text, one row each, and the places of its lexicon words."""
    count = quality_rules.feature_step()
    known = frozenset(places)

    def step(texts: pa.Array) -> tuple[np.ndarray, list[list[int]]]:
        c = dict(zip(quality_rules.FEATURES.fieldNames(), (a.to_numpy() for a in count(texts)), strict=True))
        n = np.maximum(1, c["n_words"])
        shape = np.column_stack(
            [
                np.minimum(np.log1p(c["n_words"]), 8) / 8,
                np.minimum(c["n_symbols"] / n, 1),
                c["n_symbol_ends"] / n,
                c["n_stutter"] / n,
                c["n_upper"] / np.maximum(1, c["n_upper"] + c["n_lower"]),
                np.minimum(c["n_bangs"] / n, 1),
                c["top_word"] / n,
                np.minimum(c["word_chars"] / n, 20) / 20,
                c["n_dup_lines"] / np.maximum(1, c["n_lines"]),
                c["n_repeat_words"] / n,
            ]
        )
        found = [known.intersection((t or b"").translate(FOLD).split()) for t in text_bytes(texts)]
        return shape, [sorted(places[w] for w in words) for words in found]

    return step


def word_pairs(docs: DataFrame) -> DataFrame:
    """Rows (label_id, good, toxic, before, word), one for each word of the text."""
    words = F.split(F.trim(F.translate(F.lower("text"), PUNCTUATION + "\n\t\r", " " * (len(PUNCTUATION) + 3))), " +")
    pair = F.transform("words", lambda w, i: F.struct(F.when(i > 0, F.col("words")[i - 1]).alias("before"), w.alias("word")))
    labelled = docs.select("label_id", "good", "toxic", words.alias("words"))
    return labelled.select("label_id", "good", "toxic", F.inline(pair))


def _log_ratio(k: Column, n: Column, rate: Column) -> Column:
    """Log-likelihood ratio of k of n against an overall rate, 0 where k is not above it."""
    p = k / n
    ratio = 2 * (k * F.log(p / rate) + F.when(n > k, (n - k) * F.log((1 - p) / (1 - rate))).otherwise(0.0))
    return F.when((k > 0) & (p > rate), ratio).otherwise(0.0)


def lexicon(labelled: DataFrame, head: str, settings: Settings) -> frozenset[bytes]:
    """Words that mark documents on the unwanted side of ``head``."""
    bad = F.col("toxic") == 1 if head == "toxic" else F.col("good") == 0
    pairs = word_pairs(labelled).where(bad.isNotNull()).select(
        "label_id", "before", "word", bad.cast("double").alias("bad")
    )
    rate = labelled.where(bad.isNotNull()).agg(F.avg(bad.cast("double"))).first()[0]
    if not rate or rate >= 1:
        return frozenset()
    score = _log_ratio(F.col("k"), F.col("n"), F.lit(rate))
    present = pairs.where("word <> ''").select("label_id", "word", "bad").distinct()
    by_word = present.groupBy("word").agg(F.sum("bad").alias("k"), F.count(F.lit(1)).alias("n"))
    near = by_word.where(score >= settings.ratio).orderBy(score.desc(), "word").limit(settings.candidates)
    contexts = pairs.join(F.broadcast(near.select("word")), "word").drop("label_id").distinct()
    chosen = (
        contexts.groupBy("word")
        .agg(F.sum("bad").alias("k"), F.count(F.lit(1)).alias("n"))
        .where((F.col("k") >= settings.share * F.col("n")) & (score >= settings.ratio))
        .orderBy(score.desc(), "word")
        .limit(settings.lexicon)
    )
    return frozenset(r["word"].encode() for r in chosen.collect())


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, rounds: int = 40) -> list[float]:
    """Weights and then the constant of a logistic regression, by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(a.shape[1], penalty)
    ridge[-1] = 0.5
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + ridge * w
        curve = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(ridge)
        change = np.linalg.solve(curve, slope)
        w -= change
        if np.abs(change).max() < 1e-8:
            break
    return [float(v) for v in w]


def fit_evidence(
    docs: DataFrame, labels: DataFrame, identity: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> Evidence:
    """Fit both heads on the labelled sample (columns doc_id, quality, toxic of ``labels``)."""
    known = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.min("quality").alias("good"), F.max("toxic").alias("toxic"))
        .where(F.col("good").isNotNull() | F.col("toxic").isNotNull())
    )
    wanted = docs.select(F.col(identity).alias("label_id")).join(known, "label_id").distinct()
    sample = wanted.orderBy(F.xxhash64("label_id"), "label_id").limit(settings.sample)
    texts = docs.select(F.col(identity).alias("label_id"), F.col(text).cast("string").alias("text"))
    # of several texts under one id the one with the smallest digest, so that reruns agree
    known_texts = texts.join(F.broadcast(sample), "label_id").where(F.col("text").isNotNull())
    one = F.min(F.struct(F.md5("text").alias("digest"), "text")).alias("one")
    labelled = known_texts.groupBy("label_id", "good", "toxic").agg(one)
    labelled = materialize(labelled.select("label_id", "good", "toxic", "one.text"), "labelled_sample")
    words = frozenset().union(*(lexicon(labelled, h, settings) for h in HEADS))
    places = {w: i for i, w in enumerate(sorted(words))}

    def vectors():
        step = _vectors(places)

        def run(texts: pa.Array) -> list[pa.Array]:
            shape, found = step(texts)
            return [pa.array(list(shape), pa.list_(pa.float64())), pa.array(found, pa.list_(pa.int32()))]

        return run

    counted = with_text_columns(labelled, "text", "f", VECTOR, vectors, drop_text=True)
    rows = counted.orderBy("label_id").collect()  # at most the sample
    weights, base = {}, {}
    for head in HEADS:
        known_rows = [r for r in rows if r[head] is not None]
        if known_rows:
            y = np.array([float(r[head] == 1) for r in known_rows])
            x = np.zeros((len(y), SHAPE + len(places)))
            for i, r in enumerate(known_rows):
                x[i, :SHAPE] = r["f"]["shape"]
                x[i, [SHAPE + w for w in r["f"]["words"]]] = 1
            weights[head] = logistic(x, y)
            rate = (y.sum() + 0.5) / (len(y) + 1)
            base[head] = float(np.log(rate / (1 - rate)))
    return Evidence(places, weights, base)


def with_evidence(
    docs: DataFrame, model: Evidence, text: str = "text", name: str = "evidence", drop_text: bool = False
) -> DataFrame:
    """``docs`` with log odds of the two heads, those of the labelled sample taken off; 0 without a text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute():
        m = shared.value
        step = _vectors(m.places)

        def run(texts: pa.Array) -> list[pa.Array]:
            shape, found = step(texts)
            empty = np.array([not t for t in text_bytes(texts)], bool)
            out = []
            for head in HEADS:
                if head in m.weights:
                    w = np.array(m.weights[head])
                    by_words = np.array([w[SHAPE:-1][words].sum() for words in found])
                    out.append(np.where(empty, 0.0, shape @ w[:SHAPE] + by_words + w[-1] - m.base[head]))
                else:
                    out.append(np.zeros(len(shape)))
            return [pa.array(v, pa.float64()) for v in out]

        return run

    return with_text_columns(docs, text, name, EVIDENCE, compute, drop_text)


def _logistic(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def _strength(mean: Column, n: Column, overall: Column) -> Column:
    """Prior rows that a group's mean is worth, from the spread of group means around ``overall``.

    Method of moments: what the means spread beyond chance is the variance of a Beta prior.
    """
    noise = F.sum(overall * (1 - overall))
    weight = F.sum(n)
    spread = (F.sum(n * (mean - overall) * (mean - overall)) - noise) / weight
    typical = F.sum(n * overall * (1 - overall)) / weight
    return F.greatest(F.lit(2.0), F.least(F.lit(10_000.0), typical / F.greatest(spread, F.lit(1e-9)) - 1))


def site_posteriors(judged: DataFrame, model: Evidence, site: Column, section: Column) -> DataFrame:
    """One row for each section: key, number and sums of its documents, shrunk mean of its site, strength."""
    p = {h: _logistic(F.col(f"evidence.{h}") + model.base.get(h, 0.0)) for h in HEADS}
    sections = materialize(
        judged.groupBy(site.alias("site_key"), section.alias("section_key")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(p[h]).alias(f"sum_{h}") for h in HEADS]
        ),
        "section_sums",
    )
    sites = sections.groupBy("site_key").agg(
        F.sum("n").alias("site_n"), *[F.sum(f"sum_{h}").alias(f"site_sum_{h}") for h in HEADS]
    )
    total = sites.agg(
        F.sum("site_n").alias("all_n"), *[(F.sum(f"site_sum_{h}") / F.sum("site_n")).alias(f"all_{h}") for h in HEADS]
    )
    sites = sites.crossJoin(F.broadcast(total))  # one row
    strengths = sites.agg(
        *[_strength(F.col(f"site_sum_{h}") / F.col("site_n"), F.col("site_n"), F.col(f"all_{h}")).alias(f"site_k_{h}") for h in HEADS]
    )
    shrunk = sites.crossJoin(F.broadcast(strengths)).select(
        "site_key",
        *[
            ((F.col(f"site_sum_{h}") + F.col(f"site_k_{h}") * F.col(f"all_{h}")) / (F.col("site_n") + F.col(f"site_k_{h}"))).alias(f"site_{h}")
            for h in HEADS
        ],
    )
    joined = materialize(sections.join(shrunk, "site_key"), "section_sites")
    strengths = joined.agg(
        *[_strength(F.col(f"sum_{h}") / F.col("n"), F.col("n"), F.col(f"site_{h}")).alias(f"k_{h}") for h in HEADS]
    )
    return joined.crossJoin(F.broadcast(strengths))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    site: str = "source",
    section: str = "lang",
    settings: Settings = Settings(),
    drop_text: bool = False,
    name: str = "judged",
) -> DataFrame:
    """``docs`` with the struct ``name``: good and toxic posteriors, those of the section, kept."""
    docs = docs.drop(name)
    model = fit_evidence(docs, labels, identity, text, settings)
    keys = [F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("n")) for c in (site, section)]
    narrow = docs.select(identity, text, site, *[section] * (section != site))
    first = with_evidence(narrow, model, text, drop_text=True)
    if drop_text:
        second = first = materialize(first, "evidence")
        passed = [c for c in (identity, site, *[section] * (section != site))]
    else:
        second, passed = with_evidence(docs, model, text, "__evidence"), docs.columns
        second = second.select(F.struct(*[second[c] for c in passed]).alias("row"), F.col("__evidence").alias("evidence"))
    sections = materialize(site_posteriors(first, model, *keys), "site_posteriors")
    if drop_text:
        second = second.select(F.struct(*passed).alias("row"), "evidence")
    of_row = [F.coalesce(F.concat(F.lit("s"), F.col(f"row.{c}").cast("string")), F.lit("n")) for c in (site, section)]
    rows = second.select("row", "evidence", of_row[0].alias("site_key"), of_row[1].alias("section_key"))
    rows = rows.join(sections, ["site_key", "section_key"])
    posterior, around = {}, {}
    for h in HEADS:
        own = _logistic(F.col(f"evidence.{h}") + model.base.get(h, 0.0))
        k = F.col(f"k_{h}")
        prior = (F.col(f"sum_{h}") - own + k * F.col(f"site_{h}")) / (F.col("n") - 1 + k)
        prior = F.least(F.greatest(prior, F.lit(1e-6)), F.lit(1 - 1e-6))
        around[h] = prior
        posterior[h] = _logistic(F.log(prior / (1 - prior)) + F.col(f"evidence.{h}"))
    good = posterior["good"] if "good" in model.weights else F.lit(1.0)
    toxic = posterior["toxic"] if "toxic" in model.weights else F.lit(0.0)
    return rows.select(
        "row.*",
        F.struct(
            good.alias("good"),
            toxic.alias("toxic"),
            around["good"].alias("section_good"),
            around["toxic"].alias("section_toxic"),
            ((good >= 0.5) & (toxic < 0.5)).alias("kept"),
        ).alias(name),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    return judge(docs, labels, name="__judged").where("__judged.kept").select(*docs.columns)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = judge(docs, read_table(spark, sf_dir, "labels"), drop_text=True)
    return found.select("doc_id", "judged.*")
