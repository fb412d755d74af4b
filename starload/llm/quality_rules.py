"""Quality rules under weak supervision.

Rules vote accept, reject or abstain. Expectation-maximisation over the counts of vote
patterns estimates how often each rule is right, without labels; the posterior that a
document is good replaces the demand that it pass every rule. A text
goes through Python once in its own task; only counts of patterns (at most 3 to the
number of rules) reach the driver.

Nulls and empty texts have no words, fail the base rule and are not kept. An empty table
gives no rows. Repeated rows are judged alike. Extra columns pass through; one called like
the result column is replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import WordHashes, read_table, text_bytes, window_hashes, with_text_columns
from starload.sources.scratch import materialize

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
WINDOW = 8

FEATURES = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_lower", "n_bangs", "top_word", "n_symbol_ends", "n_stutter", "n_distinct",
        )
    ]
)


@dataclass(frozen=True)
class Rule:
    """Votes reject where ``bad`` holds, accept where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


#: Percentages in whole numbers; ``f`` is the struct of features. Each kind of junk is named by
#: two rules or more, because a single vote against a document rarely outweighs the rest.
RULES = (
    Rule("length", "f.n_words < 20", "false"),
    Rule("word_length", "f.n_words > 0 AND (f.word_chars < 2 * f.n_words OR f.word_chars > 12 * f.n_words)", "false"),
    Rule("symbols", "100 * f.n_symbols > 15 * f.n_words", "false"),
    Rule("symbol_ends", "100 * f.n_symbol_ends > 20 * f.n_words", "false"),
    Rule("repeated_lines", "f.n_lines > 1 AND 100 * f.n_dup_lines > 30 * f.n_lines", "false"),
    Rule("repeated_words", "100 * f.n_repeat_words > 20 * f.n_words", "false"),
    Rule("stutter", "100 * f.n_stutter > 25 * f.n_words", "false"),
    Rule("variety", "f.n_words BETWEEN 20 AND 500 AND 100 * f.n_distinct < 30 * f.n_words", "false"),
    Rule("capitals", "100 * f.n_upper > 40 * (f.n_upper + f.n_lower)", "false"),
    Rule("exclamations", "100 * f.n_bangs > 20 * f.n_words", "false"),
    Rule("top_word", "f.n_words >= 20 AND 100 * f.top_word > 25 * f.n_words", "false"),
    Rule("prose", "false",
         "f.n_words >= 20 AND 100 * f.n_symbols <= 10 * f.n_words AND 100 * f.n_stutter <= 10 * f.n_words"
         " AND 100 * f.n_upper <= 30 * (f.n_upper + f.n_lower) AND 100 * f.top_word <= 20 * f.n_words"),
)
BASE_FAILED = "f.n_words < 20 OR 100 * f.n_repeat_words > 30 * f.n_words"


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    windows = window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    found = np.flatnonzero(np.isin(windows, twice))
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def feature_step():
    hashes = WordHashes()

    def row(text: bytes | None) -> tuple[int, ...]:
        if not text:
            return (0,) * len(FEATURES)
        words = text.split()
        dup, lines, seen = 0, 0, set()
        for line in text.split(b"\n"):
            if line.strip():
                lines += 1
                if line in seen:
                    dup += 1
                else:
                    seen.add(line)
        size, times = len(text), Counter(words)
        return (
            len(words),
            size - len(text.translate(None, SPACE)),
            size - len(text.translate(None, SYMBOLS)),
            dup,
            repeated_words(hashes.array(words)),
            lines,
            size - len(text.translate(None, UPPER)),
            size - len(text.translate(None, LOWER)),
            text.count(b"!"),
            max(times.values(), default=0),
            sum(w[-1] in SYMBOLS for w in words),
            sum(map(eq, words, islice(words, 1, None))),
            len(times),
        )

    def step(texts: pa.Array) -> list[pa.Array]:
        rows = [row(t) for t in text_bytes(texts)]
        columns = np.array(rows, np.int64).reshape(-1, len(FEATURES)).T
        chars = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
        columns[1] = chars - columns[1]
        return [pa.array(c, pa.int64()) for c in columns]

    return step


def with_features(
    df: DataFrame, text: str = "text", name: str = "rule_features", drop_text: bool = False
) -> DataFrame:
    """``df`` and a struct of counts over each whole text."""
    return with_text_columns(df, text, name, FEATURES, feature_step, drop_text)


def vote_pattern(features: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """One letter for each rule: ``-`` reject, ``+`` accept, ``0`` abstain."""
    letters = [
        F.when(F.expr(r.bad.replace("f.", f"`{features}`.")), "-")
        .when(F.expr(r.good.replace("f.", f"`{features}`.")), "+")
        .otherwise("0")
        for r in rules
    ]
    return F.concat(*letters)


@dataclass(frozen=True)
class RuleModel:
    """Share of good documents, accuracy of each rule, posterior of each vote pattern seen."""

    prior: float
    accuracy: dict[str, float]
    posterior: dict[str, float] = field(repr=False)


#: Anchors of the two classes. Good documents are held to be this share of a table before any
#: vote, and never less than the least share; a vote is first held to be four times as
#: likely in the class it speaks for, and never held to speak against it, nor for it by more than
#: the largest ratio.
GOOD_SHARE, LEAST_SHARE, MOST_SHARE = 0.85, 0.6, 0.99
FIRST_RATIO, MOST_RATIO = 4.0, 99.0


def _anchor(rate: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """First rates of a vote in the class it speaks for, of this ``share``, and in the other.

    Their mean is the rate seen. A vote that is cast more often than its class can account
    for is cast on the other class too, so it says little.
    """
    own = np.minimum(0.99, FIRST_RATIO * rate / (FIRST_RATIO * share + 1 - share))
    return own, np.clip((rate - share * own) / (1 - share), 1e-3, 1.0)


def estimate(counts: dict[str, int], rules: tuple[Rule, ...] = RULES, rounds: int = 50) -> RuleModel:
    """Expectation-maximisation over vote patterns.

    Each rule has a rate of accepting and of rejecting votes in either class; an abstention
    says nothing. The first rates count as a hundredth of the rows. A rule that rejects most
    rows of a table speaks about most good ones too, so its vote loses weight, and the
    classes can't change places: good documents stay the larger class, and no vote comes to
    mean its opposite. A row without votes has the share of good documents as its posterior.
    """
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    votes = np.array([["-0+".index(c) - 1 for c in p] for p in patterns], float).reshape(-1, len(rules))
    accepts, rejects = (votes > 0).astype(float), (votes < 0).astype(float)
    total = max(1.0, n.sum())
    weight = total / 100
    first_accept = _anchor(n @ accepts / total, GOOD_SHARE)
    first_reject = _anchor(n @ rejects / total, 1 - GOOD_SHARE)
    accept, reject = first_accept, first_reject
    prior, good = GOOD_SHARE, np.zeros(len(patterns))
    for _ in range(rounds):
        for_good = np.log(np.clip(accept[0] / accept[1], 1, MOST_RATIO))
        for_bad = np.log(np.clip(reject[0] / reject[1], 1, MOST_RATIO))
        odds = np.log(prior) - np.log1p(-prior) + accepts @ for_good - rejects @ for_bad
        good = 1 / (1 + np.exp(-odds))
        is_good, is_bad = n @ good, n @ (1 - good)
        in_good, in_bad = n * good, n * (1 - good)
        accept = (
            (in_good @ accepts + weight * first_accept[0]) / (is_good + weight),
            (in_bad @ accepts + weight * first_accept[1]) / (is_bad + weight),
        )
        reject = (
            (in_bad @ rejects + weight * first_reject[0]) / (is_bad + weight),
            (in_good @ rejects + weight * first_reject[1]) / (is_good + weight),
        )
        prior = float(np.clip((is_good + GOOD_SHARE * weight) / (total + weight), LEAST_SHARE, MOST_SHARE))
    right = (n * good) @ accepts + (n * (1 - good)) @ rejects
    cast = n @ (accepts + rejects)
    accuracy = np.where(cast > 0, right / np.maximum(cast, 1), 0.0)
    return RuleModel(
        prior,
        {r.name: float(a) for r, a in zip(rules, accuracy, strict=True)},
        dict(zip(patterns, map(float, good), strict=True)),
    )


def fit(features: DataFrame, name: str = "rule_features", rules: tuple[Rule, ...] = RULES) -> RuleModel:
    """Estimate from the vote patterns of all rows."""
    counts = features.groupBy(vote_pattern(name, rules).alias("pattern")).count()
    return estimate({r["pattern"]: r["count"] for r in counts.collect()}, rules)


def verdicts(features: DataFrame, model: RuleModel, name: str = "rule_features", least: float = 0.5) -> DataFrame:
    """``features`` with the struct ``rule_verdict``: posterior, base_failed, kept."""
    table = F.create_map(*[F.lit(x) for pair in model.posterior.items() for x in pair]) if model.posterior else None
    posterior = table[vote_pattern(name)] if table is not None else F.lit(None).cast("double")
    failed = F.expr(BASE_FAILED.replace("f.", f"`{name}`."))
    kept = ~failed & (F.coalesce(posterior, F.lit(0.0)) >= least)
    return features.withColumn(
        "rule_verdict", F.struct(posterior.alias("posterior"), failed.alias("base_failed"), kept.alias("kept"))
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns only."""
    own = {c: f"__own_{c}" for c in docs.columns if c in ("rule_features", "rule_verdict")}
    # each text goes through Python once; estimating reads the counts, not the texts
    features = materialize(with_features(docs.withColumnsRenamed(own), text), "rule_features")
    kept = verdicts(features, fit(features.select("rule_features"))).where("rule_verdict.kept")
    return kept.select([F.col(own.get(c, c)).alias(c) for c in docs.columns])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    features = materialize(with_features(docs, drop_text=True), "rule_features")
    judged = verdicts(features, fit(features))
    return judged.select(
        "doc_id",
        *[f"rule_features.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        "rule_verdict.base_failed",
        "rule_verdict.kept",
        "rule_verdict.posterior",
    )
