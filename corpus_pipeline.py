"""A corpus from raw documents to token counts, in five stages.

Each stage takes all that its predecessor kept and gives rows with the columns of
``documents``; the last gives the token count and digests of each row. Rows without an id
pass through like others. A document that the mix takes several times is a row as often.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import bpe, mixing, near_copies, quality_rules, site_quality
from starload.llm.common import read_table
from starload.sources.scratch import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the voting rules hold to be good."""
    return quality_rules.keep_good(docs.select(*COLUMNS))


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior is good and not toxic, given their source and language."""
    return site_quality.keep_good(docs.select(*COLUMNS), read_table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id; rows without an id come last.

    Rows are told apart by a number frozen in files, not by their ids: several texts under
    one id, and rows without one, are documents like others.
    """
    rows = materialize(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = near_copies.near_copies(rows.select(F.col("row").alias("doc_id"), "text"))
    named = found.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    stay = named.groupBy("component_id").agg(first).select("first.row")
    return rows.join(stay, "row", "left_semi").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix_sources(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count, and digests of ids and decoded text, of each row."""
    return bpe.digests(docs, bpe.word_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_by_rules),
    ("quality_classifier", keep_by_classifier),
    ("near_copies", keep_one_copy),
    ("mixing", mix),
    ("bpe", encode),
]
#: Expectation-maximisation, components and the encoder have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
