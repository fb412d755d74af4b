"""Language identification by compression.

For each language the texts of a bounded sample of labelled rows make a raw-content
dictionary for zstandard. A text belongs to the language whose dictionary makes it
smallest. Where the two smallest are close, all are compressed once more at a higher level
and the sizes added, as a few bytes of one level hardly differ between short texts; where the
margin stays narrow the row is marked as not confident. Texts are compressed whole, as lower-case letters with single spaces, so digits and symbols
carry no weight.

A text that is null or has no letter gives ``und`` with score 0. Labelled rows with a
null language or text teach nothing. Without any labelled row every text is ``und``. Ties
go to the first language by code point. Repeated rows are judged alike; extra columns
pass through, one called like the result column is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import read_table, with_text_columns

UNKNOWN = "und"
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")

PREDICTED = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("confident", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Settings:
    """Bounds of the labelled sample, and what a byte of difference is worth.

    ``texts`` distinct labelled texts are taken for each language, those with the smallest
    hashes, at most ``text_chars`` of each, and ``dictionary_bytes`` of them all make the
    dictionary, to which every text gives an even share, or all of itself if that is less.
    Texts to be identified are never cut. ``margin`` is the least score
    of a confident prediction; ``byte_odds`` turns bytes saved into natural log odds. Sizes
    no more than ``near`` bytes apart are looked at again at ``second_level``.
    """

    texts: int = 200
    text_chars: int = 2_000
    dictionary_bytes: int = 96 << 10
    level: int = 3
    second_level: int = 9
    near: int = 4
    byte_odds: float = 0.5
    margin: float = 0.6


def letters(text: str | None) -> str:
    return NOT_LETTERS.sub(" ", text).strip().lower() if text else ""


def dictionaries(labelled: DataFrame, settings: Settings = Settings()) -> dict[str, bytes]:
    """Raw dictionary content of each language from columns ``text`` and ``lang``.

    Copies count once, so that many copies of one text can't fill a dictionary. Only
    ``texts`` rows for each language reach the driver.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.md5("text").alias("key")
    )
    order = Window.partitionBy("lang").orderBy("key")
    chosen = known.select("lang", "key").distinct().withColumn("n", F.row_number().over(order))
    chosen = F.broadcast(chosen.where(F.col("n") <= settings.texts))
    rows = (
        known.join(chosen, ["lang", "key"])
        .groupBy("lang", "n")
        .agg(F.min(F.substring("text", 1, settings.text_chars)).alias("part"))
        .collect()
    )
    content: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["n"])):
        content.setdefault(r["lang"], []).append(letters(r["part"]))
    joined = {lang: shared_evenly(parts, settings.dictionary_bytes) for lang, parts in content.items()}
    return {lang: data for lang, data in sorted(joined.items()) if len(data) >= 8}


def shared_evenly(parts: list[str], limit: int) -> bytes:
    """At most ``limit`` bytes of texts, as even a share of each as their lengths allow."""
    taken: list[bytes] = []
    for i, part in enumerate(sorted(parts, key=len)):
        share = limit // (len(parts) - i)  # what shorter ones left is for the longer ones
        taken.append(part.encode()[: max(0, share - 1)])
        limit -= len(taken[-1]) + 1
    return b" ".join(taken)


def predictor(shared, settings: Settings):
    """Function that makes the step of a task from a broadcast of the dictionaries."""

    def compute():
        languages = list(shared.value)

        def at_level(level: int) -> list[zstandard.ZstdCompressor]:
            made = []
            for data in shared.value.values():
                content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(level=level)
                made.append(zstandard.ZstdCompressor(dict_data=content, write_content_size=False, write_dict_id=False))
            return made

        compressors, second = at_level(settings.level), at_level(settings.second_level)

        def predict(text: str | None) -> tuple[str, float, bool]:
            body = letters(text).encode()
            if not body or not compressors:
                return UNKNOWN, 0.0, False
            sizes = [len(c.compress(body)) for c in compressors]
            if len(sizes) > 1 and sorted(sizes)[1] - min(sizes) <= settings.near:
                sizes = [s + len(c.compress(body)) for s, c in zip(sizes, second, strict=True)]
            least = min(sizes)
            best = sizes.index(least)
            score = 1 / sum(math.exp(-settings.byte_odds * (s - least)) for s in sizes)
            return languages[best], score, score >= settings.margin

        def step(texts: pa.Array) -> list[pa.Array]:
            rows = [predict(t) for t in texts.to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

        return step

    return compute


def identify(
    docs: DataFrame,
    content: dict[str, bytes],
    settings: Settings = Settings(),
    text: str = "text",
    name: str = "language",
    drop_text: bool = False,
) -> DataFrame:
    """``docs`` with the struct ``name``: lang, score from 0 to 1, confident."""
    shared = docs.sparkSession.sparkContext.broadcast(content)
    return with_text_columns(docs, text, name, PREDICTED, predictor(shared, settings), drop_text)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    content = dictionaries(docs.where(F.coalesce(~held_out, F.lit(False))).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), content, drop_text=True)
    return found.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        "language.score",
        "language.confident",
    )
