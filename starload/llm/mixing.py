"""Mixing sources to target weights.

Each source has a target number of words. As many whole epochs of the source as fit are
taken first; the rest is drawn by Efraimidis-Spirakis sampling: every document gets an
exponential key divided by its quality weight, and in the order of the keys documents are
taken until their words reach the rest. The document at the border is taken when that
brings the sum nearer to the target.

The prefix sums need no sorted pass over a source. Sums of words by key range (a fixed
number for each source) show the range the border lies in, and only that range is summed
key by key. What is kept of a source is one row: epochs and the last key taken. So a
document's number of copies follows from its own row and that of its source, and texts are
never shuffled.

Null and empty texts have no words and are never taken. A null source is a source of its
own, last in order. Rows with one id share one key and are taken or left together. An empty
table gives no rows. Keys depend on the id and the seed only, so reruns agree. Extra columns
pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.llm.common import read_table
from starload.sources.scratch import materialize

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>!"
#: Key ranges of a source; the border range holds about one row in so many.
RANGES = 4096


@dataclass(frozen=True)
class Mix:
    """Weights by rank of the source (repeating), most times a source is used, seed of the keys."""

    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    seed: str = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, words: Column) -> Column:
    """1 for plain prose, towards 0 the more symbols there are for each word."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return (words + 1) / (words + 1 + 10 * F.coalesce(symbols, F.lit(0))).cast("double")


def uniform(identity: Column, seed: str) -> Column:
    """Number strictly between 0 and 1, from 52 bits of a digest of the id."""
    digits = F.substring(F.md5(F.concat(F.coalesce(identity.cast("string"), F.lit("")), F.lit(f"|{seed}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def keyed(docs: DataFrame, mix: Mix, identity: str, text: str, source: str) -> DataFrame:
    """Columns row (all of ``docs``), mix_source, mix_size, mix_key, mix_range."""
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    name = F.coalesce(F.concat(F.lit("s"), F.col(f"row.{source}").cast("string")), F.lit("t"))
    sized = row.select("row", name.alias("mix_source"), word_count(F.col(f"row.{text}")).alias("mix_size"))
    weight = quality_weight(F.col(f"row.{text}"), F.col("mix_size"))
    weighed = sized.withColumn("mix_key", -F.log(uniform(F.col(f"row.{identity}"), mix.seed)) / weight)
    share = F.col("mix_key") / (F.col("mix_key") + 1)
    return weighed.withColumn("mix_range", F.floor(share * RANGES).cast("int"))


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Target of each source from columns mix_source and source_size.

    A source gets ``level * weight`` words up to ``most`` times its size. In the order of
    the level at which they are full, the level of the first source that isn't full is the
    one at which all targets add up to all words.
    """
    place = (F.row_number().over(Window.orderBy("mix_source")) - 1) % len(mix.weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in mix.weights]), (place + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight)
    full_at = mix.most * F.col("source_size") / F.col("weight")
    order = Window.orderBy("full_at", "mix_source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(mix.most * F.col("source_size")).over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    found = (
        weighed.withColumn("full_at", full_at)
        .withColumn("level", level)
        .withColumn("place", F.row_number().over(order))
        .withColumn("open", F.when(F.col("level") <= F.col("full_at"), F.col("place")))
    )
    first_open = F.min(F.when(F.col("open").isNotNull(), F.struct("open", "level"))).over(everything)
    target = F.least(
        (mix.most * F.col("source_size")).cast("double"),
        F.coalesce(first_open["level"], F.max("full_at").over(everything)) * F.col("weight"),
    )
    return found.select("mix_source", "source_size", target.alias("target"))


def plan(keys: DataFrame, mix: Mix) -> DataFrame:
    """One row for each source: source_size, target, epochs, and the last key taken in part."""
    ranges = materialize(
        keys.groupBy("mix_source", "mix_range").agg(F.sum("mix_size").alias("range_size")), "mix_ranges"
    )
    targets = source_targets(ranges.groupBy("mix_source").agg(F.sum("range_size").alias("source_size")), mix)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = targets.withColumn("epochs", epochs.cast("int")).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    running = F.sum("range_size").over(Window.partitionBy("mix_source").orderBy("mix_range"))
    border = (
        ranges.withColumn("until", running)
        .join(sources.select("mix_source", "rest"), "mix_source")
        .where(F.col("until") > F.col("rest"))
        .groupBy("mix_source")
        .agg(
            F.min("mix_range").alias("border"),
            F.min_by(F.col("until") - F.col("range_size"), "mix_range").alias("taken_before"),
            F.first("rest").alias("rest"),
        )
    )
    inside = (
        keys.join(border, "mix_source")
        .where(F.col("mix_range") == F.col("border"))
        .groupBy("mix_source", "mix_key")
        .agg(F.sum("mix_size").alias("size"), F.first("taken_before").alias("taken_before"), F.first("rest").alias("rest"))
    )
    before = F.sum("size").over(Window.partitionBy("mix_source").orderBy("mix_key")) - F.col("size")
    last = (
        inside.withColumn("middle", F.col("taken_before") + before + F.col("size") / 2)
        .where(F.col("middle") <= F.col("rest"))
        .groupBy("mix_source")
        .agg(F.max("mix_key").alias("last_key"))
    )
    return sources.join(border.select("mix_source", "border"), "mix_source", "left").join(last, "mix_source", "left")


def times_taken(keys: DataFrame, planned: DataFrame) -> DataFrame:
    """``keys`` with source_size, target and times (0 to ``most``)."""
    drawn = (F.col("mix_range") < F.col("border")) | (
        (F.col("mix_range") == F.col("border")) & (F.col("mix_key") <= F.col("last_key"))
    )
    times = F.when(F.col("mix_size") > 0, F.col("epochs") + F.coalesce(drawn, F.lit(False)).cast("int")).otherwise(0)
    return keys.join(planned, "mix_source").withColumn("times", times)


def mix_sources(
    docs: DataFrame, mix: Mix = Mix(), identity: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    narrow = materialize(keyed(docs, mix, identity, text, source).drop("row"), "mix_keys")
    planned = materialize(plan(narrow, mix), "mix_plan")
    taken = times_taken(keyed(docs, mix, identity, text, source), planned).where(F.col("times") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = Mix()
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    keys = keyed(docs, mix, "doc_id", "text", "source")
    narrow = materialize(keys.select(F.col("row.doc_id").alias("doc_id"), *keys.columns[1:]), "mix_keys")
    return times_taken(narrow, plan(narrow, mix)).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        "source_size",
        "target",
        (F.col("mix_size") * F.col("times")).alias("taken"),
    )


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, text, COALESCE('s' || source, 't') AS src,
         COALESCE(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
keyed AS (
  SELECT doc_id, src, size,
         -ln((CAST('0x' || substr(md5(COALESCE(doc_id::VARCHAR, '') || '|mix'), 1, 13) AS BIGINT)::DOUBLE + 0.5)
             / 4503599627370496.0::DOUBLE)
         / ((size + 1)::DOUBLE
            / (size + 1 + 10 * COALESCE(length(text) - length(translate(text, '#*$%&|<>!', '')), 0))::DOUBLE) AS k
  FROM sized),
sizes AS (SELECT src, sum(size)::BIGINT AS source_size FROM keyed GROUP BY src),
weighed AS (
  SELECT src, source_size,
         CASE (row_number() OVER (ORDER BY src) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE
              ELSE 1.0::DOUBLE END AS weight
  FROM sizes),
levels AS (
  SELECT src, source_size, weight, 3 * source_size / weight AS full_at,
         row_number() OVER w AS place,
         ((SELECT sum(source_size) FROM sizes)::BIGINT
           - COALESCE(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
         / ((SELECT sum(weight) FROM weighed)
           - COALESCE(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM weighed WINDOW w AS (ORDER BY 3 * source_size / weight, src)),
targets AS (
  SELECT src, source_size,
         least((3 * source_size)::DOUBLE,
               COALESCE((SELECT min_by(level, place) FROM levels WHERE level <= full_at),
                        (SELECT max(full_at) FROM levels)) * weight) AS target
  FROM levels),
sources AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM targets),
groups AS (
  SELECT src, k, sum(size)::BIGINT AS g FROM keyed GROUP BY src, k),
places AS (
  SELECT src, k, sum(g) OVER (PARTITION BY src ORDER BY k) - g + g / 2.0::DOUBLE AS middle FROM groups)
SELECT d.doc_id, d.size, s.source_size, s.target,
       CASE WHEN d.size = 0 THEN 0 ELSE d.size * (s.epochs
         + CASE WHEN p.middle <= greatest(0.0::DOUBLE, s.target - s.epochs * s.source_size) THEN 1 ELSE 0 END)
       END::BIGINT AS taken
FROM keyed d JOIN sources s ON d.src = s.src JOIN places p ON d.src = p.src AND d.k = p.k
"""
