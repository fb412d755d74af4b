"""Batch jobs: load one feed, one dimension, the facts, or a whole month."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starload.functions.dates import instant, instant_sql, parse_as_of
from starload.functions.names import quoted
from starload.functions.sizing import BROADCAST_LIMIT_BYTES, fits_auto_broadcast
from starload.operators.backfill import scd2_backfill, snapshot_instant
from starload.operators.facts import with_load_stamp
from starload.operators.lookup import first_seen, lookup
from starload.operators.scd2 import (
    Scd2Spec,
    check_keys,
    drop_duplicate_keys,
    in_key_order,
    scd2_merge,
)
from starload.operators.summarize import merge_summaries, partial_summary
from starload.plans.staging import (
    stage_customer,
    stage_product,
    stage_sales,
    stage_territory,
    type_sales,
)
from starload.schemas import conform, empty_frame, schema_of
from starload.sources.buckets import Buckets, dealt
from starload.sources.csv_checked import RECORD, CsvSplit, read_split
from starload.sources.csv_feed import COMPRESSION, feed_path, read_feed, read_feed_dates, write_slices
from starload.sources.history import publish_history, read_history
from starload.sources.keyfilters import read_filter, renew_filter
from starload.sources.scratch import materialize
from starload.sources.tables import (
    drop_batch,
    read_table,
    replace_batch,
    replace_batches,
    replace_table,
    truncate_table,
)

BATCH = "sample_date"


def dimension_spec(surrogate_key: str, business_key: str, **more) -> Scd2Spec:
    """Spec of the warehouse's dimensions: no version number, ``processed_dttm``."""
    return Scd2Spec(surrogate_key, (business_key,), processed="processed_dttm", version=None, **more)


# Surrogate and business key of each dimension.
DIMENSIONS = {
    "customer": dimension_spec("customer_rk", "CustomerId"),
    "product": dimension_spec("product_rk", "ProductId"),
    "territory": dimension_spec("territory_rk", "TerritoryId"),
}


@dataclass(frozen=True)
class Warehouse:
    """Where raw feeds arrive and where the three layers are kept.

    ``root`` has to be a folder that all executors share.
    """

    spark: SparkSession
    root: str
    raw_root: str
    prefix: str = "snapshot"
    #: how feeds lie below ``raw_root``: ``drops``, or the ``slices`` of ``export_months``
    layout: str = "drops"
    #: whether texts in the feeds hold line breaks
    multi_line: bool = False
    dimensions: Mapping[str, Scd2Spec] = field(default_factory=lambda: DIMENSIONS)
    #: in how many buckets of the business key open rows are stored; a merge then moves no history.
    #: For a large dimension, so many that a bucket fits a task.
    buckets: int | None = None
    #: bits for each key of a filter stored with every dimension; surely new rows of a
    #: snapshot then skip the look at the history. For feeds that bring many new entities.
    filter_bits: int | None = None
    #: what a row of the wrong width does: ``fail`` the load, or be set ``aside`` with its text
    bad_rows: str = "fail"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def table(self, layer: str, name: str) -> DataFrame:
        """Any declared table; facts without their storage partition."""
        if layer == "dwh" and name.endswith("_dim"):
            return self.dimension(name.removesuffix("_dim"))
        if layer == "dwh":
            return self.facts().drop(BATCH)
        return read_table(self.spark, self.path(layer, name), schema_of(layer, name))

    def dimension(self, name: str, open_only: bool = False) -> DataFrame:
        schema, key = schema_of("dwh", f"{name}_dim"), self.dimensions[name].business_key
        return read_history(self.spark, self.path("dwh", f"{name}_dim"), schema, open_only, key)

    def buckets_of(self, name: str) -> Buckets | None:
        return Buckets(self.buckets, self.dimensions[name].business_key) if self.buckets else None

    def facts(self, name: str = "sales") -> DataFrame:
        """Facts with the batch they were loaded by, for partition pruning."""
        schema = StructType([*schema_of("dwh", name).fields, StructField(BATCH, StringType())])
        return read_table(self.spark, self.path("dwh", name), schema)


def _sample_date(as_of: str | date | datetime) -> str:
    return parse_as_of(as_of).strftime("%Y%m%d")


def load_raw(wh: Warehouse, feed: str, as_of: str | date | datetime) -> DataFrame:
    """Replace a raw table by the feed of one sample date.

    Rows set aside go to ``bad/feed`` with their file, block and text, by sample date; a
    repeated load replaces those of the load before. They are counted while the good rows
    are written, and the feed is parsed once more only if there are any.
    """
    day = _sample_date(as_of)
    if wh.bad_rows == "fail":
        raw = read_feed(wh.spark, wh.raw_root, feed, day, wh.prefix, wh.layout, wh.multi_line)
        replace_table(raw, wh.path("ods", feed))
        return wh.table("ods", feed)
    if wh.bad_rows != "aside":
        raise ValueError(f"unknown treatment of bad rows {wh.bad_rows!r}")
    path = feed_path(wh.raw_root, feed, day, wh.prefix, wh.layout)
    split = read_split(wh.spark, path, schema_of("ods", feed), wh.multi_line)
    seen = Observation(f"bad rows of {feed}")
    counted = split.rows.observe(seen, F.count_if(F.col(RECORD).isNotNull()).alias("bad"))
    replace_table(CsvSplit(counted, split.schema).good, wh.path("ods", feed))
    if seen.get["bad"]:
        replace_batch(split.bad, wh.path("bad", feed), BATCH, day)
    else:
        drop_batch(wh.spark, wh.path("bad", feed), BATCH, day)
    return wh.table("ods", feed)


def load_staging(wh: Warehouse, name: str, staged: DataFrame) -> DataFrame:
    replace_table(staged, wh.path("stg", name))
    return wh.table("stg", name)


def load_dimension(
    wh: Warehouse,
    name: str,
    as_of: str | date | datetime,
    processed: Column | None = None,
    duplicates: str = "error",
    ordered: bool = False,
) -> DataFrame:
    """Merge ``stg.name`` into ``dwh.name_dim`` and publish the new content.

    ``duplicates`` says what happens when a snapshot holds a key twice: ``error``,
    ``drop`` (one row per key) or ``keep``. ``ordered`` sorts the stored rows by
    key and start, at the price of a range shuffle; it is for dimensions without buckets. Rows without a business key go
    to ``rejected/name``, all of them; a repeated load replaces those of the load before.

    Only open rows are read and written again, because no other row can be valid at the
    newest date, and every entity has an open row that names its surrogate key. A
    snapshot older than the newest load may cut closed rows too; it merges into the whole
    history and rewrites it. With literal intervals the whole history is looked up.
    """
    spec = wh.dimensions[name]
    source = wh.table("stg", name)
    found = check_keys(source, spec.business_key)
    if duplicates not in ("error", "drop", "keep"):
        raise ValueError(f"unknown treatment of duplicates {duplicates!r}")
    if found.duplicate_keys and duplicates == "error":
        raise ValueError(f"{found.duplicate_keys} keys occur more than once in stg.{name}")
    if found.duplicate_keys and duplicates == "drop":
        source = drop_duplicate_keys(source, spec.business_key)
    target, history = wh.dimension(name, open_only=True), wh.dimension(name)
    at = instant(as_of)
    late = not target.where(F.col(spec.start) > at).isEmpty()
    if late:
        target = history
    elif not spec.literal_intervals:
        history = target
    # of a history in buckets only the snapshot moves; elsewhere a small one is broadcast instead
    limit = 0 if wh.buckets else BROADCAST_LIMIT_BYTES
    key_filter = read_filter(wh.spark, wh.path("keys", name)) if wh.filter_bits else None
    merged = scd2_merge(
        source,
        target,
        spec,
        as_of,
        processed,
        broadcast_limit=limit,
        known=history,
        key_filter=None if spec.literal_intervals else key_filter,
    )
    if wh.filter_bits:
        _renew_filter(wh, name, source, history)
    path, open_end, buckets = wh.path("dwh", f"{name}_dim"), instant_sql(spec.open_end), wh.buckets_of(name)
    full = merged.full_in_buckets(buckets) if buckets else merged.full
    full = in_key_order(full, spec) if ordered else full
    publish_history(full, path, spec.end, open_end, complete=late, buckets=buckets)
    if found.incomplete_rows:
        replace_batch(merged.rejected, wh.path("rejected", name), BATCH, _sample_date(as_of))
    else:
        drop_batch(wh.spark, wh.path("rejected", name), BATCH, _sample_date(as_of))
    return wh.dimension(name)


def _renew_filter(wh: Warehouse, name: str, source: DataFrame, history: DataFrame) -> None:
    """Store a filter with the keys of the snapshot too, before the dimension holds them.

    A filter may hold more keys than the history, never fewer, so a load that fails after
    this leaves a filter that is right.
    """
    key, path = wh.dimensions[name].business_key, wh.path("keys", name)
    complete = F.expr(" AND ".join(f"{quoted(k)} IS NOT NULL" for k in key))
    added = source.where(complete).select(*[F.col(k).cast(history.schema[k].dataType) for k in key])
    entities = history.select(*key).distinct().count() + added.count()
    renew_filter(wh.spark, path, added, history, key, entities, wh.filter_bits)


def together(spark: SparkSession, tasks: Sequence[Callable[[], object]]) -> list:
    """Run independent loads side by side, so that small ones fill idle executors."""
    if not tasks:
        return []
    with ThreadPoolExecutor(min(len(tasks), 8)) as pool:
        run = inheritable_thread_target(spark)(lambda task: task())
        return list(pool.map(run, tasks))


def stage_feed(wh: Warehouse, name: str) -> DataFrame:
    """Typed staging table of a dimension from its raw tables."""
    if name == "product":
        hierarchy = ("product_subcategory", "product_category")
        for level in hierarchy:
            # typed copies of the hierarchy are declared but hold no rows
            truncate_table(wh.spark, wh.path("stg", level), schema_of("stg", level))
        staged = stage_product(*[wh.table("ods", n) for n in (name, *hierarchy)])
    elif name == "customer":
        staged = stage_customer(wh.table("ods", name))
    else:
        staged = stage_territory(wh.table("ods", name))
    return load_staging(wh, name, staged)


# The raw feeds behind each load.
FEEDS = {
    "customer": ("customer",),
    "product": ("product", "product_subcategory", "product_category"),
    "territory": ("territory",),
    "sales": ("sales",),
}


def load_feeds(wh: Warehouse, as_of: str | date | datetime, names: Sequence[str]) -> None:
    feeds = [feed for name in names for feed in FEEDS[name]]
    together(wh.spark, [partial(load_raw, wh, feed, as_of) for feed in feeds])


def _stage_and_merge(wh: Warehouse, name: str, as_of, processed: Column | None) -> DataFrame:
    stage_feed(wh, name)
    return load_dimension(wh, name, as_of, processed)


def load_entity(wh: Warehouse, name: str, as_of, processed: Column | None = None) -> DataFrame:
    """Raw, staging and dimension table of ``customer``, ``product`` or ``territory``."""
    load_feeds(wh, as_of, [name])
    return _stage_and_merge(wh, name, as_of, processed)


def load_facts(wh: Warehouse, as_of, now: Column | None = None) -> DataFrame:
    """Type the raw sales, look up their surrogates and add them to the facts.

    Facts are stored by sample date; loading a month again replaces its rows.
    """
    # each entity has one open row, so the surrogates need no history
    dims = [wh.dimension(name, open_only=True) for name in ("customer", "product", "territory")]
    staged = load_staging(wh, "sales", stage_sales(wh.table("ods", "sales"), *dims))
    replace_batch(with_load_stamp(staged, now), wh.path("dwh", "sales"), BATCH, _sample_date(as_of))
    return wh.table("dwh", "sales")


def load_sales(wh: Warehouse, as_of, now: Column | None = None) -> DataFrame:
    load_feeds(wh, as_of, ["sales"])
    return load_facts(wh, as_of, now)


def run_month(
    wh: Warehouse,
    as_of: str | date | datetime,
    processed: Column | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Load all feeds, then the dimensions, then the facts, which need their keys.

    Neither feeds nor dimensions depend on each other, so their jobs overlap.
    """
    load_feeds(wh, as_of, list(FEEDS))
    together(
        wh.spark,
        [partial(_stage_and_merge, wh, name, as_of, processed) for name in wh.dimensions],
    )
    return load_facts(wh, as_of, now)


def _stage_dates(wh: Warehouse, name: str, dates: Sequence[str]) -> DataFrame:
    """Typed rows of a dimension's feeds of all dates, with their sample date."""
    raw = [
        read_feed_dates(wh.spark, wh.raw_root, feed, dates, wh.prefix, wh.layout, wh.multi_line)
        for feed in FEEDS[name]
    ]
    stage = {"customer": stage_customer, "product": stage_product, "territory": stage_territory}[name]
    return stage(*raw, keep=(BATCH,))


def backfill_dimension(
    wh: Warehouse,
    name: str,
    dates: Sequence[str | date | datetime],
    processed: Column | None = None,
    duplicates: str = "error",
) -> DataFrame:
    """Load the feeds of many dates into ``dwh.name_dim`` at once.

    The content equals that of one load for each date, and one version is published however
    many dates there are. The dimension may hold earlier loads, but none from the first date
    on. Raw and staging tables, which hold the newest feed only, are left as they are.
    Rows without a business key go to ``rejected/name`` by date, replacing those of the dates.
    """
    days = sorted(_sample_date(d) for d in dates)
    spec, path = wh.dimensions[name], wh.path("dwh", f"{name}_dim")
    staged = materialize(_stage_dates(wh, name, days), "staged", "zstd")
    target = wh.dimension(name, open_only=True)
    done = scd2_backfill(staged, target, spec, BATCH, processed, duplicates=duplicates)
    if wh.filter_bits:
        _renew_filter(wh, name, staged, target)
    buckets = wh.buckets_of(name)
    full = dealt(done.full, buckets) if buckets else done.full
    publish_history(full, path, spec.end, instant_sql(spec.open_end), complete=False, buckets=buckets)
    rejected = wh.path("rejected", name)
    for day in days:
        drop_batch(wh.spark, rejected, BATCH, day)
    replace_batches(done.rejected, rejected, BATCH)
    return wh.dimension(name)


def backfill_facts(
    wh: Warehouse, dates: Sequence[str | date | datetime], now: Column | None = None
) -> DataFrame:
    """Type the raw sales of many dates and write all their batches in one job.

    A sale finds an entity that was loaded at its own date or before, as in a load of that
    date alone; entities that only a later snapshot brought are not found.
    """
    days = sorted(_sample_date(d) for d in dates)
    raw = read_feed_dates(wh.spark, wh.raw_root, "sales", days, wh.prefix, wh.layout, wh.multi_line)
    keyed = type_sales(raw, keep=(BATCH,))
    keys = {"customer": "CustomerId", "product": "ProductId", "territory": "TerritoryId"}
    at = snapshot_instant(keyed, BATCH)
    for name, key in keys.items():
        spec = wh.dimensions[name]
        slim = first_seen(wh.dimension(name), key, spec.surrogate_key, spec.start)
        if not fits_auto_broadcast(slim):
            slim = materialize(slim, "keys")
        keyed = lookup(keyed, slim, {key: key}, [spec.surrogate_key, "first_seen"])
        known = F.col("first_seen").isNull() | (F.col("first_seen") <= at)
        found = F.when(known, F.col(spec.surrogate_key)).alias(spec.surrogate_key)
        others = [c for c in keyed.columns if c not in (spec.surrogate_key, "first_seen")]
        keyed = keyed.select(*others, found)
    staged = conform(keyed, StructType([*schema_of("stg", "sales").fields, keyed.schema[BATCH]]))
    for day in days:
        drop_batch(wh.spark, wh.path("dwh", "sales"), BATCH, day)
    replace_batches(with_load_stamp(staged, now), wh.path("dwh", "sales"), BATCH)
    return wh.table("dwh", "sales")


def backfill_months(
    wh: Warehouse,
    dates: Sequence[str | date | datetime],
    processed: Column | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Dimensions and facts of many dates, as ``run_month`` for each of them would leave them."""
    tasks = [partial(backfill_dimension, wh, name, dates, processed) for name in wh.dimensions]
    together(wh.spark, tasks)
    return backfill_facts(wh, dates, now)


def store_report(
    wh: Warehouse, name: str, as_of: str | date | datetime, by: Sequence[str], facts: str = "sales"
) -> None:
    """Aggregate the facts of one batch and keep the result as that batch's part of a report.

    Only the batch is read; loading and storing it again replaces its part.
    """
    day = _sample_date(as_of)
    batch = wh.facts(facts).where(F.col(BATCH) == day).drop(BATCH)
    part = partial_summary(batch, by)
    replace_batch(part, wh.path("reports", name), BATCH, day)


def read_report(wh: Warehouse, name: str, by: Sequence[str], facts: str = "sales") -> DataFrame:
    """The report over all stored batches: as many rows are read as the parts hold, not as the facts do."""
    declared = wh.facts(facts).drop(BATCH)
    schema = partial_summary(empty_frame(wh.spark, declared.schema), by).schema
    # written by batch, so a part has the declared columns without the batch
    parts = read_table(wh.spark, wh.path("reports", name), StructType([*schema.fields, StructField(BATCH, StringType())]))
    return merge_summaries(parts, by)


#: Files that a task of an export keeps open, so that it need not sort its rows by slice; further
#: slices of a task are sorted. Text writers hold little, unlike columnar ones.
OPEN_FILES = 256
_OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def export_months(
    slices: Mapping[str, DataFrame],
    root: str,
    multi_line: bool = False,
    stored: Sequence[str] = (),
    compression: str = COMPRESSION,
) -> None:
    """Write the feeds of all months as compressed CSV, one folder per feed and sample date.

    A ``Warehouse`` with ``layout="slices"`` loads them from there. Feeds named in ``stored`` are
    written from where they are stored without a shuffle, the others gathered by slice.
    """
    if not slices:
        return
    writes = [
        partial(write_slices, df, f"{root}/{feed}", multi_line=multi_line, gather=feed not in stored, compression=compression)
        for feed, df in slices.items()
    ]
    spark = next(iter(slices.values())).sparkSession
    before = spark.conf.get(_OPEN_FILES_SETTING)
    spark.conf.set(_OPEN_FILES_SETTING, OPEN_FILES)
    try:
        together(spark, writes)
    finally:
        spark.conf.set(_OPEN_FILES_SETTING, before)
