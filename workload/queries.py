"""One Spark query per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import US_DATE_FORMAT, instant, us_date, us_date_from_parts
from starload.functions.fingerprint import row_hash
from starload.functions.keyfilter import FilterShape, build_filter
from starload.operators.backfill import scd2_backfill
from starload.operators.facts import with_load_stamp
from starload.operators.fingerprinted import scd2_merge_fingerprinted, with_fingerprint
from starload.operators.keys import assign_surrogate_keys, max_key
from starload.operators.lookup import lookup, one_row_per_key
from starload.operators.scd2 import (
    KeyFilter,
    Scd2Result,
    Scd2Spec,
    changed_rows,
    in_key_order,
    new_rows,
    scd2_merge,
    unchanged_rows,
)
from starload.operators.slicing import SAMPLE_DATE, STORED, sample_dates, slice_all_months, slice_by_month, slice_month
from starload.operators.standardize import retype
from starload.operators.summarize import auto_summarize
from starload.plans.jobs import (
    DIMENSIONS,
    Warehouse,
    backfill_dimension,
    backfill_months,
    export_months,
    load_dimension,
    load_entity,
    load_staging,
    read_report,
    run_month,
    store_report,
    together,
)
from starload.plans.staging import stage_customer, stage_product, stage_sales, stage_territory
from starload.schemas import columns, empty_frame, empty_table, schema_of
from starload.sources.buckets import Buckets, dealt, read_buckets, write_buckets
from starload.sources.clustered import read_by_month, slices_of, store_by_month, write_clustered
from starload.sources.csv_checked import read_split, read_versions
from starload.sources.csv_feed import (
    FEED_STEMS,
    feed_path,
    read_csv,
    read_slices,
    write_csv,
    write_feed,
    write_slices,
)
from starload.sources.scratch import materialize, scratch_path
from starload.sources.tables import (
    append_table,
    map_columns,
    publish,
    read_current,
    read_table,
    replace_batch,
    replace_table,
    truncate_table,
)
from workload.inputs import (
    ALL,
    CUTS,
    PERIODS,
    REST,
    Tables,
    customer_snapshot,
    raw_feed,
    in_period,
    in_period_of,
    money,
    monthly_customer_snapshots,
    pair_snapshot,
    raw_category,
    raw_customer,
    raw_product,
    raw_sales,
    raw_subcategory,
    raw_territory,
    stamp,
    store_lines,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_VALIDITY = (
    "valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz, process_dttm timestamp_ntz"
)
_CUSTOMER = columns(
    "customer_rk integer, CustomerId integer, customer_nm string, segment_nm string, nation_no integer, "
    f"priority_cd string, {_VALIDITY}"
)
_VERSIONED = columns(
    "customer_rk integer, CustomerId integer, customer_nm string, segment_nm string, nation_no integer, "
    f"priority_cd string, {_VALIDITY}, version_no integer"
)
_PAIR = columns(
    f"pair_rk integer, ProductId integer, SupplierId integer, flag_cd string, quantity_no decimal(18,0), {_VALIDITY}"
)
SINGLE_MONTH = "19970401"
PLAIN = Scd2Spec("customer_rk", ("CustomerId",), version=None)
VERSIONED = Scd2Spec("customer_rk", ("CustomerId",))
LITERAL = Scd2Spec("customer_rk", ("CustomerId",), version=None, literal_intervals=True)
PAIR = Scd2Spec("pair_rk", ("ProductId", "SupplierId"), version=None)


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def _snapshot(t: Tables, period: int) -> DataFrame:
    """Snapshot of a period as a stored staging table, which a merge reads twice."""
    _, lo, hi = CUTS[period]
    return materialize(customer_snapshot(t, lo, hi), "snapshot")


def _merge(source: DataFrame, target: DataFrame, spec: Scd2Spec, period: int) -> Scd2Result:
    return scd2_merge(source, target, spec, CUTS[period][0], stamp())


def _history(t: Tables, periods: tuple[int, ...], spec: Scd2Spec = PLAIN) -> DataFrame:
    """Stored customer history after loading some periods' snapshots in this order."""
    target = empty_frame(t.spark, _VERSIONED if spec.version else _CUSTOMER)
    for period in periods:
        target = materialize(_merge(_snapshot(t, period), target, spec, period).full, "dim")
    return target


# scans, sources, sinks


@query
def csv_raw_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customers.csv")
    write_csv(raw_customer(t), path)
    return read_csv(t.spark, path, schema_of("ods", "customer"))


@query
def csv_raw_scan_sales(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sales.csv")
    write_csv(raw_sales(t), path)
    return read_csv(t.spark, path, schema_of("ods", "sales"))


@query
def replace_sink(t: Tables) -> DataFrame:
    """A dimension replaced by a result that reads the same dimension."""
    path = scratch_path(t.spark, "customer_dim")
    publish(_history(t, (0,)), path)
    publish(_merge(_snapshot(t, REST), read_current(t.spark, path, _CUSTOMER), PLAIN, REST).full, path)
    return read_current(t.spark, path, _CUSTOMER)


@query
def dest_column_mapping(t: Tables) -> DataFrame:
    """Replace a table through ``source: destination`` pairs; the rest is dropped."""
    mapping = {"SalesTerritoryKey": "TerritoryId", "Continent": "Continent", "Country": "Country", "Region": "Region"}
    typed = retype(raw_territory(t).withColumn("unmapped", F.lit("x")), {"SalesTerritoryKey": "bigint"})
    path = scratch_path(t.spark, "territory")
    replace_table(map_columns(typed, mapping, schema_of("stg", "territory")), path)
    return read_table(t.spark, path, schema_of("stg", "territory"))


@query
def truncate_reload(t: Tables) -> DataFrame:
    """Two loads with a truncation in between leave one copy."""
    path = scratch_path(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    replace_table(rows, path)
    truncate_table(t.spark, path, rows.schema)
    append_table(rows, path)
    return read_table(t.spark, path, rows.schema)


@query
def fact_append_stamped(t: Tables) -> DataFrame:
    """Shipped lines appended batch by batch, each with its load stamp."""
    path = scratch_path(t.spark, "facts")
    for name, lo, hi in PERIODS:
        batch = t.lineitem.where(in_period("l_shipdate", lo, hi)).select(
            F.col("l_orderkey").alias("OrderId"),
            F.col("l_partkey").alias("ProductId"),
            F.col("l_quantity").cast("decimal(18,0)").alias("OrderQuantity"),
        )
        append_table(with_load_stamp(batch, instant(name)), path)
    return read_table(t.spark, path)


@query
def fact_reload_batch(t: Tables) -> DataFrame:
    """Every batch loaded twice: the guarded append leaves one copy."""
    path = scratch_path(t.spark, "facts")
    for _ in range(2):
        for name, lo, hi in PERIODS:
            batch = t.orders.where(in_period("o_orderdate", lo, hi)).select("o_orderkey", "o_custkey")
            replace_batch(with_load_stamp(batch, stamp()), path, "sample_date", name)
    schema = columns(
        "o_orderkey long, o_custkey long, processed_dttm timestamp_ntz, sample_date string"
    )
    return read_table(t.spark, path, schema)


# projections and types


@query
def type_standardize(t: Tables) -> DataFrame:
    return stage_customer(raw_customer(t))


@query
def type_standardize_territory(t: Tables) -> DataFrame:
    return stage_territory(raw_territory(t))


@query
def locale_date_parse(t: Tables) -> DataFrame:
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", US_DATE_FORMAT).alias("text"))
    return text.select(
        "o_orderkey",
        us_date(F.col("text")).alias("order_dt"),
        us_date_from_parts(F.col("text")).alias("parts_dt"),
    )


@query
def money_to_decimal0(t: Tables) -> DataFrame:
    text = t.part.selectExpr("p_partkey", f"{money('p_retailprice')} AS price")
    typed = retype(text, {"price": "double"})
    return typed.select("p_partkey", F.col("price").cast("decimal(18,0)").alias("price"))


@query
def row_fingerprint(t: Tables) -> DataFrame:
    tracked = ["c_custkey", "c_name", "c_nationkey", "segment"]
    rows = t.customer.withColumn("segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return rows.select(
        "c_custkey",
        row_hash(tracked).alias("hash_value"),
        row_hash(tracked, safe=True).alias("safe_hash_value"),
    )


# lookups


@query
def snowflake_flatten(t: Tables) -> DataFrame:
    return stage_product(raw_product(t), raw_subcategory(t), raw_category(t))


@query
def dim_lookup_dedup(t: Tables) -> DataFrame:
    return one_row_per_key(_history(t, (0, REST)), "CustomerId", "customer_rk")


def _first_dimension(t: Tables, name: str, lo: str | None, hi: str | None) -> DataFrame:
    """Stored dimension after one load with the entities of a period."""
    staged = {
        "customer": lambda: stage_customer(raw_customer(t, lo, hi)),
        "product": lambda: stage_product(raw_product(t, lo, hi), raw_subcategory(t), raw_category(t)),
        "territory": lambda: stage_territory(raw_territory(t)),
    }[name]()
    staged = materialize(staged, "stg")
    empty = empty_table(t.spark, "dwh", f"{name}_dim")
    return materialize(scd2_merge(staged, empty, DIMENSIONS[name], PERIODS[0][0], stamp()).full, "dim")


def _first_dimensions(t: Tables, lo: str | None, hi: str | None) -> list[DataFrame]:
    names = ("customer", "product", "territory")
    return together(t.spark, [partial(_first_dimension, t, name, lo, hi) for name in names])


@query
def fact_key_lookup(t: Tables) -> DataFrame:
    """Sales of all time against dimensions of the first period: some find no key."""
    _, lo, hi = PERIODS[0]
    dims = _first_dimensions(t, lo, hi)
    return stage_sales(raw_sales(t), *dims)


@query
def lookup_null_keys(t: Tables) -> DataFrame:
    """Orders of unknown customers against customers one of which has no key, by both equalities."""
    key = "CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS custkey"
    orders = t.orders.selectExpr("o_orderkey", key)
    none = t.spark.range(1).selectExpr("CAST(NULL AS BIGINT) AS c_custkey", "'nobody' AS c_name")
    known = t.customer.select("c_custkey", "c_name").unionByName(none)
    plain = lookup(orders, known, {"custkey": "c_custkey"}, {"c_name": "plain_nm"})
    return lookup(plain, known, {"custkey": "c_custkey"}, {"c_name": "safe_nm"}, null_safe=True)


@query
def snowflake_null_safe(t: Tables) -> DataFrame:
    """Products without a subcategory find the subcategory that has no key."""
    key = F.when(~F.col("ProductSubcategoryKey").startswith("1"), F.col("ProductSubcategoryKey"))
    first = F.lit("1").alias("ProductCategoryKey")
    unkeyed = t.spark.range(1).select(
        F.lit(None).cast("string").alias("ProductSubcategoryKey"), F.lit("Unsorted").alias("SubcategoryName"), first
    )
    raw = raw_product(t).withColumn("ProductSubcategoryKey", key)
    return stage_product(raw, raw_subcategory(t).unionByName(unkeyed), raw_category(t), null_safe=True)


# surrogate keys


@query
def max_key_seed(t: Tables) -> DataFrame:
    used = max_key(_history(t, (0, REST)), "customer_rk")
    unused = max_key(empty_frame(t.spark, _CUSTOMER), "customer_rk")
    return used.withColumn("dimension", F.lit("customer")).unionByName(
        unused.withColumn("dimension", F.lit("empty"))
    )


@query
def surrogate_key_assign(t: Tables) -> DataFrame:
    """Dense keys for part-supplier pairs, numbered within range partitions."""
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    seed = max_key(t.part, "p_partkey").scalar()
    return assign_surrogate_keys(pairs, ["l_partkey", "l_suppkey"], "pair_rk", seed, "range")


@query
def surrogate_key_assign_auto(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    return assign_surrogate_keys(orders, ["o_custkey", "o_orderkey"], "order_rk")


# slowly changing dimensions


@query
def scd2_new_keys(t: Tables) -> DataFrame:
    return new_rows(_snapshot(t, REST), _history(t, (0,)), PLAIN)


@query
def scd2_unchanged(t: Tables) -> DataFrame:
    return unchanged_rows(_snapshot(t, REST), _history(t, (0,)), PLAIN, CUTS[REST][0])


@query
def scd2_changed(t: Tables) -> DataFrame:
    return changed_rows(_snapshot(t, REST), _history(t, (0,)), PLAIN, CUTS[REST][0])


@query
def scd2_full(t: Tables) -> DataFrame:
    return in_key_order(_merge(_snapshot(t, REST), _history(t, (0,)), PLAIN, REST).full, PLAIN)


@query
def scd2_insert(t: Tables) -> DataFrame:
    return _merge(_snapshot(t, REST), _history(t, (0,)), PLAIN, REST).insert


@query
def scd2_close(t: Tables) -> DataFrame:
    return _merge(_snapshot(t, REST), _history(t, (0,)), PLAIN, REST).close


@query
def scd2_corrected(t: Tables) -> DataFrame:
    return _merge(_snapshot(t, 2), _history(t, (0, 1)), PLAIN, 1).corrected


@query
def scd2_safe_fingerprint(t: Tables) -> DataFrame:
    """A value that moved to the next column is a change only for the safe fingerprint."""
    before = t.customer.selectExpr("CAST(c_custkey AS INT) AS CustomerId", "c_mktsegment AS one_tx", "CAST(NULL AS STRING) AS two_tx")
    after = materialize(before.selectExpr("CustomerId", "two_tx AS one_tx", "one_tx AS two_tx"), "snapshot")
    schema = columns(f"customer_rk integer, CustomerId integer, one_tx string, two_tx string, {_VALIDITY}")
    first = scd2_merge(materialize(before, "snapshot"), empty_frame(t.spark, schema), PLAIN, CUTS[0][0], stamp())
    dim = materialize(first.full, "dim")
    found = [
        _merge(after, dim, spec, REST).full.withColumn("safe", F.lit(spec.safe_fingerprint))
        for spec in (PLAIN, replace(PLAIN, safe_fingerprint=True))
    ]
    return found[0].unionByName(found[1])


@query
def default_stamps(t: Tables) -> DataFrame:
    """Stamps that nobody names: midnight of the run day for a merge, the time of the load for facts."""
    inserted = scd2_merge(_snapshot(t, ALL), empty_frame(t.spark, _CUSTOMER), PLAIN, CUTS[ALL][0]).insert
    path = scratch_path(t.spark, "facts")
    append_table(with_load_stamp(t.orders.select("o_orderkey")), path)
    now, day = F.localtimestamp(), F.date_trunc("day", F.localtimestamp()).cast("timestamp_ntz")
    merged = inserted.agg(
        F.lit("merge").alias("load"),
        F.count("*").alias("n"),
        F.bool_and(F.col("process_dttm").between(day - F.expr("INTERVAL 1 DAY"), day)).alias("recent"),
        F.bool_and(F.col("process_dttm") == F.date_trunc("day", "process_dttm").cast("timestamp_ntz")).alias("midnight"),
    )
    facts = read_table(t.spark, path).agg(
        F.lit("facts").alias("load"),
        F.count("*").alias("n"),
        F.bool_and(F.col("processed_dttm").between(now - F.expr("INTERVAL 1 DAY"), now)).alias("recent"),
        (F.count_distinct("processed_dttm") > 1).alias("midnight"),
    )
    return merged.unionByName(facts)


@query
def scd2_first_load(t: Tables) -> DataFrame:
    return _history(t, (ALL,))


@query
def scd2_versioned(t: Tables) -> DataFrame:
    return _history(t, (0, REST), VERSIONED)


@query
def scd2_second_month(t: Tables) -> DataFrame:
    return _history(t, (0, 1, 2), VERSIONED)


@query
def scd2_composite_key(t: Tables) -> DataFrame:
    target = empty_frame(t.spark, _PAIR)
    for name, lo, hi in (CUTS[0], CUTS[REST]):
        snapshot = materialize(pair_snapshot(t, lo, hi), "snapshot")
        target = materialize(scd2_merge(snapshot, target, PAIR, name, stamp()).full, "dim")
    return target


@query
def scd2_same_date_rerun(t: Tables) -> DataFrame:
    return _merge(_snapshot(t, REST), _history(t, (0, REST), VERSIONED), VERSIONED, REST).full


@query
def scd2_same_date_correction(t: Tables) -> DataFrame:
    """Another snapshot for a date already loaded replaces attributes in place."""
    return _merge(_snapshot(t, 2), _history(t, (0, 1)), PLAIN, 1).full


@query
def scd2_late_snapshot(t: Tables) -> DataFrame:
    return _history(t, (0, 2, 1), VERSIONED)


@query
def scd2_null_end(t: Tables) -> DataFrame:
    """Open rows without an end are closed like any other open row."""
    target = _history(t, (0,)).withColumn("valid_to_dttm", F.lit(None).cast("timestamp_ntz"))
    return _merge(_snapshot(t, REST), target, PLAIN, REST).full


def _with_null_keys(t: Tables) -> DataFrame:
    key = F.when(F.col("segment_nm") != "BUILDING", F.col("CustomerId"))
    return _snapshot(t, REST).withColumn("CustomerId", key)


@query
def scd2_null_key(t: Tables) -> DataFrame:
    return _merge(_with_null_keys(t), _history(t, (0,)), PLAIN, REST).full


@query
def scd2_rejected(t: Tables) -> DataFrame:
    return _merge(_with_null_keys(t), _history(t, (0,)), PLAIN, REST).rejected


@query
def scd2_literal_rerun(t: Tables) -> DataFrame:
    """Closed interval test: the same load once more doubles the changed rows."""
    return _merge(_snapshot(t, REST), _history(t, (0, REST)), LITERAL, REST).full


@query
def scd2_literal_late(t: Tables) -> DataFrame:
    """Closed interval test: a late snapshot loses the later rows it differs from."""
    return _merge(_snapshot(t, 1), _history(t, (0, 2)), LITERAL, 1).full


# histories in buckets, with fingerprints, with key filters


def _pair_dimension(t: Tables) -> DataFrame:
    name, lo, hi = CUTS[0]
    first = materialize(pair_snapshot(t, lo, hi), "snapshot")
    return scd2_merge(first, empty_frame(t.spark, _PAIR), PAIR, name, stamp()).full


def _second_pairs(t: Tables) -> DataFrame:
    return materialize(pair_snapshot(t, *CUTS[REST][1:]), "snapshot")


@query
def scd2_bucketed_pairs(t: Tables) -> DataFrame:
    """A history in buckets of its composite key meets a snapshot; only the snapshot moves."""
    buckets, path = Buckets(8, PAIR.business_key), scratch_path(t.spark, "pair_dim")
    write_buckets(dealt(_pair_dimension(t), buckets), path, buckets)
    target = read_buckets(t.spark, path, _PAIR, buckets)
    return scd2_merge(_second_pairs(t), target, PAIR, CUTS[REST][0], stamp()).full_in_buckets(buckets)


@query
def dimension_load_bucketed(t: Tables) -> DataFrame:
    wh = replace(_warehouse(t, ("customer",)), buckets=4)
    for name, _, _ in PERIODS:
        load_entity(wh, "customer", name, stamp())
    return wh.dimension("customer")


@query
def scd2_fingerprinted(t: Tables) -> DataFrame:
    """Three loads into a history that stores its fingerprints, which are returned too."""
    target = with_fingerprint(empty_frame(t.spark, _VERSIONED), VERSIONED)
    for period in (0, 1, 2):
        merged = scd2_merge_fingerprinted(_snapshot(t, period), target, VERSIONED, CUTS[period][0], stamp())
        target = materialize(merged.full, "dim")
    return target


@query
def scd2_fingerprinted_pairs(t: Tables) -> DataFrame:
    target = materialize(with_fingerprint(_pair_dimension(t), PAIR), "dim")
    return scd2_merge_fingerprinted(_second_pairs(t), target, PAIR, CUTS[REST][0], stamp()).full


@query
def scd2_new_keys_filtered(t: Tables) -> DataFrame:
    """New pairs by a filter so small that most known and many new keys collide."""
    target = materialize(_pair_dimension(t), "dim")
    shape = FilterShape(1, hashes=1)
    key_filter = KeyFilter(build_filter(target, PAIR.business_key, shape), shape)
    return new_rows(_second_pairs(t), target, PAIR, key_filter)


@query
def dimension_load_filtered(t: Tables) -> DataFrame:
    wh = replace(_warehouse(t, ("customer",)), filter_bits=12)
    for name, _, _ in PERIODS:
        load_entity(wh, "customer", name, stamp())
    return wh.dimension("customer")


# many dates at once


def _snapshots(t: Tables, periods: tuple[int, ...], snapshot=customer_snapshot) -> DataFrame:
    """Stored snapshots of some periods in one table, with their dates."""
    parts = [
        snapshot(t, lo, hi).withColumn("sample_date", F.lit(name))
        for name, lo, hi in (CUTS[p] for p in periods)
    ]
    return materialize(reduce(DataFrame.unionByName, parts), "snapshots")


@query
def backfill_history(t: Tables) -> DataFrame:
    target = empty_frame(t.spark, _VERSIONED)
    return scd2_backfill(_snapshots(t, (0, 1, 2)), target, VERSIONED, processed=stamp()).full


@query
def backfill_onto_history(t: Tables) -> DataFrame:
    """Two more dates at once onto a history of one load."""
    target = _history(t, (0,), VERSIONED)
    return scd2_backfill(_snapshots(t, (1, 2)), target, VERSIONED, processed=stamp()).full


@query
def backfill_composite_key(t: Tables) -> DataFrame:
    snapshots = _snapshots(t, (0, REST), pair_snapshot)
    return scd2_backfill(snapshots, empty_frame(t.spark, _PAIR), PAIR, processed=stamp()).full


@query
def backfill_every_month(t: Tables) -> DataFrame:
    """A snapshot for each of 80 months, in the form of the last order of a customer in it."""
    snapshots = materialize(monthly_customer_snapshots(t), "snapshots")
    return scd2_backfill(snapshots, empty_frame(t.spark, _VERSIONED), VERSIONED, processed=stamp()).full


@query
def backfill_rejected(t: Tables) -> DataFrame:
    """Rows without a key among the snapshots of all dates."""
    key = F.when(F.col("segment_nm") != "BUILDING", F.col("CustomerId"))
    snapshots = _snapshots(t, (0, 1, 2)).withColumn("CustomerId", key)
    return scd2_backfill(snapshots, empty_frame(t.spark, _CUSTOMER), PLAIN, processed=stamp()).rejected


@query
def backfill_load(t: Tables) -> DataFrame:
    """Raw feeds of all periods to facts, all periods at once."""
    wh = _warehouse(t, tuple(FEED_STEMS))
    return backfill_months(wh, [name for name, _, _ in PERIODS], stamp(), stamp())


@query
def backfill_load_product(t: Tables) -> DataFrame:
    wh = _warehouse(t, ("product", "product_subcategory", "product_category"))
    return backfill_dimension(wh, "product", [name for name, _, _ in PERIODS], stamp())


@query
def backfill_after_load(t: Tables) -> DataFrame:
    """One load by itself, the later dates at once."""
    wh = _warehouse(t, ("customer",))
    load_entity(wh, "customer", PERIODS[0][0], stamp())
    return backfill_dimension(wh, "customer", [name for name, _, _ in PERIODS[1:]], stamp())


@query
def backfill_slices(t: Tables) -> DataFrame:
    """The six feeds of 80 months exported as slices, then loaded at once."""
    path = scratch_path(t.spark, "exported")
    slices = _slices(t, stored=True)
    export_months(slices, path, stored=STORED)
    months = slices["sales"].select("sample_date").distinct().collect()
    wh = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), path, layout="slices")
    return backfill_months(wh, [r["sample_date"] for r in months], stamp(), stamp())


# monthly slices


def _slices(t: Tables, stored: bool = False) -> dict[str, DataFrame]:
    """Slices of all feeds; stored ones serve those who need more than one."""
    return slice_by_month(
        raw_sales(t),
        us_date(F.col("OrderDate")),
        raw_customer(t),
        raw_product(t),
        raw_subcategory(t),
        raw_category(t),
        raw_territory(t),
        store=stored,
    )


@query
def sample_date_list(t: Tables) -> DataFrame:
    return sample_dates(raw_sales(t), us_date(F.col("OrderDate")))


@query
def sample_date_list_following(t: Tables) -> DataFrame:
    return sample_dates(raw_sales(t), us_date(F.col("OrderDate")), following=True)


@query
def month_slice_sales(t: Tables) -> DataFrame:
    return _slices(t)["sales"]


@query
def month_slice_territory(t: Tables) -> DataFrame:
    return _slices(t)["territory"]


@query
def month_slice_customer(t: Tables) -> DataFrame:
    return _slices(t)["customer"]


@query
def month_slice_product(t: Tables) -> DataFrame:
    return _slices(t)["product"]


@query
def month_slice_subcategory(t: Tables) -> DataFrame:
    return _slices(t)["product_subcategory"]


@query
def month_slice_category(t: Tables) -> DataFrame:
    return _slices(t)["product_category"]


@query
def month_slice_roundtrip(t: Tables) -> DataFrame:
    """All monthly slices of the six feeds written as CSV folders and read back."""
    path = scratch_path(t.spark, "slices")
    export_months(_slices(t, stored=True), path, stored=STORED)

    def read(feed: str) -> DataFrame:
        found = read_slices(t.spark, f"{path}/{feed}", schema_of("ods", feed))
        cells = [F.coalesce(F.col(c), F.lit("~")) for c in schema_of("ods", feed).names]
        return found.select(F.lit(feed).alias("feed"), "sample_date", F.concat_ws("|", *cells).alias("cells"))

    return reduce(DataFrame.unionByName, [read(feed) for feed in FEED_STEMS])


@query
def slices_load(t: Tables) -> DataFrame:
    """All sales cut into the slices of three wide periods, exported, and loaded one after the other."""
    path = scratch_path(t.spark, "exported")
    day = us_date(F.col("OrderDate"))
    period = F.coalesce(*[F.when(in_period_of(day, lo, hi), F.lit(name)) for name, lo, hi in PERIODS])
    feeds = slice_by_month(
        raw_sales(t),
        day,
        raw_customer(t),
        raw_product(t),
        raw_subcategory(t),
        raw_category(t),
        raw_territory(t),
        store=True,
        key=period,
    )
    export_months(feeds, path, stored=STORED)
    wh = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), path, layout="slices")
    for name, _, _ in PERIODS:
        run_month(wh, name, stamp(), stamp())
    return wh.table("dwh", "sales")


@query
def month_slice_single(t: Tables) -> DataFrame:
    """The feeds of one month cut from the sales of that month; one month is the feature."""
    sales = slice_month(raw_sales(t), us_date(F.col("OrderDate")), SINGLE_MONTH)
    feeds = slice_by_month(
        sales,
        us_date(F.col("OrderDate")),
        raw_customer(t),
        raw_product(t),
        raw_subcategory(t),
        raw_category(t),
        raw_territory(t),
        store=True,
    )

    def cells(feed: str) -> DataFrame:
        texts = [F.coalesce(F.col(c), F.lit("~")) for c in schema_of("ods", feed).names]
        return feeds[feed].select(F.lit(feed).alias("feed"), "sample_date", F.concat_ws("|", *texts).alias("cells"))

    return reduce(DataFrame.unionByName, [cells(feed) for feed in FEED_STEMS])


@query
def csv_raw_scan_awkward(t: Tables) -> DataFrame:
    """Texts with line breaks, quotes and separators, written and read back."""
    path = scratch_path(t.spark, "awkward.csv")
    rows = t.part.selectExpr(
        "CAST(p_partkey AS STRING) AS ProductKey",
        """concat(p_brand, '\n"', p_type, '", ', p_name, ',') AS ProductName""",
    )
    write_csv(rows, path, multi_line=True)
    return read_csv(t.spark, path, rows.schema, multi_line=True)


# feeds that are not as they should be


def _write_lines(df: DataFrame, header: str, path: str) -> None:
    """Write ready-made CSV lines below a header, without a writer's own quoting."""
    lines = df.select(F.col("line").alias(header))
    lines.write.options(header=True, sep="\u0001", quote="\u0000").csv(path)


_ORDER_FEED = columns("OrderKey string, CustomerKey string, Status string, Priority string")


def _damaged_orders(t: Tables) -> DataFrame:
    """A line for every order: some lack a cell, have one too many, or an open quote."""
    return t.orders.selectExpr(
        """CASE WHEN o_orderkey % 5 = 0 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus)
                WHEN o_orderkey % 7 = 0 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'x')
                WHEN o_orderkey % 11 = 0 THEN concat(o_orderkey, ',"', o_custkey, ',', o_orderstatus, ',', o_orderpriority)
                ELSE concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) END AS line"""
    )


@query
def csv_damaged_rows(t: Tables) -> DataFrame:
    """All orders as a feed with damaged lines: cells of the good ones, text of the others."""
    path = scratch_path(t.spark, "damaged.csv")
    _write_lines(_damaged_orders(t), ",".join(_ORDER_FEED.names), path)
    split = read_split(t.spark, path, _ORDER_FEED)
    good = split.good.select(F.lit("good").alias("kind"), F.concat_ws("|", *_ORDER_FEED.names).alias("text"))
    return good.unionByName(split.bad.select(F.lit("bad").alias("kind"), F.col("record").alias("text")))


@query
def load_damaged_feed(t: Tables) -> DataFrame:
    """A territory feed with damaged lines, loaded twice: typed rows, and rows set aside."""
    wh = replace(_warehouse(t, ()), bad_rows="aside")
    line = """CASE WHEN n_regionkey = 1 THEN concat_ws(',', n_nationkey, n_name, n_name)
                   ELSE concat_ws(',', n_nationkey, n_name, n_name, r_name) END AS line"""
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(line)
    path = feed_path(wh.raw_root, "territory", PERIODS[0][0])
    _write_lines(rows, ",".join(schema_of("ods", "territory").names), path)
    for _ in range(2):
        load_entity(wh, "territory", PERIODS[0][0], stamp())
    aside = t.spark.read.parquet(wh.path("bad", "territory"))
    return wh.dimension("territory").select("TerritoryId", F.col("Region").alias("text")).unionByName(
        aside.select(F.lit(None).cast("int").alias("TerritoryId"), F.col("record").alias("text"))
    )


@query
def csv_header_versions(t: Tables) -> DataFrame:
    """The sales of all months in three versions of the header, read as one feed."""
    path, schema = scratch_path(t.spark, "versions"), schema_of("ods", "sales")
    sales = materialize(slice_all_months(raw_sales(t), us_date(F.col("OrderDate"))), "sliced")
    first = sales.where("sample_date < '19980101'").drop("StockDate")
    second = sales.where("sample_date >= '19980101' AND sample_date < '20000101'")
    second = second.select(*reversed(second.columns), F.lit("web").alias("Channel"))
    third = sales.where("sample_date >= '20000101'").withColumnRenamed("OrderQuantity", "Quantity")
    for name, part in (("a", first), ("b", second), ("c", third)):
        write_slices(part, f"{path}/{name}")
    required = ["OrderNumber", "OrderQuantity"]
    return read_versions(t.spark, path, schema, required, {"Quantity": "OrderQuantity"}, SAMPLE_DATE)


# layouts that are read in part


@query
def month_slices_stored(t: Tables) -> DataFrame:
    """Sales stored by month; the slices of all months are found by their dates."""
    path, day = scratch_path(t.spark, "by_month"), us_date(F.col("OrderDate"))
    sales = raw_sales(t)
    store_by_month(sales, day, path)
    stored = read_by_month(t.spark, path, sales.schema)
    return slices_of(stored, sample_dates(raw_sales(t), day, following=True))


@query
def keys_clustered(t: Tables) -> DataFrame:
    """Every order stored in ranges of its customer, with filters on both keys, and read back."""
    path = scratch_path(t.spark, "clustered")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    write_clustered(rows, path, ["o_custkey", "o_orderkey"], 4)
    return t.spark.read.schema(rows.schema).parquet(path)


# jobs


def _warehouse(t: Tables, feeds: tuple[str, ...]) -> Warehouse:
    """Empty warehouse with the raw feeds of all periods dropped as CSV."""
    root = scratch_path(t.spark, "warehouse")
    wh = Warehouse(t.spark, root, f"{root}/raw")

    def drop(feed: str, name: str, lo: str | None, hi: str | None) -> None:
        write_feed(raw_feed(t, feed, lo, hi), wh.raw_root, feed, name)

    if "sales" in feeds:
        store_lines(t)
    together(t.spark, [partial(drop, feed, *period) for feed in feeds for period in PERIODS])
    return wh


@query
def dimension_load(t: Tables) -> DataFrame:
    wh = _warehouse(t, ("customer",))
    for name, _, _ in PERIODS:
        load_entity(wh, "customer", name, stamp())
    return wh.dimension("customer")


def _awkward_customers(t: Tables) -> DataFrame:
    """Every customer twice with one key, and again without a key."""
    rows = stage_customer(raw_customer(t))
    other = rows.withColumn("LastName", F.lit(""))
    return rows.unionByName(other).unionByName(rows.withColumn("CustomerId", F.lit(None).cast("int")))


@query
def dimension_load_duplicates(t: Tables) -> DataFrame:
    """Keys held twice are reduced to one row; rows without a key don't count as copies."""
    wh = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), "")
    load_staging(wh, "customer", _awkward_customers(t))
    return load_dimension(wh, "customer", PERIODS[0][0], stamp(), duplicates="drop")


@query
def dimension_load_rejected(t: Tables) -> DataFrame:
    """Rows without a key after a repeated load, and none of a load that was mended."""
    wh = Warehouse(t.spark, scratch_path(t.spark, "warehouse"), "")
    for day in (PERIODS[0][0], PERIODS[0][0], PERIODS[1][0]):
        load_staging(wh, "customer", _awkward_customers(t))
        load_dimension(wh, "customer", day, stamp(), duplicates="drop")
    load_staging(wh, "customer", stage_customer(raw_customer(t)))
    load_dimension(wh, "customer", PERIODS[1][0], stamp())
    return t.spark.read.parquet(wh.path("rejected", "customer")).select("LastName", "sample_date").withColumn(
        "sample_date", F.col("sample_date").cast("string")
    )


@query
def dimension_load_product(t: Tables) -> DataFrame:
    wh = _warehouse(t, ("product", "product_subcategory", "product_category"))
    for name, _, _ in PERIODS:
        load_entity(wh, "product", name, stamp())
    return wh.dimension("product")


@query
def dimension_load_territory(t: Tables) -> DataFrame:
    wh = _warehouse(t, ("territory",))
    for name, _, _ in PERIODS:
        load_entity(wh, "territory", name, stamp())
    return wh.dimension("territory")


@query
def monthly_load(t: Tables) -> DataFrame:
    """Raw feeds to facts with surrogate keys, load after load."""
    wh = _warehouse(t, tuple(FEED_STEMS))
    for name, _, _ in PERIODS:
        run_month(wh, name, stamp(), stamp())
    return wh.table("dwh", "sales")


@query
def facts_by_batch(t: Tables) -> DataFrame:
    """Facts with the batch they came by; each batch is read by itself."""
    wh = _warehouse(t, tuple(FEED_STEMS))
    for name, _, _ in PERIODS:
        run_month(wh, name, stamp(), stamp())
    batches = [wh.facts().where(F.col("sample_date") == name) for name, _, _ in PERIODS]
    return reduce(DataFrame.unionByName, batches).select("sample_date", "OrderNumber", "customer_rk", "OrderQuantity")


# reports


@query
def auto_summarize_fact(t: Tables) -> DataFrame:
    dims = _first_dimensions(t, None, None)
    return auto_summarize(stage_sales(raw_sales(t), *dims), ["OrderDate"])


@query
def report_by_batch(t: Tables) -> DataFrame:
    """A report kept batch by batch; the second batch is first loaded in part, then again."""
    wh = _warehouse(t, tuple(FEED_STEMS))
    for name, _, _ in PERIODS:
        run_month(wh, name, stamp(), stamp())
        store_report(wh, "sales_by_day", name, ["OrderDate"])
    again = PERIODS[1][0]
    whole = materialize(wh.facts().where(F.col("sample_date") == again).drop("sample_date"), "batch")
    replace_batch(whole.where("OrderQuantity < 20"), wh.path("dwh", "sales"), "sample_date", again)
    store_report(wh, "sales_by_day", again, ["OrderDate"])
    replace_batch(whole, wh.path("dwh", "sales"), "sample_date", again)
    store_report(wh, "sales_by_day", again, ["OrderDate"])
    return read_report(wh, "sales_by_day", ["OrderDate"])


@query
def auto_summarize_dim(t: Tables) -> DataFrame:
    dim = _first_dimension(t, "customer", None, None)
    return auto_summarize(dim, ["Occupation", "EducationLevel"])


@query
def auto_summarize_stage(t: Tables) -> DataFrame:
    product = stage_product(raw_product(t), raw_subcategory(t), raw_category(t))
    return auto_summarize(product, ["CategoryName"])
