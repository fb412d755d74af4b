"""Load many snapshots at once: the history that single loads would build one by one.

A snapshot row is a presence of its entity at a date. Ordered by date, presences whose
attributes equal those of the presence before belong to one run, and each run is one history
row: it starts where the run starts and ends where the next one does (gaps and islands). An
entity that a later snapshot leaves out stays open, so only presences matter. New entities
are numbered by the date of their first presence and by business key, which is the order in
which single loads would meet them.

Runs are decided by key, date and fingerprint alone, in one shuffle by business key, which serves the
numbers' join and all windows. An entity has at most one row for each date there, so no key is
large. Only the snapshot rows that begin a run are fetched with all their columns: a filter of their
keys and dates leaves out most others before rows are shuffled, and a join decides. The
snapshots are read once more for that, and the number of jobs and shuffles does not depend on
the number of dates.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.functions.dates import SAMPLE_DATE_FORMAT, instant_sql, run_day_midnight
from starload.functions.fingerprint import row_hash
from starload.functions.keyfilter import FilterShape, build_filter, maybe_in
from starload.functions.names import quoted
from starload.functions.sizing import fits_auto_broadcast
from starload.operators.keys import assign_surrogate_keys, max_key
from starload.operators.scd2 import Scd2Spec, check_columns, check_keys, drop_duplicate_keys
from starload.sources.scratch import materialize

_AT, _HASH, _STORED, _NUMBER, _OWN = "__at", "__hash", "__stored", "__number", "__own"
# Bits for each run in the filter of their beginnings, and how many each sets.
_FILTER_BITS, _FILTER_HASHES = 8, 3


def snapshot_instant(df: DataFrame, at: str) -> Column:
    """Date column of snapshots as a zone-free timestamp; text is read as ``yyyyMMdd``."""
    if isinstance(df.schema[at].dataType, T.StringType):
        return F.to_timestamp_ntz(F.col(at), F.lit(SAMPLE_DATE_FORMAT))
    return F.col(at).cast("timestamp_ntz")


def _complete(key: tuple[str, ...]) -> str:
    return " AND ".join(f"{quoted(k)} IS NOT NULL" for k in key)


def _stored_presences(target: DataFrame, spec: Scd2Spec, first: datetime) -> tuple[DataFrame, DataFrame]:
    """History rows that are open at the first snapshot, and the others.

    A history that goes on after that date, or that ends in it or later, is refused: what
    a snapshot means there depends on rows between two dates, which a late merge handles.
    """
    at, far = instant_sql(first), instant_sql(spec.open_end)
    start, end = quoted(spec.start), quoted(spec.end)
    late = f"COALESCE({start} >= {at}, false) OR COALESCE({end} > {at} AND {end} < {far}, false)"
    if not target.where(late).isEmpty():
        raise ValueError("the history reaches into the snapshots; merge those one by one")
    is_open = f"COALESCE({end} > {at}, true)"
    return target.where(is_open), target.where(f"NOT ({is_open})")


def new_entities(snapshots: DataFrame, known: DataFrame, spec: Scd2Spec, key_method: str = "auto") -> DataFrame:
    """Business key and surrogate of entities that ``known`` has never held.

    ``snapshots`` needs the key and the date ``__at``; both sides are reduced to keys before
    they meet.
    """
    key = list(spec.business_key)
    first = snapshots.groupBy(*key).agg(F.min(_AT).alias(_AT))
    unseen = first.join(known.select(*key).distinct(), key, "left_anti")
    seed = max_key(known, spec.surrogate_key, spec.first_key - 1).scalar()
    return assign_surrogate_keys(unseen, [_AT, *key], _NUMBER, seed, key_method).select(*key, _NUMBER)


def _fetched(rows: DataFrame, begun: DataFrame, key: list[str]) -> DataFrame:
    """Runs ``begun`` by a snapshot row with all columns of that row, of which ``rows`` has one a key and date."""
    on = [*key, _AT]
    if not fits_auto_broadcast(begun):
        shape = FilterShape.for_keys(begun.count(), _FILTER_BITS, _FILTER_HASHES)
        blocks = materialize(build_filter(begun, on, shape), "begun")
        rows = maybe_in(rows, on, blocks, shape, "__maybe").where("__maybe").drop("__maybe")
    return begun.join(rows, on)


class BackfillResult:
    """``full`` is the new content of the dimension, ``rejected`` the rows without a complete key."""

    def __init__(self, full: DataFrame, rejected: DataFrame):
        self.full, self.rejected = full, rejected


def scd2_backfill(
    snapshots: DataFrame,
    target: DataFrame,
    spec: Scd2Spec,
    at: str = "sample_date",
    processed: Column | None = None,
    key_method: str = "auto",
    duplicates: str = "error",
    known: DataFrame | None = None,
) -> BackfillResult:
    """The history after merging all ``snapshots`` into ``target`` in the order of their dates.

    ``snapshots`` holds the rows of every snapshot with its date in ``at``: a date, a
    timestamp, or ``yyyyMMdd`` text. The result equals ``scd2_merge`` applied once for each date,
    with one stamp ``processed`` for all. ``target`` may be empty, or a history that was last
    changed before the first date; ``known`` is the whole history where ``target`` leaves out
    rows that ended before. Rows without a complete key are set aside. A key held twice on
    one date raises, or with ``duplicates="drop"`` is reduced as ``drop_duplicate_keys`` does.
    Rows without a date belong to no snapshot and raise.
    """
    if spec.literal_intervals:
        raise ValueError("literal intervals depend on the order of single loads")
    if duplicates not in ("error", "drop"):
        raise ValueError(f"unknown treatment of duplicates {duplicates!r}")
    check_columns(snapshots, target, spec)
    known = target if known is None else known
    key, attributes, schema = spec.business_key, spec.attributes(target), target.schema
    stamp = run_day_midnight() if processed is None else processed

    rejected = snapshots.where(f"NOT ({_complete(key)})")
    rows = snapshots.where(_complete(key)).select(
        snapshot_instant(snapshots, at).alias(_AT),
        *[F.col(quoted(c)).cast(schema[c].dataType).alias(c) for c in attributes],
    )
    found = check_keys(rows, [*key, _AT])
    if found.incomplete_rows:
        raise ValueError(f"{found.incomplete_rows} snapshot rows have no date in {at}")
    if found.duplicate_keys and duplicates == "error":
        raise ValueError(f"{found.duplicate_keys} keys occur more than once on a date")
    if found.duplicate_keys:
        rows = materialize(drop_duplicate_keys(rows, [*key, _AT]), "reduced")
    first = rows.agg(F.min(_AT)).first()[0]
    if first is None:
        return BackfillResult(target, rejected)
    stored, rest = _stored_presences(target, spec, first)

    kept = {
        "__rk": spec.surrogate_key,
        "__start": spec.start,
        "__end": spec.end,
        "__processed": spec.processed,
    } | ({"__version": spec.version} if spec.version else {})
    # a stored row takes its columns along; of snapshot rows keys, dates and fingerprints suffice
    own = F.struct(*[F.col(quoted(c)) for c in attributes])
    digest = F.unhex(row_hash(attributes, spec.safe_fingerprint)).alias(_HASH)
    narrow = stored.select(
        F.col(spec.start).cast("timestamp_ntz").alias(_AT),
        *key,
        digest,
        F.lit(True).alias(_STORED),
        own.alias(_OWN),
        *[F.col(quoted(c)).alias(n) for n, c in kept.items()],
    ).unionByName(
        rows.select(
            _AT,
            *key,
            digest,
            F.lit(False).alias(_STORED),
            F.lit(None).cast(rows.select(own.alias(_OWN)).schema[_OWN].dataType).alias(_OWN),
            *[F.lit(None).cast(schema[c].dataType).alias(n) for n, c in kept.items()],
        )
    )
    numbered = narrow.join(new_entities(rows, known, spec, key_method), list(key), "left")

    # a stored row without a start comes first, as nulls do
    by_date = Window.partitionBy(*key).orderBy(_AT)
    whole = Window.partitionBy(*key)
    runs = (
        numbered.withColumn("__before", F.lag(_HASH).over(by_date))
        .where(f"__before IS NULL OR __before <> {_HASH}")
        .withColumn("__next", F.lead(_AT).over(by_date))
        .withColumn("__place", F.row_number().over(by_date))
        .withColumn("__entity", F.coalesce(F.col(_NUMBER), F.max("__rk").over(whole)))
        # an entity that was closed for good has no row a snapshot could speak about
        .where("__entity IS NOT NULL")
        .withColumn("__stamp", stamp)
    )
    far = instant_sql(spec.open_end)
    values = {
        spec.surrogate_key: "__entity",
        spec.start: f"IF({_STORED}, __start, {_AT})",
        spec.end: f"COALESCE(__next, IF({_STORED}, __end, {far}))",
        spec.processed: f"IF({_STORED} AND __next IS NULL, __processed, __stamp)",
    }
    if spec.version:
        runs = runs.withColumn("__base", F.coalesce(F.max("__version").over(whole), F.lit(0)))
        runs = runs.withColumn("__held", F.max(F.col(_STORED).cast("int")).over(whole))
        values[spec.version] = f"IF({_STORED}, __version, __base + __place - __held)"
    made = [f"{value} AS {quoted('__new_' + c)}" for c, value in values.items()]
    runs = materialize(runs.selectExpr(_AT, *map(quoted, key), _STORED, _OWN, *made), "runs")
    inner = [f"{_OWN}.{quoted(c)} AS {quoted(c)}" for c in attributes]
    new = [quoted(f"__new_{c}") for c in values]
    held = runs.where(_STORED).selectExpr(*inner, *new)
    begun = runs.where(f"NOT {_STORED}").selectExpr(_AT, *map(quoted, key), *new)
    whole_rows = held.unionByName(_fetched(rows, begun, list(key)).drop(_AT))
    full = whole_rows.selectExpr(
        *[
            f"CAST({quoted('__new_' + c) if c in values else quoted(c)} AS {schema[c].dataType.simpleString()}) AS {quoted(c)}"
            for c in target.columns
        ]
    )
    return BackfillResult(full.unionByName(rest), rejected)
