"""Slowly changing dimensions of type 2: merge a snapshot into a history.

A history row is valid in the half-open interval ``[start, end)``; an open row
ends at a fixed far date. A merge at date ``d`` can only touch the row of a key
that is valid at ``d``, so all other history rows pass through without being
shuffled, and the join sees at most one history row per key however long the
history of a key is. Two joins do the work:

* rows valid at ``d``, left join snapshot: kept, closed and reopened, or corrected;
* snapshot, anti join the distinct keys of the history: entities never seen before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.functions.dates import OPEN_END, instant_sql, run_day_midnight
from starload.functions.fingerprint import row_text_sql
from starload.functions.keyfilter import FilterShape, maybe_in
from starload.functions.names import quoted
from starload.functions.sizing import broadcast_if_bounded, is_small
from starload.operators.keys import EMPTY_SEED, assign_surrogate_keys, max_key
from starload.schemas import require_columns
from starload.sources.buckets import Buckets, dealt
from starload.sources.scratch import materialize


@dataclass(frozen=True)
class Scd2Spec:
    """Names of the technical columns of a dimension.

    ``version`` is the optional version-number column. ``safe_fingerprint``
    separates nulls and separators when attributes are compared.
    ``literal_intervals`` applies the interval test closed on both ends, with
    plain three-valued logic and no protection of later rows; a merge is then not
    repeatable and late snapshots lose rows, so it serves comparison only.
    """

    surrogate_key: str
    business_key: tuple[str, ...]
    start: str = "valid_from_dttm"
    end: str = "valid_to_dttm"
    processed: str = "process_dttm"
    version: str | None = "version_no"
    open_end: str = OPEN_END
    first_key: int = EMPTY_SEED + 1
    safe_fingerprint: bool = False
    literal_intervals: bool = False

    def __post_init__(self) -> None:
        if isinstance(self.business_key, str):
            object.__setattr__(self, "business_key", (self.business_key,))
        else:
            object.__setattr__(self, "business_key", tuple(self.business_key))
        if not self.business_key:
            raise ValueError("a business key is required")

    @property
    def technical(self) -> tuple[str, ...]:
        names = (self.surrogate_key, self.start, self.end, self.processed)
        return names + ((self.version,) if self.version else ())

    def attributes(self, target: DataFrame) -> list[str]:
        """Compared columns: those of the target, in its order, but the technical ones."""
        return [c for c in target.columns if c not in self.technical]


def check_columns(source: DataFrame, target: DataFrame, spec: Scd2Spec) -> None:
    """Every non-technical column of the target must be in the source."""
    require_columns(source, target.columns, ignore=spec.technical)


@dataclass(frozen=True)
class KeyCheck:
    """Number of rows without a complete key, and of complete keys held twice or more."""

    incomplete_rows: int
    duplicate_keys: int


def check_keys(df: DataFrame, key: Sequence[str]) -> KeyCheck:
    """Count key problems of a snapshot; reads the key columns only, in one job."""
    complete = F.expr(_complete(key))
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    found = counted.agg(
        F.coalesce(F.sum(F.when(~complete, F.col("n"))), F.lit(0)).alias("incomplete"),
        F.count_if(complete & (F.col("n") > 1)).alias("duplicate"),
    ).first()
    return KeyCheck(found["incomplete"], found["duplicate"])


def drop_duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per complete key, the greatest by its other columns; aggregates map-side.

    Rows without a complete key are no copies of one another and all stay.
    """
    complete = F.expr(_complete(key))
    whole, incomplete = df.where(complete), df.where(~complete)
    others = [c for c in df.columns if c not in key]
    if not others:
        return whole.distinct().unionByName(incomplete)
    best = whole.groupBy(*key).agg(F.max(F.struct(*others)).alias("__row"))
    reduced = best.select([F.col(c) if c in key else F.col(f"__row.{c}") for c in df.columns])
    return reduced.unionByName(incomplete)


def _and(conditions: Sequence[str]) -> str:
    return " AND ".join(f"({c})" for c in conditions)


def _complete(key: Sequence[str]) -> str:
    return _and([f"{quoted(k)} IS NOT NULL" for k in key])


def _s(name: str) -> str:
    """Quoted name of a snapshot column next to the history row it was matched with."""
    return quoted(f"__s_{name}")


def _valid_at(spec: Scd2Spec, at: str) -> str:
    """Whether a history row is the one a snapshot of date ``at`` speaks about."""
    start, end = quoted(spec.start), quoted(spec.end)
    if spec.literal_intervals:
        return f"COALESCE({at} BETWEEN {start} AND {end}, false)"
    return f"({start} IS NULL OR {start} <= {at}) AND ({end} IS NULL OR {end} > {at})"


def _reachable(spec: Scd2Spec, at: str) -> str:
    """Rows that have to meet the snapshot; the rest is kept whatever it says."""
    if spec.literal_intervals:
        end = quoted(spec.end)
        return f"{end} IS NULL OR {end} >= {at}"
    return _valid_at(spec, at)


def _starts_at(spec: Scd2Spec, at: str) -> str:
    return "false" if spec.literal_intervals else f"COALESCE({quoted(spec.start)} = {at}, false)"


def _next_version(spec: Scd2Spec) -> str:
    return f"COALESCE({quoted(spec.version)} + 1, 1)"


def _reopened_end(spec: Scd2Spec) -> str:
    """A late row ends where the row it cuts ended, so later history stays intact."""
    far = instant_sql(spec.open_end)
    return far if spec.literal_intervals else f"COALESCE({quoted(spec.end)}, {far})"


def _typed(value: str, name: str, schema: StructType) -> str:
    return f"CAST({value} AS {schema[name].dataType.simpleString()}) AS {quoted(name)}"


def _same_type(a: StructType, b: StructType, name: str) -> bool:
    return a[name].dataType == b[name].dataType


def _renamed(source: DataFrame) -> DataFrame:
    """Snapshot columns as ``__s_<column>``; both joins shuffle this one frame."""
    return source.selectExpr(*[f"{quoted(c)} AS {_s(c)}" for c in source.columns])


@dataclass(frozen=True)
class KeyFilter:
    """A filter that holds every business key of a history, and perhaps others."""

    blocks: DataFrame
    shape: FilterShape


def _unseen(
    snapshot: DataFrame, target: DataFrame, spec: Scd2Spec, key_filter: KeyFilter | None = None
) -> DataFrame:
    keys = target.select(*spec.business_key)
    if not is_small(keys):
        # a key with a long history reaches the join once; small ones are broadcast
        keys = keys.distinct()
    on = [f"__s_{k}" for k in spec.business_key]
    alike = all(snapshot.schema[f"__s_{k}"].dataType == keys.schema[k].dataType for k in spec.business_key)
    if key_filter is None or not alike:  # another type hashes otherwise
        return snapshot.join(keys, [snapshot[s] == keys[k] for s, k in zip(on, spec.business_key)], "left_anti")
    # surely new rows need no join; the others, known or not, take it, so the result is exact
    asked = maybe_in(snapshot, on, key_filter.blocks, key_filter.shape, "__maybe")
    maybe = asked.where("__maybe").drop("__maybe")
    checked = maybe.join(keys, [maybe[s] == keys[k] for s, k in zip(on, spec.business_key)], "left_anti")
    return asked.where("NOT __maybe").drop("__maybe").unionByName(checked)


def new_rows(
    source: DataFrame, target: DataFrame, spec: Scd2Spec, key_filter: KeyFilter | None = None
) -> DataFrame:
    """Source rows of entities that the whole history has never seen; incomplete keys name none."""
    complete = source.where(_complete(spec.business_key))
    unseen = _unseen(_renamed(complete), target, spec, key_filter)
    return unseen.selectExpr(*[f"{_s(c)} AS {quoted(c)}" for c in source.columns])


def _attributes_differ(snapshot: StructType, target: DataFrame, spec: Scd2Spec) -> str:
    """Whether the fingerprints of a matched pair differ, without hashing.

    Equal columns have equal fingerprints, so the text under the fingerprint is
    only built for pairs that differ in some column. Key columns of one type are
    equal by the join.
    """
    names = spec.attributes(target)
    text = row_text_sql([quoted(c) for c in names], spec.safe_fingerprint)
    other = row_text_sql([_s(c) for c in names], spec.safe_fingerprint)
    if any(snapshot[f"__s_{c}"].dataType != target.schema[c].dataType for c in names):
        return f"{text} <> {other}"
    compared = [c for c in names if c not in spec.business_key]
    same = _and([f"{quoted(c)} <=> {_s(c)}" for c in compared]) or "true"
    return f"NOT ({same}) AND {text} <> {other}"


def _matched(
    snapshot: DataFrame, target: DataFrame, spec: Scd2Spec, at: str, broadcast_limit: int = 0
) -> DataFrame:
    """History rows that meet the snapshot, with their snapshot row and the verdict.

    Columns: those of the target, the snapshot row as ``__s_<column>``, and the
    flags ``__differs`` (in the snapshot with other attributes), ``__valid`` (row is
    valid at the date), ``__changed`` (to be closed and reopened) and
    ``__corrected`` (to be replaced in place). A snapshot measured to be under
    ``broadcast_limit`` bytes is broadcast, so that the history is not shuffled.
    """
    right = broadcast_if_bounded(snapshot, broadcast_limit)
    history = target.where(_reachable(spec, at))
    on = [history[k] == right[f"__s_{k}"] for k in spec.business_key]
    present = f"{_s(spec.business_key[0])} IS NOT NULL"
    differs = _attributes_differ(snapshot.schema, target, spec)
    pairs = history.join(right, on, "left").selectExpr(
        "*", f"{present} AND {differs} AS __differs", f"{_valid_at(spec, at)} AS __valid"
    )
    hit = "__differs AND __valid"
    return pairs.selectExpr(
        "*",
        f"{hit} AND NOT {_starts_at(spec, at)} AS __changed",
        f"{hit} AND {_starts_at(spec, at)} AS __corrected",
    )


def unchanged_rows(source: DataFrame, target: DataFrame, spec: Scd2Spec, as_of) -> DataFrame:
    """History rows a merge at ``as_of`` leaves as they are."""
    at = instant_sql(as_of)
    kept = _matched(_renamed(source), target, spec, at).where("NOT __differs")
    return kept.select(target.columns).unionByName(target.where(f"NOT ({_reachable(spec, at)})"))


def changed_rows(source: DataFrame, target: DataFrame, spec: Scd2Spec, as_of) -> DataFrame:
    """History rows that a merge at ``as_of`` closes, before they are closed."""
    pairs = _matched(_renamed(source), target, spec, instant_sql(as_of))
    return pairs.where("__changed").select(target.columns)


class Scd2Result:
    """Frames of one merge; each is planned when first asked for, and lazy.

    ``full`` is the new content of the dimension. ``insert`` holds the rows to
    add, with any further source columns; ``close`` the rows whose interval was
    ended; ``corrected`` the rows that started on the same date and were replaced
    in place; ``rejected`` the source rows without a complete business key.
    """

    def __init__(
        self,
        source: DataFrame,
        target: DataFrame,
        spec: Scd2Spec,
        as_of: str | date | datetime,
        processed: Column,
        key_method: str,
        broadcast_limit: int,
        known: DataFrame,
        highest: DataFrame,
        key_filter: KeyFilter | None,
    ):
        self._target, self._spec, self._schema = target, spec, target.schema
        self._at = instant_sql(as_of)
        self._processed, self._key_method = processed, key_method
        self._broadcast_limit, self._known, self._highest = broadcast_limit, known, highest
        self._key_filter = key_filter
        self._all = source
        complete = _complete(spec.business_key)
        self._source = source if spec.literal_intervals else source.where(complete)

    @cached_property
    def rejected(self) -> DataFrame:
        if self._spec.literal_intervals:
            return self._all.where("false")
        return self._all.where(f"NOT ({_complete(self._spec.business_key)})")

    @cached_property
    def _snapshot(self) -> DataFrame:
        return _renamed(self._source)

    @cached_property
    def _pairs(self) -> DataFrame:
        pairs = _matched(
            self._snapshot, self._target, self._spec, self._at, self._broadcast_limit
        )
        return pairs.withColumn("__stamp", self._processed)

    @cached_property
    def _fresh(self) -> DataFrame:
        """New entities with surrogate and technical columns, in source columns."""
        spec, schema = self._spec, self._schema
        seed = max_key(self._highest, spec.surrogate_key, spec.first_key - 1).scalar()
        numbered = assign_surrogate_keys(
            _unseen(self._snapshot, self._known, spec, self._key_filter),
            [f"__s_{k}" for k in spec.business_key],
            spec.surrogate_key,
            seed,
            self._key_method,
        ).withColumn("__stamp", self._processed)
        technical = {
            spec.surrogate_key: quoted(spec.surrogate_key),
            spec.start: self._at,
            spec.end: instant_sql(spec.open_end),
            spec.processed: "__stamp",
        }
        if spec.version:
            technical[spec.version] = "1"
        return numbered.selectExpr(
            *[f"{_s(c)} AS {quoted(c)}" for c in self._source.columns],
            *[_typed(value, c, schema) for c, value in technical.items()],
        )

    @cached_property
    def _rest(self) -> DataFrame:
        """History rows that never meet the snapshot.

        Only a late snapshot has rows after its date; if versions are numbered,
        those of a key that got a row in between move up by one.
        """
        spec, target = self._spec, self._target
        rest = target.where(f"NOT ({_reachable(spec, self._at)})")
        if not spec.version or spec.literal_intervals:
            return rest
        later = f"COALESCE({quoted(spec.start)} > {self._at}, false)"
        after = rest.where(later)
        if after.isEmpty():  # the scan skips files by their start; most loads end here
            return rest
        touched = self._pairs.where("__changed").selectExpr(
            *[f"{quoted(k)} AS {quoted('__k_' + k)}" for k in spec.business_key],
            "1 AS __shift",
        )
        # stored, so that a key with very many later rows can be split in the join
        touched = materialize(touched, "touched")
        on = [after[k] == touched[f"__k_{k}"] for k in spec.business_key]
        version = f"CASE WHEN __shift = 1 THEN {_next_version(spec)} ELSE {quoted(spec.version)} END"
        moved = after.join(touched, on, "left").selectExpr(
            *[
                _typed(version, c, self._schema) if c == spec.version else quoted(c)
                for c in target.columns
            ]
        )
        return rest.where(f"NOT {later}").unionByName(moved)

    def _from_source(self, name: str) -> str:
        """Snapshot value in the type of the target."""
        if _same_type(self._source.schema, self._schema, name):
            return _s(name)
        return f"CAST({_s(name)} AS {self._schema[name].dataType.simpleString()})"

    @cached_property
    def full(self) -> DataFrame:
        return self.merged.unionByName(self.fresh).unionByName(self._rest)

    def full_in_buckets(self, buckets: Buckets) -> DataFrame:
        """``full`` for a history stored in buckets of its key.

        Rows that met the snapshot stay in the tasks of the join, which are those of the
        buckets; only new entities, and rows the merge did not reach, are dealt anew.
        """
        return self.merged.unionByName(dealt(self.fresh.unionByName(self._rest), buckets))

    @cached_property
    def fresh(self) -> DataFrame:
        """Rows of new entities, in the columns of the target."""
        schema = self._schema
        return self._fresh.selectExpr(*[_typed(quoted(c), c, schema) for c in self._target.columns])

    @cached_property
    def merged(self) -> DataFrame:
        """What becomes of the history rows that met the snapshot."""
        spec, target, schema = self._spec, self._target, self._schema
        pairs = self._pairs
        if spec.literal_intervals:
            pairs = pairs.where("NOT __differs OR __valid")
        # one output row per kept or corrected history row, two per changed one
        rows = pairs.selectExpr(
            "*", "explode(IF(__changed, array(false, true), array(false))) AS __reopened"
        )
        start, end = quoted(spec.start), quoted(spec.end)
        values = {
            spec.start: f"IF(__reopened, {self._at}, {start})",
            spec.end: f"CASE WHEN __reopened THEN {_reopened_end(spec)} "
            f"WHEN __changed THEN {self._at} ELSE {end} END",
            spec.processed: f"IF(__changed OR __corrected, __stamp, {quoted(spec.processed)})",
        }
        if spec.version:
            values[spec.version] = f"IF(__reopened, {_next_version(spec)}, {quoted(spec.version)})"
        for c in spec.attributes(target):
            values[c] = f"IF(__reopened OR __corrected, {self._from_source(c)}, {quoted(c)})"
        return rows.selectExpr(*[_typed(values.get(c, quoted(c)), c, schema) for c in target.columns])

    @cached_property
    def insert(self) -> DataFrame:
        spec, source = self._spec, self._source
        reopened = {
            spec.surrogate_key: quoted(spec.surrogate_key),
            spec.start: self._at,
            spec.end: _reopened_end(spec),
            spec.processed: "__stamp",
        }
        if spec.version:
            reopened[spec.version] = _next_version(spec)
        changed = self._pairs.where("__changed").selectExpr(
            *[f"{_s(c)} AS {quoted(c)}" for c in source.columns],
            *[_typed(value, c, self._schema) for c, value in reopened.items()],
        )
        return self._fresh.unionByName(changed)

    @cached_property
    def close(self) -> DataFrame:
        spec = self._spec
        return self._rewritten("__changed", {spec.end: self._at, spec.processed: "__stamp"})

    @cached_property
    def corrected(self) -> DataFrame:
        values = {c: self._from_source(c) for c in self._spec.attributes(self._target)}
        return self._rewritten("__corrected", values | {self._spec.processed: "__stamp"})

    def _rewritten(self, flag: str, values: Mapping[str, str]) -> DataFrame:
        columns = self._target.columns
        return self._pairs.where(flag).selectExpr(
            *[_typed(values.get(c, quoted(c)), c, self._schema) for c in columns]
        )


def scd2_merge(
    source: DataFrame,
    target: DataFrame,
    spec: Scd2Spec,
    as_of: str | date | datetime,
    processed: Column | None = None,
    key_method: str = "auto",
    broadcast_limit: int = 0,
    known: DataFrame | None = None,
    highest: DataFrame | None = None,
    key_filter: KeyFilter | None = None,
) -> Scd2Result:
    """Merge snapshot ``source``, taken at ``as_of``, into the history ``target``.

    New entities get the next dense surrogate keys in business-key order and
    version 1. A changed entity keeps its surrogate key: its valid row ends at
    ``as_of`` and a new row, with the next version, starts there. A row that
    already starts at ``as_of`` is corrected in place, which makes a repeated load
    a no-op. Entities absent from the snapshot stay as they are. ``processed``
    stamps the rows written, by default with midnight of the run day.

    A snapshot has to hold each key once, which ``check_keys`` tells; a key held twice
    would become two entities.

    Both inputs should be stored tables: the target is scanned for the rows valid
    at the date, for the rest, for its keys and for its highest surrogate key, each
    time with the filter or the columns pushed down. With ``broadcast_limit`` the
    snapshot is measured, and broadcast if it is smaller. ``known`` is the whole
    history where ``target`` leaves out rows that ended before ``as_of``: entities
    and surrogate keys are then looked up there, and ``full`` leaves the same rows out.
    ``highest`` is where the highest surrogate is looked up, if ``known`` is not the place.
    ``key_filter`` holds all keys of the history; snapshot rows that it surely does not hold
    are new without a look at the history.
    """
    check_columns(source, target, spec)
    stamp = run_day_midnight() if processed is None else processed
    known = target if known is None else known
    highest = known if highest is None else highest
    return Scd2Result(
        source, target, spec, as_of, stamp, key_method, broadcast_limit, known, highest, key_filter
    )


def in_key_order(df: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Sort by business key and start: a range shuffle and a sort within partitions."""
    return df.orderBy(*spec.business_key, spec.start)
