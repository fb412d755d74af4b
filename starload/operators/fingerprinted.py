"""Merge by stored fingerprints: narrow rows decide, wide rows of touched entities follow.

A dimension that carries the fingerprint of each row in a column is compared with a snapshot
by key and fingerprint alone. The keys of entities that are new or changed are stored, and
only the rows of these entities, from both sides, go through the merge with all their
columns. All other history rows are kept as they are, with their stored fingerprint. On a
table of many wide attributes, of which a load changes few rows, the shuffle holds two short
columns a row instead of all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.dates import instant_sql, run_day_midnight
from starload.functions.fingerprint import row_hash
from starload.functions.sizing import BROADCAST_LIMIT_BYTES, broadcast_if_bounded
from starload.operators.scd2 import Scd2Result, Scd2Spec, _complete, _valid_at, check_columns, scd2_merge
from starload.sources.scratch import materialize

FINGERPRINT = "row_hash"


def attributes_of(target: DataFrame, spec: Scd2Spec, fingerprint: str = FINGERPRINT) -> list[str]:
    return [c for c in spec.attributes(target) if c != fingerprint]


def with_fingerprint(target: DataFrame, spec: Scd2Spec, fingerprint: str = FINGERPRINT) -> DataFrame:
    """A dimension with the fingerprint of its tracked columns, as the merge compares them."""
    names = attributes_of(target, spec, fingerprint)
    return target.withColumn(fingerprint, row_hash(names, spec.safe_fingerprint))


def touched_keys(
    source: DataFrame,
    target: DataFrame,
    spec: Scd2Spec,
    as_of: str | date | datetime,
    fingerprint: str = FINGERPRINT,
    known: DataFrame | None = None,
) -> DataFrame:
    """Business keys of a snapshot that are new, or whose valid row has another fingerprint.

    Reads keys, validity and fingerprint of the history, and nothing else of it.
    """
    key = list(spec.business_key)
    names = attributes_of(target, spec, fingerprint)
    narrow = source.where(_complete(spec.business_key)).select(
        *key, row_hash(names, spec.safe_fingerprint).alias("__theirs")
    )
    valid = target.where(_valid_at(spec, instant_sql(as_of))).select(*key, F.col(fingerprint).alias("__ours"))
    changed = narrow.join(valid, key).where("__theirs <> __ours").select(*key)
    new = narrow.join((target if known is None else known).select(*key).distinct(), key, "left_anti").select(*key)
    return changed.unionByName(new).distinct()


def _of_keys(df: DataFrame, keys: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    return df.join(keys, [df[k] == keys[f"__t_{k}"] for k in key], how)


class FingerprintedResult:
    """Frames of one merge: ``full``, ``insert``, ``close``, ``corrected``, ``rejected``.

    As those of ``Scd2Result``, with the fingerprint column in all but ``rejected``.
    """

    def __init__(self, merge: Scd2Result, untouched: DataFrame, spec: Scd2Spec, fingerprint: str, rejected: DataFrame):
        self._merge, self._untouched = merge, untouched
        self._spec, self._fingerprint, self.rejected = spec, fingerprint, rejected

    def _hashed(self, df: DataFrame) -> DataFrame:
        names = attributes_of(self._untouched, self._spec, self._fingerprint)
        return df.withColumn(self._fingerprint, row_hash(names, self._spec.safe_fingerprint))

    @cached_property
    def full(self) -> DataFrame:
        return self._hashed(self._merge.full).select(self._untouched.columns).unionByName(self._untouched)

    @cached_property
    def insert(self) -> DataFrame:
        return self._hashed(self._merge.insert)

    @cached_property
    def close(self) -> DataFrame:
        return self._hashed(self._merge.close)

    @cached_property
    def corrected(self) -> DataFrame:
        return self._hashed(self._merge.corrected)


def scd2_merge_fingerprinted(
    source: DataFrame,
    target: DataFrame,
    spec: Scd2Spec,
    as_of: str | date | datetime,
    processed: Column | None = None,
    fingerprint: str = FINGERPRINT,
    key_method: str = "auto",
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    known: DataFrame | None = None,
) -> FingerprintedResult:
    """``scd2_merge`` into a history that stores the fingerprint of each row.

    The stored fingerprints have to be those of ``with_fingerprint`` under the same spec. The
    keys of touched entities are stored once; their number is counted before they are
    broadcast, and beyond ``broadcast_limit`` they are joined by a shuffle. ``known`` as in
    ``scd2_merge``.
    """
    if spec.literal_intervals:
        raise ValueError("literal intervals also lose rows whose fingerprint agrees")
    check_columns(source, target.drop(fingerprint), spec)
    key = spec.business_key
    known = target if known is None else known
    touched = materialize(touched_keys(source, target, spec, as_of, fingerprint, known), "touched")
    keys = broadcast_if_bounded(touched.select([F.col(k).alias(f"__t_{k}") for k in key]), broadcast_limit)
    merge = scd2_merge(
        _of_keys(source, keys, key, "left_semi"),
        _of_keys(target.drop(fingerprint), keys, key, "left_semi"),
        spec,
        as_of,
        run_day_midnight() if processed is None else processed,
        key_method,
        known=_of_keys(known.select(*key), keys, key, "left_semi"),
        highest=known,
    )
    rejected = source.where(f"NOT ({_complete(key)})")
    return FingerprintedResult(merge, _of_keys(target, keys, key, "left_anti"), spec, fingerprint, rejected)
