"""Left lookups against dimension and hierarchy tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.names import quoted
from starload.functions.sizing import (
    BROADCAST_LIMIT_BYTES,
    broadcast_if_bounded,
    fits_auto_broadcast,
)
from starload.sources.scratch import materialize


def one_row_per_key(dim: DataFrame, key: str, value: str) -> DataFrame:
    """Key and surrogate, one row per key.

    All versions of an entity share their surrogate, so the minimum is the
    surrogate. It aggregates map-side: a key with a long history sends one row
    per task, and the result is already distributed for a join on the key.
    """
    return dim.groupBy(key).agg(F.min(value).alias(value))


def first_seen(dim: DataFrame, key: str, value: str, start: str) -> DataFrame:
    """``one_row_per_key`` with the date ``first_seen`` on which the entity was first loaded."""
    return dim.groupBy(key).agg(F.min(value).alias(value), F.min(start).alias("first_seen"))


def lookup(
    df: DataFrame,
    other: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str] | Mapping[str, str],
    null_safe: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Left join on ``{left: right}`` and expand the columns to ``take``.

    Rows without a match keep nulls. The looked-up side is broadcast only within
    a checked size; otherwise the join shuffles, and adaptive execution splits hot
    keys of the left side.
    """
    columns = dict(take) if isinstance(take, Mapping) else {name: name for name in take}
    right = other.selectExpr(
        *[f"{quoted(r)} AS __on_{i}" for i, r in enumerate(on.values())],
        *[f"{quoted(source)} AS {quoted(name)}" for source, name in columns.items()],
    )
    right = broadcast_if_bounded(right, broadcast_limit)
    keys = [(df[name], right[f"__on_{i}"]) for i, name in enumerate(on)]
    condition = [a.eqNullSafe(b) if null_safe else a == b for a, b in keys]
    return df.join(right, condition, "left").drop(*[f"__on_{i}" for i in range(len(on))])


def lookup_surrogates(
    df: DataFrame,
    dims: Sequence[tuple[DataFrame, str, str, str]],
    null_safe: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Add one surrogate per ``(dimension, dimension key, surrogate, fact key)``.

    The lookup is by key only, not by date: a version becomes valid on the load
    date, which lies after the order dates of the month it was loaded with.

    A reduced dimension too large for Spark to broadcast is stored first: read from
    files, both sides of the join are plain shuffles, which is the shape in which
    adaptive execution can split a fact key that holds a large share of the rows.
    """
    for dim, dim_key, surrogate, fact_key in dims:
        slim = one_row_per_key(dim, dim_key, surrogate)
        if not fits_auto_broadcast(slim):
            slim = materialize(slim, "keys")
        df = lookup(df, slim, {fact_key: dim_key}, [surrogate], null_safe, broadcast_limit)
    return df


def flatten_snowflake(
    leaf: DataFrame,
    levels: Sequence[tuple[DataFrame, Mapping[str, str], Sequence[str]]],
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    null_safe: bool = False,
) -> DataFrame:
    """Pull attributes of a hierarchy down to its leaf.

    ``levels`` goes outward from the leaf; each is the table, its join pairs
    ``{inner column: column of this level}`` and the attributes to bring down.
    The upper levels are joined to each other first, so the wide leaf is joined,
    and at scale shuffled, once. ``null_safe`` lets a null key find a row with a null key.
    """
    table, on, attributes = levels[0]
    taken = list(attributes)
    if len(levels) > 1:
        above = levels[1:]
        table = flatten_snowflake(table, above, broadcast_limit, null_safe)
        if not fits_auto_broadcast(table):  # measured before it is joined, so it runs once
            table = materialize(table, "levels")
        taken += [name for _, _, names in above for name in names]
    return lookup(leaf, table, on, taken, null_safe, broadcast_limit)
