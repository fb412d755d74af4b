"""Row fingerprints used to tell whether tracked attributes differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.names import quoted

SEPARATOR = "|"


def row_text_sql(values: Sequence[str], safe: bool = False) -> str:
    """:func:`row_text` over SQL expressions."""
    texts = [f"CAST({v} AS STRING)" for v in values]
    if safe:
        texts = [f"COALESCE(CONCAT(LENGTH({t}), ':', {t}), '-')" for t in texts]
    return f"CONCAT_WS('{SEPARATOR}', {', '.join(texts)})"


def row_text(columns: Sequence[str], safe: bool = False) -> Column:
    """Text that two rows share exactly when their fingerprints agree.

    The default skips nulls and does not escape the separator, which is what a
    plain ``concat_ws`` fingerprint does: (a, null, b) and (a, b, null) agree.
    ``safe`` writes the length in front of each value and marks nulls, so no two
    different rows agree.
    """
    return F.expr(row_text_sql([quoted(c) for c in columns], safe))


def row_hash(columns: Sequence[str], safe: bool = False) -> Column:
    """MD5 of :func:`row_text`."""
    return F.md5(row_text(columns, safe))


def with_row_hash(
    df: DataFrame, columns: Sequence[str], name: str = "hash_value", safe: bool = False
) -> DataFrame:
    return df.withColumn(name, row_hash(columns, safe))
