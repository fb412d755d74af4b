"""Raw text to typed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.dates import us_date

US_DATE = "us_date"


def _typed(name: str, kind: str, tolerant: bool) -> Column:
    column = F.col(name)
    if kind == US_DATE:
        parsed = us_date(column)
        if tolerant:
            return parsed
        bad = F.concat(F.lit("not a date: "), column)
        return F.when(column.isNotNull() & parsed.isNull(), F.raise_error(bad)).otherwise(parsed)
    return column.try_cast(kind) if tolerant else column.cast(kind)


def retype(df: DataFrame, types: Mapping[str, str], tolerant: bool = True) -> DataFrame:
    """Change column types; ``us_date`` reads ``M/d/yyyy`` text.

    A value that cannot be converted becomes null when ``tolerant``, else raises.
    """
    return df.withColumns({c: _typed(c, kind, tolerant) for c, kind in types.items()})


def standardize(
    df: DataFrame,
    types: Mapping[str, str],
    rename: Mapping[str, str] | None = None,
    tolerant: bool = True,
) -> DataFrame:
    """Type the columns under their old names, then rename them."""
    typed = retype(df, types, tolerant)
    return typed.withColumnsRenamed(dict(rename)) if rename else typed
