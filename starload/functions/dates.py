"""Date helpers: load dates, US-style text dates, month arithmetic."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats in which a load date and raw feed dates arrive, and
# the end of an interval that is still open.
SAMPLE_DATE_FORMAT = "yyyyMMdd"
US_DATE_FORMAT = "M/d/yyyy"
OPEN_END = "9999-12-31 23:59:59"

_AS_OF_FORMATS = ("%Y%m%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d")


def parse_as_of(value: str | date | datetime) -> datetime:
    """Load date given as ``yyyyMMdd``, ``yyyy-MM-dd[ HH:mm:ss]``, date or datetime."""
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            raise ValueError("a load date has no zone; convert it first")
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    for fmt in _AS_OF_FORMATS:
        try:
            return datetime.strptime(value, fmt)
        except ValueError:
            continue
    raise ValueError(f"not a load date: {value!r}")


def instant_sql(value: str | date | datetime) -> str:
    """Zone-free timestamp literal; a typed literal keeps comparisons pushable."""
    return f"TIMESTAMP_NTZ '{parse_as_of(value).isoformat(sep=' ')}'"


def instant(value: str | date | datetime) -> Column:
    return F.expr(instant_sql(value))


def run_day_midnight() -> Column:
    """Midnight of the day on which the job runs, without a zone."""
    return F.date_trunc("day", F.localtimestamp()).cast("timestamp_ntz")


def us_date(text: Column) -> Column:
    """Parse ``M/d/yyyy``; text that is no such date becomes null."""
    return F.try_to_date(text, US_DATE_FORMAT)


def us_date_from_parts(text: Column) -> Column:
    """The same from the three parts, for text with leading zeros or blanks."""
    part = F.split(text, "/")
    number = [F.trim(F.try_element_at(part, F.lit(i))).try_cast("int") for i in (1, 2, 3)]
    padded = F.format_string("%04d-%02d-%02d", number[2], number[0], number[1])
    whole = (F.size(part) == 3) & number[0].isNotNull() & number[1].isNotNull() & number[2].isNotNull()
    return F.when(whole, padded).try_cast("date")


def month_key(day: Column) -> Column:
    """First day of the month of ``day`` as ``yyyyMMdd`` text."""
    return F.date_format(F.trunc(day, "month"), SAMPLE_DATE_FORMAT)


def slice_key(day: Column) -> Column:
    """Sample date whose slice holds ``day``: the first day of the month after it."""
    return F.date_format(F.add_months(F.trunc(day, "month"), 1), SAMPLE_DATE_FORMAT)


def in_month_before(day: Column, sample_date: str) -> Column:
    """True for days in the month that ends just before ``sample_date``.

    Written as a range on the bare column so that it reaches the file scan.
    """
    last = F.date_add(F.to_date(F.lit(sample_date), SAMPLE_DATE_FORMAT), -1)
    return (day >= F.trunc(last, "month")) & (day <= F.last_day(last))
