"""Headered CSV feeds: monthly drop folders in, monthly slices out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starload.functions.names import quoted
from starload.schemas import require_columns, schema_of

# The delimited format, and the file stem of each raw feed.
CSV_FORMAT = {"header": "true", "sep": ",", "quote": '"', "escape": "\\"}
# Fixed value: how exported feeds are compressed; readers know it by the ending of a file.
COMPRESSION = "gzip"
# the writer would trim values unless told not to
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
FEED_STEMS = {
    "customer": "Customers",
    "product": "Products",
    "product_category": "Product_Categories",
    "product_subcategory": "Product_Subcategories",
    "territory": "Territories",
    "sales": "Sales",
}


def feed_path(
    root: str, feed: str, sample_date: str, prefix: str = "snapshot", layout: str = "drops"
) -> str:
    """File or folder of part files of a feed.

    ``drops``: ``root/prefix_date/prefix_Feed_date.csv``; ``slices``, as ``write_slices``
    leaves them: ``root/feed/sample_date=date``.
    """
    if layout == "slices":
        return f"{root}/{feed}/sample_date={sample_date}"
    if layout != "drops":
        raise ValueError(f"unknown layout {layout!r}")
    stem = FEED_STEMS[feed]
    return f"{root}/{prefix}_{sample_date}/{prefix}_{stem}_{sample_date}.csv"


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Read text columns by header name, whatever their order in the file.

    No type inference takes place, and an empty field is null. Every file must carry the
    header of the first one, and a row with more or fewer cells fails the job that reads
    it. ``multi_line`` accepts line breaks inside quotes at the price of files that cannot
    be split.
    """
    return _read_by_name(spark, path, schema, multi_line)


def _read_by_name(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    multi_line: bool,
    by: str | None = None,
    more: Mapping[str, Column] | None = None,
) -> DataFrame:
    # only a reader that parses every cell can tell the width of a row
    strict = {"mode": "FAILFAST", "columnPruning": "false", "multiLine": str(multi_line).lower()}
    reader = spark.read.options(**CSV_FORMAT, **strict)
    header = [name for name in reader.csv(path).columns if name != by]
    names = header + ([by] if by else [])
    as_text = StructType([StructField(name, StringType()) for name in names])
    df = reader.schema(as_text).option("enforceSchema", "false").csv(path)
    require_columns(df, schema.names)
    added = [column.alias(name) for name, column in (more or {}).items()]
    return df.select(*schema.names, *([by] if by else []), *added)


def read_feed(
    spark: SparkSession,
    root: str,
    feed: str,
    sample_date: str,
    prefix: str = "snapshot",
    layout: str = "drops",
    multi_line: bool = False,
) -> DataFrame:
    """Raw feed of one sample date with the declared all-text columns."""
    path = feed_path(root, feed, sample_date, prefix, layout)
    return read_csv(spark, path, schema_of("ods", feed), multi_line)


def read_feed_dates(
    spark: SparkSession,
    root: str,
    feed: str,
    dates: Sequence[str],
    prefix: str = "snapshot",
    layout: str = "drops",
    multi_line: bool = False,
) -> DataFrame:
    """Raw feed of many sample dates in one scan, with the ``sample_date`` of each row."""
    schema, by = schema_of("ods", feed), "sample_date"
    if layout == "slices":
        found = _read_by_name(spark, f"{root}/{feed}", schema, multi_line, by)
        return found.where(F.col(by).isin(list(dates)))
    paths = [feed_path(root, feed, date, prefix, layout) for date in dates]
    stem = FEED_STEMS[feed]
    # a file name holds its date, as part of its own name or of the folder of part files
    named = F.regexp_extract("_metadata.file_path", f"_{stem}_([0-9]{{8}})\\.csv", 1)
    return _read_by_name(spark, paths, schema, multi_line, more={by: named})


def _one_line(df: DataFrame, multi_line: bool, but: str | None = None) -> DataFrame:
    """``df`` whose texts fail the job where they hold a line break, unless that is allowed."""
    if multi_line:
        return df
    message = "a text holds a line break; write and read it with multi_line"
    checked = {
        f.name: F.when(F.contains(F.col(quoted(f.name)), F.lit("\n")) | F.contains(F.col(quoted(f.name)), F.lit("\r")), F.raise_error(F.lit(message))).otherwise(
            F.col(quoted(f.name))
        )
        for f in df.schema.fields
        if isinstance(f.dataType, StringType) and f.name != but
    }
    return df.withColumns(checked) if checked else df


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", multi_line: bool = False, compression: str = "none"
) -> None:
    """Write what ``read_csv`` with the same ``multi_line`` reads back.

    A compressed file is read by one task, so it is for files that one task wrote.
    """
    writer = _one_line(df, multi_line).write.options(**CSV_FORMAT, **_KEEP_BLANKS, compression=compression)
    writer.mode(mode).csv(path)


def write_feed(
    df: DataFrame,
    root: str,
    feed: str,
    sample_date: str,
    prefix: str = "snapshot",
    multi_line: bool = False,
    compression: str = COMPRESSION,
) -> None:
    write_csv(df, feed_path(root, feed, sample_date, prefix), multi_line=multi_line, compression=compression)


def write_slices(
    df: DataFrame,
    path: str,
    by: str = "sample_date",
    multi_line: bool = False,
    gather: bool = True,
    compression: str = "none",
) -> None:
    """All slices in one job, one folder per value of ``by``.

    The rebalance hint gathers a slice into few files and lets adaptive execution
    split a slice that is too large for one task. Without ``gather`` rows are written where
    they are, each task a file for every slice it has rows of: for a stored table with many rows,
    whose tasks are large.
    """
    checked = _one_line(df, multi_line, by)
    (
        (checked.hint("rebalance", F.col(by)) if gather else checked)
        .write.options(**CSV_FORMAT, **_KEEP_BLANKS, compression=compression)
        .partitionBy(by)
        .mode("overwrite")
        .csv(path)
    )


def read_slice(
    spark: SparkSession,
    path: str,
    schema: StructType,
    value: str,
    by: str = "sample_date",
    multi_line: bool = False,
) -> DataFrame:
    return read_csv(spark, f"{path}/{by}={value}", schema, multi_line)


def read_slices(
    spark: SparkSession,
    path: str,
    schema: StructType,
    by: str = "sample_date",
    multi_line: bool = False,
) -> DataFrame:
    """All slices by header name, with the folder value as a text column."""
    return _read_by_name(spark, path, schema, multi_line, by)
