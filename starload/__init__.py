"""Batch loading of a dimensional warehouse with Spark DataFrames."""

from starload.functions.fingerprint import row_hash, row_text
from starload.operators.backfill import scd2_backfill
from starload.operators.fingerprinted import scd2_merge_fingerprinted, with_fingerprint
from starload.operators.keys import assign_surrogate_keys, max_key
from starload.operators.lookup import flatten_snowflake, lookup, lookup_surrogates, one_row_per_key
from starload.operators.scd2 import Scd2Result, Scd2Spec, check_columns, scd2_merge
from starload.operators.slicing import referenced_rows, sample_dates, slice_by_month, slice_month
from starload.operators.standardize import retype, standardize
from starload.operators.summarize import auto_summarize, default_policy, merge_summaries, partial_summary
from starload.plans.jobs import (
    Warehouse,
    backfill_dimension,
    backfill_months,
    load_dimension,
    read_report,
    run_month,
    store_report,
)
from starload.schemas import conform, empty_table, require_columns, schema_of
from starload.session import session_builder
from starload.sources.csv_checked import read_split, read_versions

__all__ = [
    "Scd2Result",
    "Scd2Spec",
    "Warehouse",
    "assign_surrogate_keys",
    "auto_summarize",
    "backfill_dimension",
    "backfill_months",
    "check_columns",
    "conform",
    "default_policy",
    "empty_table",
    "flatten_snowflake",
    "load_dimension",
    "lookup",
    "lookup_surrogates",
    "max_key",
    "merge_summaries",
    "one_row_per_key",
    "partial_summary",
    "read_report",
    "read_split",
    "read_versions",
    "referenced_rows",
    "require_columns",
    "retype",
    "row_hash",
    "row_text",
    "run_month",
    "sample_dates",
    "scd2_backfill",
    "scd2_merge",
    "scd2_merge_fingerprinted",
    "schema_of",
    "session_builder",
    "slice_by_month",
    "slice_month",
    "standardize",
    "store_report",
    "with_fingerprint",
]
