"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starload.llm.bpe import op8_bpe
from starload.llm.class_lm import op2_class_lm
from starload.llm.decontaminate import OP12_SQL, op12_decontaminate
from starload.llm.filter_audit import OP13_SQL, op13_filter_audit
from starload.llm.infilling import OP11_SQL, op11_fill_in_middle
from starload.llm.langid import op10_language
from starload.llm.main_text import op5_main_text
from starload.llm.mixing import OP7_SQL, op7_mixing
from starload.llm.near_copies import op6_near_copies
from starload.llm.posting_lists import op3_posting_lists
from starload.llm.quality_rules import op9_quality_rules
from starload.llm.sharding import op1_sharding
from starload.llm.site_quality import op4_quality_classifier

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_class_lm": op2_class_lm,
    "op3_posting_lists": op3_posting_lists,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_main_text": op5_main_text,
    "op6_near_copies": op6_near_copies,
    "op7_mixing": op7_mixing,
    "op8_bpe": op8_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_language": op10_language,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_decontaminate": op12_decontaminate,
    "op13_filter_audit": op13_filter_audit,
}
ORACLE: dict[str, str] = {
    "op7_mixing": OP7_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_decontaminate": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
