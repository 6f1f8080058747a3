"""The registered queries of the text operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: module -> query
_MODULES = {
    "decontamination": "op1_decontamination",
    "quality": "op2_quality_cascade",
    "toxicity": "op3_toxicity_fm",
    "suffix_dedup": "op4_suffix_dedup",
    "bpe": "op5_byte_bpe",
    "language": "op6_language_mixture",
    "lm": "op7_lm_scores",
    "sharding": "op8_hilbert_sharding",
    "secrets": "op9_secret_scan",
    "jaccard": "op10_jaccard_join",
    "mixing": "op11_source_mix",
    "conversations": "op12_conversation_repair",
    "resampling": "op13_importance_resampling",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"framespan.llm.{module}"), name) for module, name in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"framespan.llm.{module}"), "ORACLE_SQL", None) for module, name in _MODULES.items()}
    return {name: sql for name, sql in found.items() if sql}
