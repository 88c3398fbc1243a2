"""Queries of the training-data operators, one for each, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: query name -> module of this subpackage
MODULES = {
    "op1_sentencepieces": "sentencepieces",
    "op2_token_files": "token_files",
    "op3_ngram_scores": "ngram",
    "op4_token_counts": "token_counts",
    "op5_decontaminate": "decontaminate",
    "op6_html_text": "html_text",
    "op7_repeats": "repeats",
    "op8_bagminhash": "bagminhash",
    "op9_language": "language",
    "op10_quality": "quality",
    "op11_conversations": "conversations",
    "op12_topk": "topk",
    "op13_fill_middle": "fill_middle",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: import_module(f"leafmill.llm.{module}").query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {}
    for name, module in MODULES.items():
        sql = getattr(import_module(f"leafmill.llm.{module}"), "ORACLE_SQL", None)
        if sql:
            found[name] = sql
    return found
