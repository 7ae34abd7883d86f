"""The registered queries of this subpackage and the SQL some are compared with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

# Modules that define ``query(spark, sf)`` and, where SQL can express it, ``ORACLE_SQL``.
MODULES = {
    "op5_suffix_dedup": "suffix",
    "op8_katz_scores": "katz",
    "op3_language_id": "langid",
    "op6_html_main_text": "html_main",
    "op1_minhash_near_dedup": "neardup",
    "op7_decontaminate": "decontaminate",
    "op2_token_packing": "packing",
    "op4_mix_sources": "mixing",
    "op9_license_scan": "licenses",
    "op10_quality_rules": "quality",
    "op11_whitening": "whitening",
    "op12_centroid_clusters": "clustering",
    "op13_chat_formatting": "chat",
}


def _modules():
    return {name: import_module(f"tallyguard.llm.{module}") for name, module in MODULES.items()}


def queries() -> dict[str, Query]:
    import corpus_pipeline

    found = {name: module.query for name, module in _modules().items()}
    return {**found, "pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    import corpus_pipeline

    found = {name: getattr(module, "ORACLE_SQL", None) for name, module in _modules().items()}
    found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {name: sql for name, sql in found.items() if sql}
