"""The registered queries of the training-data operators and, where SQL can express them, their oracles."""

from __future__ import annotations

import importlib

import corpus_pipeline

MODULES = [
    "warc_derivatives", "language_id", "suffix_dedup", "vector_search", "chat_format", "byte_bpe", "simhash_dedup", "exact_dedup", "packing", "url_filter",
    "secret_scan", "vector_codes", "filter_audit",
]


def _collect(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(importlib.import_module(f"riskloom.llm.{name}"), attribute)
    return found


def queries() -> dict:
    return _collect("QUERIES") | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    return _collect("ORACLE") | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
