"""Registered queries of this subpackage: one ``opN_<name>`` for each operator
and ``pipeline``, each over its whole table, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ["quality", "decontaminate", "secrets", "sentencepiece_bpe", "records", "language", "html_text", "jaccard_join", "suffix_dedup", "pseudo_likelihood",
           "simhash_join", "hard_negatives", "vector_codes"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {}
    for name in MODULES:
        module = importlib.import_module(f"affinity.llm.{name}")
        found[module.QUERY] = module.query
    import corpus_pipeline

    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {}
    for name in MODULES:
        module = importlib.import_module(f"affinity.llm.{name}")
        if module.ORACLE_SQL:
            found[module.QUERY] = module.ORACLE_SQL
    return found
