"""Queries of the subpackage and, where SQL can express them, the DuckDB text that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = ("quality", "chat", "html_text", "bpe", "decontaminate", "archives", "language", "lines", "simhash", "topk", "pieces", "negatives", "repair")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register ``function(spark, sf_dir)`` under ``name``."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"recordforge.llm.{module}")
