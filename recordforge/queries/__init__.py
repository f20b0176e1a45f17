"""Registered queries: a Spark callable and the DuckDB text that must give the same rows."""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordforge import fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SECTIONS = (
    "words",
    "geometry",
    "normalize",
    "extract",
    "candidates",
    "reconcile",
    "validate",
    "sequence",
    "store",
    "review",
    "export",
    "training",
    "scans",
    "incremental",
    "flows",
)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` may name fixture views, which are inlined."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = fixtures.oracle(oracle)
        return function

    return register


def load_all() -> None:
    for section in SECTIONS:
        name = f"recordforge.queries.{section}"
        if importlib.util.find_spec(name):
            importlib.import_module(name)
