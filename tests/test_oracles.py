"""Every registered query against its DuckDB text on the smallest tables."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from recordforge.fixtures import TABLES  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in entry.EXTRA_QUERIES])
def test_query(name, spark, duck, sf_dir):
    ok, message = check.compare(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name), sf_dir)
    assert ok, message


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_optional_subpackage(tmp_path, pipeline):
    """A copy without the folders of the optional subpackage still has all other queries."""
    ignored = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(os.path.join(ROOT, "recordforge"), tmp_path / "recordforge", ignore=ignored)
    (tmp_path / "recordforge/llm/__pycache__").mkdir(parents=True)
    for name in ("__spark_entry__.py", "corpus_pipeline.py") if pipeline else ("__spark_entry__.py",):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), e.EXTRA_QUERIES, len(e.oracle_sql()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, timeout=300)
    plain = len(entry.queries()) - len(entry.EXTRA_QUERIES)
    assert found.stdout.split() == [str(plain), "{}", str(len(entry.oracle_sql()) - len(entry.EXTRA_ORACLES))]


def test_queries_without_sql_are_known():
    plain = set(entry.queries()) - set(entry.EXTRA_QUERIES)
    assert plain - set(entry.oracle_sql()) == {"flow_ledger_records", "flow_typed_results"}


def test_entry(spark):
    assert entry.entry(spark).columns == ["status", "records"]
    assert entry.entry(spark).count() > 0
