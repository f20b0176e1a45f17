"""Holds a registered query against its SQL, where it has one."""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check  # noqa: E402
from recordforge.llm import registry  # noqa: E402


def compare(spark, duck, name, sf_dir):
    if name in registry.ORACLES:
        ok, message = check.compare(spark, duck, name, registry.QUERIES[name], registry.ORACLES[name], sf_dir)
        assert ok, message
    else:
        assert registry.QUERIES[name](spark, sf_dir).count() > 0
