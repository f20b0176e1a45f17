from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from recordforge.llm import topk


def _brute(rows, k):
    whole = {}
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, v in usable:
        if i % 50 == 0:
            whole[i] = min(whole.get(i, v), v)
    out = set()
    for q, v in whole.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def test_against_brute_force_with_ties_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    common = rng.normal(size=16).tolist()
    rows = [(i, (common if i % 3 == 0 else rng.normal(size=16).tolist())) for i in range(400)]
    rows += [(None, common), (1000, None), (1001, [None] * 16), (1002, [math.nan] * 16), (1003, [math.inf] + [0.0] * 15), (1050, [1.0, 2.0]), (1100, [3.0, -4.0]), (1150, [])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int")
    for group, shard in ((8192, 16384), (3, 50)):
        monkeypatch.setattr(topk, "GROUP", group)
        monkeypatch.setattr(topk, "SHARD", shard)
        found = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert {tuple(r) for r in found.collect()} == _brute(rows, 5)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-300, 300, (20, 50)), rng.integers(-300, 300, (30, 50))
    exact, before = topk.scores(a, b), None
    for segments in topk.SEGMENTS:
        bound = topk.segment_statistics(a, segments) @ topk.segment_statistics(b, segments).T
        assert (bound + 1e-6 >= exact).all()
        assert before is None or bound.mean() <= before
        before = bound.mean()


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert topk.top_k(df, F.col("vec_id") % 50 == 0).count() == 0
