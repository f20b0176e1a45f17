from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from recordforge.llm import negatives

from .tools_check import compare


def _brute(rows, k_pos=5, k_neg=5, least=80, most=100):
    usable = []
    for i, v, lab in rows:
        if i is None or v is None or lab is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, lab, [math.floor(256 * x) for x in v]))
    anchors = {}
    for i, lab, v in usable:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (lab, v)), (lab, v))
    out = []
    for a, (lab, v) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, l2) for i, l2, w in usable if i != a and len(w) == len(v)]
        for ps, p, _ in sorted(r for r in scored if r[2] == lab)[:k_pos]:
            fit = sorted(r for r in scored if r[2] != lab and least * -ps <= 100 * -r[0] <= most * -ps)[:k_neg]
            out += [(a, p, n + 1, i, -ps, -s) for n, (s, i, _) in enumerate(fit)]
    return sorted(out)


def _rows(seed=2, n=700):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 20))
    rows = []
    for i in range(n):
        v = (centres[i % 4] + 0.6 * rng.normal(size=20)) * (0.02 if i % 50 == 7 else 0.3)
        # One label for a third of the rows; one vector for many of them.
        rows.append((i, centres[0].tolist() if i % 9 == 0 else v.tolist(), 0 if i % 3 == 0 else i % 5))
    rows += [(None, [0.5] * 20, 1), (800, None, 1), (900, [0.5] * 20, None), (1000, [math.nan] * 20, 1), (1001, [math.inf] + [0.0] * 19, 1), (1002, [None] * 20, 2)]
    rows += [(1100, [1.0, 2.0], 1), (1101, [2.0, 1.0], 1), (1102, [1.5, 1.0], 2), (1200, [], 1), (1201, [], 2), (1300, [0.0] * 20, 3), (1301, [0.0] * 20, 3)]
    # Repeated rows, an anchor on two rows, negative scores only.
    rows += [rows[5], rows[5], rows[100], (200, [0.1] * 20, 4), (1400, [-9.0, 0.0, 0.0], 6), (1401, [9.0, 0.0, 0.0], 6), (1402, [8.0, 0.0, 0.0], 7)]
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame([(i, v, lab, "x", 1.5) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, rank string, score double")
    for group, shard, side in ((8192, 16384, 1024), (3, 90, 7)):
        monkeypatch.setattr(negatives, "GROUP", group)
        monkeypatch.setattr(negatives, "SHARD", shard)
        monkeypatch.setattr(negatives, "SIDE", side)
        found = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(tuple(r) for r in found.collect()) == _brute(rows)
    other = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, positives=3, negatives=2, least=33, most=97)
    assert sorted(tuple(r) for r in other.collect()) == _brute(rows, 3, 2, 33, 97)


def test_bounds_hold_and_get_closer():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-300, 300, (20, 50)), rng.integers(-300, 300, (30, 50))
    sides = [negatives.Side(np.arange(len(x)), np.zeros(len(x)), x, negatives.summaries(x)) for x in (a, b)]
    exact, before = a @ b.T, None
    for level in range(len(negatives.LEVELS)):
        mean, spread = (x @ y.T for x, y in zip(sides[0].levels[level], sides[1].levels[level], strict=True))
        assert (mean + spread + 1e-6 >= exact).all() and (mean - spread - 1e-6 <= exact).all()
        assert before is None or spread.mean() <= before
        before = spread.mean()


def test_pooling_equals_direct_statistics():
    rng = np.random.default_rng(4)
    for width in (0, 3, 16, 50, 64):
        x = rng.normal(size=(9, width))
        m, s = negatives.pooled(negatives.summaries(x), width, 16)
        if width:
            assert np.allclose(m[:, 0], x.mean(axis=1) * math.sqrt(width)) and np.allclose(s[:, 0], x.std(axis=1) * math.sqrt(width))
        assert m.shape == (9, 1)


def test_bounds_spare_exact_scores():
    rng = np.random.default_rng(5)
    # Vectors that are constant over segments, up to a little noise, in many directions.
    base = np.repeat(rng.normal(size=(3000, 16)) * 100, 4, axis=1) + rng.normal(size=(3000, 64)) * 3
    v = np.floor(base).astype(np.int64)
    labels = rng.integers(0, 5, 3000)
    side = lambda at: negatives.Side(at, labels[at], v[at], negatives.summaries(v[at]))
    anchors = side(np.arange(0, 3000, 100))
    wanted = negatives.Wanted(anchors, np.full((30, 1), negatives.LOWEST + 1), np.full((30, 1), negatives.HIGHEST), True, 5)
    wanted.offer(side(np.arange(3000)))
    pairs = sum((labels == labels[a]).sum() - 1 for a in range(0, 3000, 100))
    assert wanted.computed < pairs / 4


def test_large_components_stay_exact():
    v = np.array([[3_000_000_001, 5], [2_999_999_999, 7], [1, 1]], dtype=np.int64)
    side = negatives.Side(np.arange(3), np.zeros(3), v, negatives.summaries(v))
    rows, cols = np.array([0, 0, 1]), np.array([1, 2, 2])
    assert negatives.exact_scores(side, side, rows, cols).tolist() == [3_000_000_001 * 2_999_999_999 + 35, 3_000_000_006, 3_000_000_006]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0


def test_query_against_sql(spark, sf_dir):
    import duckdb

    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    compare(spark, duck, "op12_hard_negatives", sf_dir)
