from __future__ import annotations

import zlib

import numpy as np

from recordforge.llm import quality

SCHEMA = "doc_id long, text string, score string"
GOOD = "The river ran down to the sea and the town slept. Nobody was on the road."


def _docs(spark):
    rows = [(i, f"{GOOD} Number {i} of the series came late.", "kept") for i in range(120)]
    rows += [(i, " ".join(["$$$ spam!!"] * (5 + i % 7)), "kept") for i in range(120, 200)]
    rows += [(200, None, "x"), (201, "", "x"), (None, GOOD, "x"), (5, f"{GOOD} Number 5 of the series came late.", "kept"), (202, "word " * 50_000, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def _labels(spark, rows=None):
    rows = [(i, int(i < 120), 0) for i in range(200)] + [(3, 1, 0), (7, 0, 0), (None, 1, 0), (9, None, 0)] if rows is None else rows
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_scores_follow_the_labels(spark):
    rows = quality.classify(_docs(spark), _labels(spark)).collect()
    assert len(rows) == 205
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        if r["doc_id"] is not None and r["doc_id"] < 200:
            assert r["predicted"] == int(r["doc_id"] < 120)
    assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1


def test_held_out_labels_are_not_learned(spark):
    flipped = [(i, int(i < 120) if zlib.crc32(str(i).encode()) % 3 != 1 else int(i >= 120), 0) for i in range(200)]
    a = {tuple(r) for r in quality.classify(_docs(spark), _labels(spark, [(i, int(i < 120), 0) for i in range(200)])).collect()}
    b = {tuple(r) for r in quality.classify(_docs(spark), _labels(spark, flipped)).collect()}
    assert a == b


def test_fit_equals_direct_moments(spark):
    x = np.random.default_rng(1).normal(size=(60, len(quality.STATISTICS)))
    y = np.arange(60) % 2
    x[y == 1] += 1
    model = quality.train(spark.createDataFrame([(r.tolist(), int(c)) for r, c in zip(x, y)], "x array<double>, label int"))
    assert np.allclose(model.means, [x[y == 0].mean(axis=0), x[y == 1].mean(axis=0)])
    # The shrunk covariances and the scores, computed plainly.
    n, width = 30, x.shape[1]
    within = [np.cov(x[y == c].T) for c in (0, 1)]
    pooled = ((n - 1) * within[0] + (n - 1) * within[1]) / (2 * n - 2)
    alpha = (15 + width) / (15 + width + n)
    logs = []
    for c in (0, 1):
        cov = (1 - alpha) * within[c] + alpha * pooled
        cov = 0.9 * cov + 0.1 * np.diag(np.diag(cov)) + 1e-4 * np.eye(width)
        assert np.allclose(np.linalg.inv(model.inverses[c].T @ model.inverses[c]), cov)
        d = x - x[y == c].mean(axis=0)
        logs.append(np.log(31 / 62) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_moments_of_far_values_keep_their_digits(spark):
    x = np.random.default_rng(2).normal(size=(40, len(quality.STATISTICS)))
    y = np.arange(40) % 2
    rows = lambda shift: spark.createDataFrame([((r + shift).tolist(), int(c)) for r, c in zip(x, y)], "x array<double>, label int")
    near, far = quality.train(rows(0.0)), quality.train(rows(1e6))
    assert np.allclose(near.inverses, far.inverses, rtol=1e-4)


def test_without_classes_and_without_rows(spark):
    docs = _docs(spark)
    assert {r["score"] for r in quality.classify(docs, _labels(spark, [(1, 1, 0)])).collect()} == {0.5}
    assert quality.classify(docs.limit(0), _labels(spark, [])).count() == 0
    kept = quality.keep_good(docs, _labels(spark))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.where("doc_id < 200").collect()} == set(range(120))
