"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text becomes a vector of transformed statistics (logarithms of sizes and of smoothed shares).  The statistics
of the labelled documents give both classes a mean and a covariance, shrunk towards the pooled covariance and its diagonal;
counts, means and central moments are one distributed aggregate, so the fit uses every labelled row and only moments reach the driver.
A score is the logistic of the difference of the two Gaussian log-densities: Mahalanobis distances with the inverted Cholesky
factors, which are computed once and kept in the model, plus log-determinants and log-priors.

Nulls: a null or empty text has the statistics of zero words and is scored like any other.  Rows with a null doc_id are
scored and never used for the fit.  Repeated label rows count once (contradicting ones not at all), repeated documents each.
With fewer than two classes among the labels all scores are 0.5, hence predicted 1.  Columns named like the results are
replaced; all other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.llm.common import saved, table
from recordforge.llm.registry import query

STATISTICS = (
    "chars word_length letters upper digits symbols loud stops distinct repeats lines line_repeats marked capitals"
).split()
SYMBOLS = b"#$%&*+<=>@\\^_`{|}~[]/"
LOUD = b"!?"
STOPS = b".,;:"


def _share(part: float, whole: float, usual: float, weight: float) -> float:
    """Share on a logarithmic scale; ``weight`` units of the usual share are added, so that short texts are no outliers."""
    return math.log(0.002 + (part + usual * weight) / (whole + weight))


_TABLES = {
    "letters": bytes(b for b in range(128) if not chr(b).isalpha()),
    "upper": bytes(b for b in range(256) if not 65 <= b <= 90),
    "digits": bytes(b for b in range(256) if not 48 <= b <= 57),
    "symbols": bytes(b for b in range(256) if b not in SYMBOLS),
    "loud": bytes(b for b in range(256) if b not in LOUD),
    "stops": bytes(b for b in range(256) if b not in STOPS),
}
_MARKED = re.compile(rb"[#$%&*!?|=~^<>]{2,}|\s\|\s")


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``STATISTICS``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = len(raw)
    count = {name: len(raw.translate(None, table)) for name, table in _TABLES.items()}
    words = raw.split()
    n = len(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    distinct = len(set(words))
    return [
        math.log1p(size),
        math.log((size + 6.5 * 20) / (n + 20)),
        _share(count["letters"], size, 0.8, 100),
        _share(count["upper"], size, 0.01, 100),
        _share(count["digits"], size, 0.002, 100),
        _share(count["symbols"], size, 0.001, 100),
        _share(count["loud"], size, 0.001, 100),
        _share(count["stops"], size, 0.02, 100),
        math.log(distinct + 15) - 0.8 * math.log(n + 20),
        _share(same, n, 0.01, 20),
        math.log1p(len(lines)),
        _share(len(lines) - len(set(lines)), len(lines), 0.03, 8),
        _share(len(_MARKED.findall(raw)), n, 0.001, 20),
        _share(sum(map(bytes.isupper, words)), n, 0.005, 20),
    ]


def measured(df: DataFrame, text: str = "text", out: str = "x") -> DataFrame:
    """``df`` with the array<double> ``out``: the statistics of its whole texts."""

    @F.pandas_udf("array<double>")
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([statistics(t) for t in batch], dtype=object)

    return df.withColumn(out, of_texts(F.col(text)))


@dataclass(frozen=True)
class Discriminant:
    """Means, inverses of the Cholesky factors and constants of class 0 and class 1."""

    means: np.ndarray
    inverses: np.ndarray
    constants: np.ndarray

    @classmethod
    def fit(cls, counts: np.ndarray, means: np.ndarray, scatter: np.ndarray, pooled_share: float = 0.3, diagonal_share: float = 0.1) -> Discriminant | None:
        """From counts, means and sums of outer products about the means of both classes; None unless both have rows."""
        if (counts < 1).any():
            return None
        width = means.shape[1]
        pooled = scatter.sum(axis=0) / max(counts.sum() - 2, 1)
        floor = 1e-4 * np.eye(width)
        inverses, constants = [], []
        for n, s in zip(counts, scatter, strict=True):
            # Small classes lean on the pooled covariance; both lean a little on their diagonal.
            alpha = (pooled_share * 50 + width) / (pooled_share * 50 + width + n)
            covariance = (1 - alpha) * s / max(n - 1, 1) + alpha * pooled
            covariance = (1 - diagonal_share) * covariance + diagonal_share * np.diag(np.diag(covariance)) + floor
            factor = np.linalg.cholesky(covariance)
            inverses.append(np.linalg.inv(factor))
            constants.append(math.log((n + 1) / (counts.sum() + 2)) - np.log(np.diag(factor)).sum())
        return cls(means, np.stack(inverses), np.array(constants))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row."""
        logs = []
        for mean, inverse, constant in zip(self.means, self.inverses, self.constants, strict=True):
            z = inverse @ (x - mean).T
            logs.append(constant - 0.5 * (z**2).sum(axis=0))
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -500, 500)))


def train(rows: DataFrame, x: str = "x", label: str = "label") -> Discriminant | None:
    """Fit on rows (x array<double>, label 0 or 1): one aggregate of counts, means and central moments."""
    width = len(STATISTICS)
    items = [F.col(x)[i] for i in range(width)]
    means = [F.avg(v).alias(f"m{i}") for i, v in enumerate(items)]
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    moments = [F.covar_pop(items[i], items[j]).alias(f"c{i}_{j}") for i, j in pairs]
    found = {r["label"]: r for r in rows.where(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"), *means, *moments).collect()}
    if len(found) < 2:
        return None
    scatter = np.zeros((2, width, width))
    for c in (0, 1):
        for i, j in pairs:
            scatter[c, i, j] = scatter[c, j, i] = found[c]["n"] * found[c][f"c{i}_{j}"]
    return Discriminant.fit(np.array([found[c]["n"] for c in (0, 1)], dtype=float), np.array([[found[c][f"m{i}"] for i in range(width)] for c in (0, 1)]), scatter)


def scored(rows: DataFrame, model: Discriminant | None, x: str = "x") -> DataFrame:
    """``rows`` with ``score`` and ``predicted`` in place of ``x``."""
    score = quality_score(model, x)
    return rows.withColumn("score", score).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)).drop(x)


def quality_score(model: Discriminant | None, x: str) -> F.Column:
    """Score column of the statistics ``x``."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def of_rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.score(np.stack(batch.to_numpy()))) if len(batch) else pd.Series([], dtype=float)

    return of_rows(F.col(x))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(rows: DataFrame, labels: DataFrame) -> Discriminant | None:
    """Fit on the rows (doc_id, x) that ``labels`` marks and that are not held out."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
    known = known.where("label = other").select("doc_id", "label")
    return train(rows.where(~held_out()).join(known, "doc_id").select("x", "label"))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, fitted on its labelled rows that are not held out."""
    rows = saved(measured(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", held_out().alias("held_out"), "x"))
    return scored(rows, fit(rows, labels))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted good, as they are.

    Texts are measured twice, for the fit and for the decision: they then need neither be moved nor written.
    """
    model = fit(measured(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "x"), labels)

    @F.pandas_udf("boolean")
    def good(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Measured and scored in one worker.
        for batch in texts:
            yield pd.Series(model.score(np.array([statistics(t) for t in batch])) >= 0.5 if len(batch) else [], dtype=bool)

    return docs.where(good(F.col(text))) if model is not None else docs


@query("op1_quality_qda")
def op1_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
