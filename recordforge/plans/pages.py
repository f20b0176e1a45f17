"""Words to a status report: reading order, page text, normalisation, a check, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.functions import text as T
from recordforge.operators import validate, words

LOW_CONFIDENCE = 0.75


def page_texts(tokens: DataFrame, key: Sequence[str]) -> DataFrame:
    """Normalised text of every page with its confidence."""
    pages = words.text_of_lines(words.text_lines_px(tokens, key), key)
    return pages.select(*key, T.normalise_text(F.col("text")).alias("text"), "avg_conf", F.size("lines").alias("n_lines"))


def page_status(tokens: DataFrame, key: Sequence[str]) -> DataFrame:
    texts = page_texts(tokens, key)
    status = F.when(F.col("text") == "", "FAILED_OCR").when(F.col("avg_conf") < LOW_CONFIDENCE, "REVIEW").otherwise("OK")
    return texts.withColumn("status", status)


def page_status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.status_counts(page_status(fixtures.view(spark, sf_dir, "fx_words"), ["doc_id"]))
