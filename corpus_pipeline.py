"""A training corpus from ``documents``: quality, boilerplate lines, near-duplicates, benchmark leaks, token ids.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that its predecessor kept; ``run`` writes what a stage
returns and rereads it for the next.  All stages but the last return the columns of ``documents``.

Nulls: null and empty texts pass quality like other texts of no words, have no lines and no leak, count as near-duplicates of one
another and get no token ids.  Rows with a null doc_id are kept by the same rules.  Further columns pass through.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.llm import bpe, decontaminate, lines, quality, simhash
from recordforge.llm.common import table
from recordforge.session import ensure_checkpoint_dir


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts good go on."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites share are cut out of the texts, whatever their share; n_chars follows the text. Documents stay."""
    cleaned = lines.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts and whether decoding gives the text back."""
    path = public_tokenizers.path(bpe.RANKS)
    coded = bpe.both_ways(docs, path)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("round_trip", same).drop("text", "ends", "decoded")


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_boilerplate),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("byte_bpe", token_ids),
]

#: Token ids can't be had from SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
