"""Recogniser output trees and parallel arrays to word rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _box(vertices: Column) -> dict[str, Column]:
    xs = F.transform(vertices, lambda v: F.coalesce(v["x"].cast("double"), F.lit(0.0)))
    ys = F.transform(vertices, lambda v: F.coalesce(v["y"].cast("double"), F.lit(0.0)))
    return {"x1": F.array_min(xs), "y1": F.array_min(ys), "x2": F.array_max(xs), "y2": F.array_max(ys)}


def _word_text(word: Column) -> Column:
    return F.trim(F.array_join(word["symbols"]["text"], ""))


def _pages(df: DataFrame, key: Sequence[str], pages: str) -> DataFrame:
    """One row per page; a page without blocks falls out later.

    A plain explode would add a filter by the size of the tree, for which a tree made by the same plan is made once more.
    """
    return df.select(*key, F.posexplode_outer(pages).alias("page_ix", "page"))


def explode_annotations(df: DataFrame, key: Sequence[str], pages: str = "pages") -> DataFrame:
    """Tree of pages, blocks, paragraphs, words and symbols to one row per word, numbered in reading order."""
    tree = _pages(df, key, pages)
    tree = tree.select(*key, "page_ix", F.col("page.width").alias("page_width"), F.col("page.height").alias("page_height"), F.posexplode("page.blocks").alias("b", "block"))
    tree = tree.select(*[c for c in tree.columns if c != "block"], F.posexplode("block.paragraphs").alias("p", "paragraph"))
    tree = tree.select(*[c for c in tree.columns if c != "paragraph"], F.posexplode("paragraph.words").alias("w", "word"))
    place = F.col("b").cast("long") * F.lit(10**12) + F.col("p").cast("long") * F.lit(10**6) + F.col("w")
    words = tree.select(
        *key, "page_ix", "page_width", "page_height", place.alias("word_ix"), _word_text(F.col("word")).alias("text"),
        F.coalesce("word.confidence", F.lit(0.0)).alias("confidence"), *[v.alias(k) for k, v in _box(F.col("word.bounding_box.vertices")).items()],
    )
    return words.where(F.col("text") != "")


def explode_paragraphs(df: DataFrame, key: Sequence[str], pages: str = "pages") -> DataFrame:
    """One row per paragraph: joined words, mean word confidence and the box around its words."""
    tree = _pages(df, key, pages).select(*key, "page_ix", F.posexplode("page.blocks").alias("b", "block"))
    tree = tree.select(*key, "page_ix", "b", F.posexplode("block.paragraphs").alias("p", "paragraph"))
    words = F.filter(F.transform("paragraph.words", lambda w: F.struct(_word_text(w).alias("text"), w["confidence"].alias("confidence"), w["bounding_box"]["vertices"].alias("v"))), lambda w: w["text"] != "")
    # A filter by the size of the words would read every symbol twice.
    spoken = F.explode_outer(F.filter(F.array(words), lambda w: F.size(w) > 0))
    rows = tree.select(*key, "page_ix", "b", "p", spoken.alias("words")).where(F.col("words").isNotNull())
    rows = rows.withColumn("corners", F.flatten(F.filter(F.col("words.v"), lambda v: v.isNotNull())))
    total = F.aggregate("words", F.lit(0.0), lambda a, w: a + F.coalesce(w["confidence"], F.lit(0.0)))
    return rows.select(
        *key, "page_ix", (F.col("b").cast("long") * F.lit(10**6) + F.col("p")).alias("line_ix"),
        F.array_join(F.col("words.text"), " ").alias("text"), (total / F.size("words")).alias("confidence"),
        *[v.alias(k) for k, v in _box(F.col("corners")).items()],
    )


def explode_parallel_arrays(
    df: DataFrame, key: Sequence[str], texts: str = "rec_texts", scores: str = "rec_scores", boxes: str = "rec_boxes"
) -> DataFrame:
    """Zipped texts, scores and boxes to rows; a missing score is 0 and a missing box NULL.

    A box is [x1, y1, x2, y2] or a polygon of points.
    """
    kind = dict(df.dtypes)[boxes]
    zipped = df.select(*key, F.posexplode(F.col(texts)).alias("word_ix", "text"), F.col(scores).alias("__s"), F.col(boxes).alias("__b"))
    box = F.get(F.col("__b"), F.col("word_ix"))
    if kind.startswith("array<array<array"):
        xs, ys = F.transform(box, lambda p: p[0]), F.transform(box, lambda p: p[1])
        corners = {"x1": F.array_min(xs), "y1": F.array_min(ys), "x2": F.array_max(xs), "y2": F.array_max(ys)}
    else:
        corners = {c: F.get(box, F.lit(i)) for i, c in enumerate(("x1", "y1", "x2", "y2"))}
    return zipped.select(
        *key, "word_ix", "text", F.coalesce(F.get(F.col("__s"), F.col("word_ix")).cast("double"), F.lit(0.0)).alias("confidence"),
        *[v.cast("double").alias(k) for k, v in corners.items()],
    )


def explode_legacy_lines(df: DataFrame, key: Sequence[str], lines: str = "lines") -> DataFrame:
    """Older layout: array of struct(polygon array<array<double>>, prediction struct<text, score>)."""
    rows = df.select(*key, F.posexplode(lines).alias("word_ix", "l")).where(F.col("l.prediction").isNotNull())
    xs, ys = F.transform("l.polygon", lambda p: p[0]), F.transform("l.polygon", lambda p: p[1])
    return rows.select(
        *key, "word_ix", F.col("l.prediction.text").alias("text"), F.col("l.prediction.score").cast("double").alias("confidence"),
        F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"),
    )
