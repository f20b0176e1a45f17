"""Examples for recogniser training from reviewed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions.scan import ordered_scan

MANIFEST_COLUMNS = (
    "image_path", "label_text", "cell_name", "dataset_split", "verified", "used_corrected_label", "reviewed_at", "reviewed_by",
    "review_notes", "source_file", "source_page", "source_record", "record_dir",
)


def _offered(bundles: DataFrame, images: DataFrame, labels: DataFrame, key: Sequence[str], verified_only: bool) -> DataFrame:
    """Cells with an image of the usable records, with their label where there is one."""
    usable = bundles.where(F.col("verified")) if verified_only else bundles
    texts = labels.select(*key, "cell", F.trim("label").alias("label_text"), F.col("corrected_label").alias("used_corrected_label"))
    return images.join(usable, list(key)).join(texts, [*key, "cell"], "left").withColumn(
        "has_label", F.coalesce(F.col("label_text") != "", F.lit(False))
    )


def training_examples(bundles: DataFrame, images: DataFrame, labels: DataFrame, key: Sequence[str], verified_only: bool = True) -> DataFrame:
    """One row per cell with an image and a label that is not blank."""
    return _offered(bundles, images, labels, key, verified_only).where(F.col("has_label")).drop("has_label")


def skipped_counts(bundles: DataFrame, images: DataFrame, labels: DataFrame, key: Sequence[str], verified_only: bool = True) -> DataFrame:
    """Records left out because nobody verified them, and cells left out because their label is blank."""
    none = F.lit(False)
    skipped = bundles.select((~F.col("verified") if verified_only else none).alias("record"), none.alias("label"))
    empty = _offered(bundles, images, labels, key, verified_only).select(none.alias("record"), (~F.col("has_label")).alias("label"))
    return skipped.unionByName(empty).agg(
        F.count_if("record").alias("skipped_unverified_records"), F.count_if("label").alias("skipped_empty_labels")
    )


def hash_split(df: DataFrame, key_cols: Sequence[str], ratio: float, out: str = "dataset_split") -> DataFrame:
    """Deterministic split by the hash of the record key; a record is never divided."""
    if ratio <= 0.0:
        return df.withColumn(out, F.lit("train"))
    if ratio >= 1.0:
        return df.withColumn(out, F.lit("val"))
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    bucket = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") / F.lit(float(0xFFFFFFFF))
    return df.withColumn(out, F.when(bucket < ratio, "val").otherwise("train"))


def number_examples(examples: DataFrame, order: Sequence[str], chunk: Sequence[Column], suffix: str = ".jpg") -> DataFrame:
    """Running number over all examples and the image path made of it.

    The whole table is one group, so it is numbered chunk by chunk.
    """
    numbered = ordered_scan(examples, [], order, chunk, index="example_no")
    name = F.concat(F.lpad(F.col("example_no").cast("string"), F.greatest(F.lit(6), F.length(F.col("example_no").cast("string"))), F.lit("0")), F.lit(suffix))
    return numbered.withColumn("image_path", F.concat(F.lit("crops/"), F.col("cell"), F.lit("/"), name))


def escape_text(column: Column) -> Column:
    escaped = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(escaped, F.lit("\t"), F.lit("\\t")), F.lit("\n"), F.lit("\\n"))


def escape_tsv(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, escape_text(F.col(col)))


def label_lines(examples: DataFrame) -> DataFrame:
    """One tab-separated line per example."""
    return examples.select("*", F.concat(F.col("image_path"), F.lit("\t"), escape_text(F.col("label_text"))).alias("line"))


def manifest(examples: DataFrame) -> DataFrame:
    """One JSON object with thirteen keys per example; missing values stay as null."""
    named = examples.withColumnRenamed("cell", "cell_name") if "cell_name" not in examples.columns else examples
    missing = {c: F.lit(None).cast("string") for c in MANIFEST_COLUMNS if c not in named.columns}
    full = named.withColumns(missing) if missing else named
    return full.select(F.to_json(F.struct(*MANIFEST_COLUMNS), {"ignoreNullFields": "false"}).alias("value"))


def training_stats(examples: DataFrame, split: str = "dataset_split", cell: str = "cell") -> DataFrame:
    """Examples per split, per cell and in total, in one pass."""
    return examples.cube(split, cell).agg(F.count(F.lit(1)).alias("examples")).select(
        F.coalesce(split, F.lit("ALL")).alias(split), F.coalesce(cell, F.lit("ALL")).alias(cell), "examples"
    )
