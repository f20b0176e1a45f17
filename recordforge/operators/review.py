"""Human review: overlay of corrections, labels, search, edits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions import text as T
from recordforge.functions.scan import latest, ordered_scan

# Where a cell label falls back to when neither a correction nor a reading exists.
LABEL_FALLBACKS = {
    "bil": ("raw_bil", "bil"), "suami_isteri": ("raw_suami_isteri",), "pendaftar": ("raw_pendaftar",), "wali": ("raw_wali",),
    "hubungan_wali": ("raw_hubungan_wali",), "saksi": ("raw_saksi",),
    "tarikh_nikah": ("raw_tarikh_nikah", "tarikh_nikah_raw", "tarikh_nikah"),
    "tarikh_keluar": ("raw_tarikh_keluar", "tarikh_keluar_raw", "tarikh_keluar"), "remarks": ("raw_remarks", "remarks"),
}


def overlay(validated: DataFrame, corrections: DataFrame, key: Sequence[str]) -> DataFrame:
    """A corrected record replaces the validated one as a whole; without one nothing is verified.

    ``corrections`` has the record columns and may have ``verified`` (absent in bare records),
    ``reviewed_at``, ``reviewed_by`` and ``review_notes``.
    """
    notes = ("reviewed_at", "reviewed_by", "review_notes")
    shared = [c for c in validated.columns if c not in key and c in corrections.columns and c not in ("verified", *notes)]
    verified = F.coalesce("verified", F.lit(False)) if "verified" in corrections.columns else F.lit(False)
    side = corrections.select(
        *key, F.lit(True).alias("__hit"), verified.alias("__verified"), *[F.col(c).alias(f"__{c}") for c in shared],
        *[(F.nullif(F.trim(n), F.lit("")) if n in corrections.columns else F.lit(None).cast("string")).alias(f"__{n}") for n in notes],
    )
    joined = validated.join(side, list(key), "left")
    hit = F.coalesce("__hit", F.lit(False))
    cols = [F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in shared else F.col(c) for c in validated.columns]
    return joined.select(
        *cols, hit.alias("corrected"), F.coalesce("__verified", F.lit(False)).alias("verified"), *[F.col(f"__{n}").alias(n) for n in notes]
    )


def label_text(column: Column) -> Column:
    """Label with one kind of line break and no blanks at line ends; NULL when empty."""
    text = F.regexp_replace(column, "\\r\\n?", "\n")
    text = F.regexp_replace(text, "[^\\S\\n]+(?=\\n|$)", "")
    return T.blank_to_null(T.strip(text))


def cell_labels(records: DataFrame, cells: DataFrame, corrections: DataFrame, key: Sequence[str], fallbacks=LABEL_FALLBACKS) -> DataFrame:
    """One label per record and cell: corrected, else read, else taken from the record."""
    pairs = [
        F.struct(F.lit(cell).alias("cell"), F.coalesce(*[T.blank_to_null(F.col(c)) for c in cols]).alias("text")) for cell, cols in fallbacks.items()
    ]
    spare = records.select(*key, F.inline(F.array(*pairs))).withColumn("priority", F.lit(2))
    read = cells.select(*key, "cell", "text").withColumn("priority", F.lit(1))
    fixed = corrections.select(*key, "cell", "text").withColumn("priority", F.lit(0))
    every = fixed.unionByName(read).unionByName(spare).withColumn("label", label_text(F.col("text"))).where(F.col("label").isNotNull())
    best = latest(every.select(*key, "cell", "label", "priority"), [*key, "cell"], ["priority", "label"], first=True)
    return best.select(*key, "cell", "label", (F.col("priority") == 0).alias("corrected_label"))


def bundle_order(df: DataFrame, file: str = "source_file", page: str = "source_page", record: str = "source_record") -> DataFrame:
    return df.orderBy(F.coalesce(file, F.lit("")), F.coalesce(page, F.lit(0)), record)


def search(
    df: DataFrame, statuses: Sequence[str] = (), verified: bool | None = None, text: str = "", fields: Sequence[str] = (), status: str = "status_review"
) -> DataFrame:
    """Filter by status list, verified flag and a case-insensitive substring of the joined fields."""
    if statuses:
        df = df.where(F.col(status).isin(list(statuses)))
    if verified is not None:
        df = df.where(F.col("verified") == verified)
    needle = text.strip().lower()
    if needle:
        joined = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]))
        df = df.where(joined.contains(needle))
    return df


def review_metrics(df: DataFrame, status: str = "status_review") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(status) != "OK").alias("needs_review"),
        F.count_if(F.col("corrected")).alias("corrected"),
        F.count_if(F.col("verified")).alias("verified"),
    )


def positional_patch(
    rows: DataFrame, edits: DataFrame, start: int, editable: Sequence[str], order: Sequence[str], chunk: Sequence[Column], edit_ix: str = "edit_ix"
) -> DataFrame:
    """Edited row k replaces the editable columns of row start + k; edits past the end are ignored."""
    placed = ordered_scan(rows, [], order, chunk, index="__pos")
    changes = edits.select((F.col(edit_ix) + start + 1).alias("__pos"), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in editable])
    joined = placed.join(changes, "__pos", "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in editable else F.col(c) for c in rows.columns])


def preview(df: DataFrame, columns: Sequence[str], order: Sequence[str], start: int = 0, n: int = 200) -> DataFrame:
    """One page of rows; Spark plans it as a top-(start + n) instead of a full sort."""
    return df.select(*columns).orderBy(*order).offset(start).limit(n)


def preferred_source(original: DataFrame, corrected: DataFrame, batch: Sequence[str], reset: bool = False) -> DataFrame:
    """Corrected rows of batches that have some, original rows of the others; ``reset`` drops the corrections."""
    if reset:
        return original.withColumn("row_source", F.lit("original"))
    touched = corrected.select(*batch).distinct()
    untouched = original.join(touched, list(batch), "left_anti").withColumn("row_source", F.lit("original"))
    return untouched.unionByName(corrected.withColumn("row_source", F.lit("corrected")))


def apply_edits(
    df: DataFrame, edits: DataFrame, key: Sequence[str], ints: Sequence[str] = (), reasons: str = "review_reason", status: str = "status_review"
) -> DataFrame:
    """Bulk edits as text columns: blank becomes NULL, integers are strict, reasons come one per line."""
    texts = [c for c in edits.columns if c not in (*key, reasons, status)]
    out: list[Column] = [F.lit(True).alias("__hit")]
    for c in texts:
        value = T.blank_to_null(T.strip(F.col(c)))
        if c in ints:
            wrong = F.raise_error(F.concat(F.lit("invalid integer value: "), value)).cast("int")
            value = F.when(value.isNull(), F.lit(None).cast("int")).when(value.rlike("^[+-]?\\d+$"), value.cast("int")).otherwise(wrong)
        out.append(value.alias(f"__{c}"))
    if reasons in edits.columns:
        lines = F.filter(F.transform(T.raw_lines(F.col(reasons)), T.strip), lambda l: l != "")
        out.append(lines.alias(f"__{reasons}"))
        texts.append(reasons)
    if status in edits.columns:
        out.append(F.col(status).alias(f"__{status}"))
        texts.append(status)
    joined = df.join(edits.select(*key, *out), list(key), "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns])


def export_reviewed(bundles: DataFrame, verified_only: bool = False) -> DataFrame:
    """Active records, optionally only the verified ones."""
    return bundles.where(F.col("verified")) if verified_only else bundles
