"""Shaping and de-duplication of exported rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from recordforge.functions import text as T
from recordforge.functions.scan import latest
from recordforge.schemas import EXPORT_FIELDS, PUBLIC_COLUMNS, PUBLIC_CSV_COLUMNS, STATUS_ALIAS, TYPED_CSV_COLUMNS


def resolve_columns(configured: Sequence[str] | None = None, include_raw: bool = True) -> tuple[list[str], list[str]]:
    """Visible and hidden headers; unknown or empty configurations are errors."""
    if configured is None:
        visible = list(EXPORT_FIELDS) if include_raw else list(PUBLIC_COLUMNS)
    else:
        if isinstance(configured, (str, bytes)):
            raise ValueError("columns must be a sequence of column names")
        visible = list(dict.fromkeys(c.strip() for c in map(str, configured) if c.strip()))
        unknown = [c for c in visible if c not in EXPORT_FIELDS and c != STATUS_ALIAS]
        if unknown:
            raise ValueError(f"unsupported export column: {unknown[0]}")
        if not visible:
            raise ValueError("columns must contain at least one column")
    return visible, [c for c in EXPORT_FIELDS if c not in visible]


def project_columns(df: DataFrame, configured: Sequence[str] | None = None, include_raw: bool = True, hidden: bool = True) -> DataFrame:
    """Records under their headers, visible columns first; columns a table lacks are NULL."""
    visible, rest = resolve_columns(configured, include_raw)
    headers = visible + rest if hidden else visible

    def column(header: str) -> Column:
        field = "status_review" if header == STATUS_ALIAS else EXPORT_FIELDS[header]
        if field not in df.columns:
            return F.lit(None).cast("string").alias(header)
        value = F.col(field)
        if field == "review_reason" and dict(df.dtypes)[field].startswith("array"):
            value = F.array_join(value, "; ")
        return value.alias(header)

    return df.select(*[column(h) for h in headers])


def source_key(file: str = "source_file", page: str = "source_page", record: str = "source_record", folder: str | None = "crop_folder") -> Column:
    """Key of a row by its source, else by its crop folder, else NULL."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    has_page = filled(page) & (F.col(page).cast("string") != "0")
    text = lambda *cs: F.to_json(F.array(*[c if isinstance(c, Column) else F.col(c).cast("string") for c in cs]))
    key = F.when(filled(file) & has_page & filled(record), text(F.lit("source"), file, page, record))
    if folder:
        key = key.when(filled(folder) & filled(record), text(F.lit("crop"), folder, record))
    return key


def _dedupe(new: DataFrame, existing: DataFrame | None, key: Column, existing_key: Column | None, order: Sequence[str]) -> DataFrame:
    """First new row per key that is not there yet; rows without a key always stay."""
    keyed = new.withColumn("__key", key)
    loose = keyed.where(F.col("__key").isNull()).drop("__key")
    firsts = latest(keyed.where(F.col("__key").isNotNull()), ["__key"], list(order), first=True)
    if existing is not None:
        known = existing.select((existing_key if existing_key is not None else key).alias("__key")).where(F.col("__key").isNotNull())
        firsts = firsts.join(known, "__key", "left_anti")
    return firsts.select(*new.columns).unionByName(loose)


def dedupe_by_source(new: DataFrame, existing: DataFrame | None, order: Sequence[str], folder: str | None = "crop_folder") -> DataFrame:
    """Skip rows whose source (or crop folder) is already exported, and repeats within the new rows."""
    return _dedupe(new, existing, source_key(folder=folder), None, order)


def dedupe_by_row(new: DataFrame, existing: DataFrame | None, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Skip rows whose public values are all already exported; all-blank rows are never skipped.

    The key is the full text of the values, so two different rows never share one.
    """
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    blank = F.concat(*texts) == ""
    return _dedupe(new, existing, F.when(~blank, F.to_json(F.array(*texts))), None, order)


def stamp(df: DataFrame, now: Column | str) -> DataFrame:
    """Creation time is kept, update time is now; reasons become one text; ``status`` repeats the review status."""
    moment = F.lit(now) if isinstance(now, str) else now
    reasons = F.array_join("review_reason", "; ")
    return df.withColumns(
        {
            "created_at": F.coalesce(T.blank_to_null(F.col("created_at")), moment),
            "updated_at": moment,
            "review_reason_text": reasons,
            "status": F.col("status_review"),
        }
    )


def observe_export(new: DataFrame, kept: DataFrame, name: str = "export") -> tuple[DataFrame, Observation, DataFrame, Observation]:
    """Attach counters to the offered and to the written rows; they are filled by the write itself."""
    offered, written = Observation(f"{name}_offered"), Observation(f"{name}_written")
    return (
        new.observe(offered, F.count(F.lit(1)).alias("rows")), offered,
        kept.observe(written, F.count(F.lit(1)).alias("rows")), written,
    )


def export_counts(new: DataFrame, kept: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Written, skipped and total rows as a one-row table."""
    tables = [("offered", new), ("written", kept)] + ([("before", existing)] if existing is not None else [])
    sizes = None
    for kind, table in tables:
        # Counted where they are; only one number per table travels.
        size = table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        sizes = size if sizes is None else sizes.unionByName(size)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    return sizes.agg(
        of("written").alias("written_count"), (of("offered") - of("written")).alias("skipped_duplicates"), (of("before") + of("written")).alias("total_rows")
    )


_TYPED_FIELDS = {
    **{h: EXPORT_FIELDS[h] for h in TYPED_CSV_COLUMNS if h in EXPORT_FIELDS},
    "Processing Status": "processing_status", "Review Required": "review_required", "Failed Fields": "failed_fields",
    "Retry Count": "retry_count", "Error Message": "error_message",
}


def typed_rows(results: DataFrame, existing: DataFrame | None = None, order: Sequence[str] = ("processed_at",)) -> DataFrame:
    """The 24 text columns of the typed form, latest row per source file, in case-insensitive order."""
    types = dict(results.dtypes)

    def value(header: str) -> Column:
        field = _TYPED_FIELDS[header]
        if field not in types:
            return F.lit("").alias(header)
        column = F.array_join(field, "; ") if types[field].startswith("array") else F.col(field).cast("string")
        return F.coalesce(column, F.lit("")).alias(header)

    # A rank, of which each task keeps its first rows before the shuffle: unlike in a packed row, columns nobody reads later don't travel.
    place = F.row_number().over(Window.partitionBy("source_file").orderBy(*[F.desc(c) for c in order]))
    newest = results.withColumn("__place", place).where(F.col("__place") == 1).select(*[value(h) for h in TYPED_CSV_COLUMNS])
    if existing is not None:
        # Columns an older file lacks are read as empty text.
        old = existing.select(*[F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(h) if h in existing.columns else F.lit("").alias(h) for h in TYPED_CSV_COLUMNS])
        newest = newest.unionByName(old.join(newest.select("Source File"), "Source File", "left_anti"))
    return newest.orderBy(F.lower("Source File"), "Source File")


__all__ = [
    "PUBLIC_CSV_COLUMNS", "dedupe_by_row", "dedupe_by_source", "export_counts", "observe_export", "project_columns",
    "resolve_columns", "source_key", "stamp", "typed_rows",
]
