"""Document listings, ledgers and names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.functions.scan import ordered_scan

# Readable document kinds, and characters a flat name may not hold.
DOCUMENT_EXTENSIONS = (".pdf", ".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp", ".webp")
UNSAFE_CHARS = "[^A-Za-z0-9._-]+"
SUCCESS_STATUSES = ("SUCCESS", "SUCCESS_WITH_RETRY")


def list_documents(spark: SparkSession, path: str, exts: Sequence[str] = DOCUMENT_EXTENSIONS, recursive: bool = True) -> DataFrame:
    """Files below a path with an allowed extension, in path order; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return supported_documents(files, exts=exts).select("path", "length", "modificationTime").orderBy("path")


def supported_documents(files: DataFrame, path: str = "path", exts: Sequence[str] = DOCUMENT_EXTENSIONS) -> DataFrame:
    """Rows of a listing whose path has an allowed extension, in any case."""
    suffix = F.lower(F.regexp_extract(path, "(\\.[^./]+)$", 1))
    return files.where(suffix.isin([e.lower() for e in exts]))


def require_documents(files: DataFrame) -> DataFrame:
    """The listing itself, or an error when it is empty (runs a job that stops at the first row)."""
    if files.isEmpty():
        raise FileNotFoundError("no supported documents found")
    return files


def content_hash(df: DataFrame, col: str, out: str = "content_hash") -> DataFrame:
    return df.withColumn(out, F.sha2(F.col(col).cast("binary"), 256))


def skip_done(files: DataFrame, ledger: DataFrame, done_statuses: Sequence[str], match: Sequence[str] = ("path",)) -> DataFrame:
    """Files the ledger does not list as done; match on path and hash to read changed files again."""
    done = ledger.where(F.col("status").isin(list(done_statuses))).select(*match)
    return files.join(done, list(match), "left_anti")


def unique_names(df: DataFrame, name: str, order: Sequence[str], chunk: Sequence[Column], out: str = "unique_name") -> DataFrame:
    """The n-th repeat of a name gets ``_n`` before its extension."""
    placed = ordered_scan(df, [name], order, chunk, index="__ix")
    stem = F.regexp_extract(name, "^(.+?)(\\.[^.]*)?$", 1)
    suffix = F.regexp_extract(name, "^(.+?)(\\.[^.]*)?$", 2)
    renamed = F.concat(stem, F.lit("_"), (F.col("__ix") - 1).cast("string"), suffix)
    return placed.withColumn(out, F.when(F.col("__ix") == 1, F.col(name)).otherwise(renamed)).drop("__ix")


def safe_names(df: DataFrame, path_col: str, page: str | None = None, pages: str | None = None, out: str = "safe_name") -> DataFrame:
    """Path to a flat name: extension off, unsafe characters to ``_``, parts joined by ``__``.

    Pages of a PDF or of a document with several pages are numbered from 1 (``page`` is 0-based).
    """
    plain = F.regexp_replace(F.col(path_col), "(?<=[^/])\\.[^./]+$", "")

    def clean(part: Column) -> Column:
        kept = F.btrim(F.regexp_replace(part, UNSAFE_CHARS, "_"), F.lit("._"))
        return F.when(kept == "", F.lit("page")).otherwise(kept)

    parts = F.filter(F.split(plain, "/"), lambda p: p != "")
    stem = F.array_join(F.transform(parts, clean), "__")
    stem = F.when(stem == "", F.lit("page")).otherwise(stem)
    if page is not None:
        several = F.lower(path_col).endswith(".pdf")
        if pages is not None:
            several = several | (F.col(pages) > 1)
        number = (F.col(page) + 1).cast("string")
        stem = F.when(several, F.concat(stem, F.lit("_page_"), F.lpad(number, F.greatest(F.lit(3), F.length(number)), F.lit("0")))).otherwise(stem)
    return df.withColumn(out, stem)
