"""Reading and writing record tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordforge.functions import text as T
from recordforge.functions.scan import ordered_scan
from recordforge.operators.export import dedupe_by_row
from recordforge.schemas import EXPORT_FIELDS, RECORD, STATUS_ALIAS
from recordforge.session import cut


def parse_records(rows: DataFrame) -> DataFrame:
    """Exported text rows (header or field names) to typed records; bad numbers become NULL."""
    by_field = {f: h for h, f in EXPORT_FIELDS.items()}
    types = {f.name: f.dataType.simpleString() for f in RECORD.fields}

    def column(field: str) -> Column:
        headers = [by_field[field], field] + ([STATUS_ALIAS] if field == "status_review" else [])
        present = [F.col(f"`{h}`").cast("string") for h in headers if h in rows.columns]
        text = T.blank_to_null(T.strip(F.coalesce(*present))) if present else F.lit(None).cast("string")
        kind = types[field]
        if kind == "int":
            number = text.try_cast("double")
            return F.when(F.abs(number) < F.lit(2.0**31), number.cast("int")).alias(field)
        if kind == "double":
            return text.try_cast("double").alias(field)
        if kind.startswith("array"):
            parts = F.filter(F.transform(F.split(text, ";"), T.strip), lambda p: p != "")
            return F.coalesce(parts, F.array().cast("array<string>")).alias(field)
        return text.alias(field)

    return rows.select(*[column(f) for f in types])


def read_records(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Records from exported CSV or JSON files."""
    if fmt == "csv":
        rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    elif fmt == "json":
        rows = spark.read.json(path)
    elif fmt == "parquet":
        rows = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")
    return parse_records(rows)


def _existing(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    try:
        reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        found = reader.csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    except AnalysisException:
        return None
    return found if found.columns else None


def write_records(
    df: DataFrame, path: str, mode: str = "append", columns: Sequence[str] | None = None, order: Sequence[str] | None = None, fmt: str = "parquet"
) -> None:
    """Write rows with ``reset`` (replace) or ``append`` (only rows that are not there yet).

    Appending adds files; rows already written are never rewritten, and the commit protocol
    of the writer makes the new files visible at once.
    """
    if mode not in ("append", "reset"):
        raise ValueError(f"unknown mode: {mode}")
    cols = list(columns or df.columns)
    out = df.select(*cols)
    if mode == "append":
        out = dedupe_by_row(out, _existing(df.sparkSession, path, fmt), cols, list(order or cols))
    writer = out.write.mode("overwrite" if mode == "reset" else "append")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


@dataclass(frozen=True)
class WriteSummary:
    """Rows of an append, counted by the jobs that read and wrote them."""

    written_count: int
    skipped_duplicates: int
    total_rows: int


def append_rows(df: DataFrame, path: str, columns: Sequence[str] | None = None, order: Sequence[str] | None = None, buckets: int = 64) -> WriteSummary:
    """Append the rows that a table in buckets of the row hash does not hold yet; rows of blanks only are never skipped.

    Only buckets that get a new row are read, and only files are added, which the commit of the writer makes visible at once.  What
    was written is observed on the write itself.  One writer at a time: two that append the same row both write it.
    """
    spark, cols = df.sparkSession, list(columns or df.columns)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    key = F.to_json(F.array(*texts))
    blank = F.concat(*texts) == ""
    # Repeats within the new rows meet in one aggregate; blank rows keep their number and their NULLs.
    kinds = F.when(blank, F.to_json(F.array(*[F.col(c).isNull() for c in cols]))).otherwise("")
    dealt = df.withColumns({"__key": key, "__kind": kinds, "bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")})
    place = F.struct(*(order or cols))
    firsts = cut(dealt.groupBy("bucket", "__key", "__kind").agg(F.min_by(F.struct(*cols), place).alias("__row"), F.count(F.lit(1)).alias("__n")))
    touched = {r["bucket"]: r["n"] for r in firsts.groupBy("bucket").agg(F.sum("__n").alias("n")).collect()}
    there = _table(spark, path)
    before, fresh = 0, firsts
    if there is not None:
        before = there.count()
        known = there.where(F.col("bucket").isin(list(touched))).select("bucket", key.alias("__key"), F.lit("").alias("__kind"))
        fresh = firsts.join(known, ["bucket", "__key", "__kind"], "left_anti")
    copies = F.when(F.col("__kind") == "", F.lit(1).cast("long")).otherwise(F.col("__n"))
    written = Observation("written")
    rows = fresh.select("__row.*", "bucket", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("__copy")).drop("__copy")
    rows.repartition("bucket").observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append").partitionBy("bucket").parquet(path)
    done, offered = written.get["rows"], sum(touched.values())
    return WriteSummary(done, offered - done, before + done)


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        # A folder without a file has no schema yet.
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def part_numbers(df: DataFrame, n: int, order: Sequence[str], chunk: Sequence[Column], prefix: str = "part") -> DataFrame:
    """Number of the file of exactly ``n`` rows each row belongs to."""
    if n <= 0:
        raise ValueError("rows per file must be positive")
    if not prefix.strip():
        raise ValueError("prefix must not be empty")
    placed = ordered_scan(df, [], order, chunk, index="__pos")
    number = F.floor((F.col("__pos") - 1) / n).cast("long") + 1
    digits = number.cast("string")
    name = F.concat(F.lit(f"{prefix}_"), F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0")))
    return placed.withColumns({"part_no": number, "part": name}).drop("__pos")


def write_parts(df: DataFrame, path: str, n: int, order: Sequence[str], chunk: Sequence[Column], prefix: str = "part") -> None:
    """Files of exactly ``n`` rows in order, one folder per part."""
    parts = part_numbers(df, n, order, chunk, prefix).drop("part_no")
    parts.repartition("part").sortWithinPartitions("part", *order).write.mode("overwrite").option("header", True).partitionBy("part").csv(path)


def write_ordered_csv(df: DataFrame, path: str, order: Sequence[str], chunk_rows: int = 100_000) -> None:
    """Ordered CSV with a header, at most ``chunk_rows`` rows per file; an empty table leaves the header."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).option("maxRecordsPerFile", chunk_rows).csv(path)


def write_sidecars(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Nested sidecar columns as JSON lines instead of one file per record."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def load_store(rows: DataFrame, raw: str = "raw_record", order: Sequence[str] = ("source_file", "source_page", "source_record", "id")) -> DataFrame:
    """Stored JSON records back to columns, in (file, page, record, id) order; unknown keys are dropped."""
    return rows.select(*order, F.from_json(raw, RECORD).alias("record")).orderBy(*order)
