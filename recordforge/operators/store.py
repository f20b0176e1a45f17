"""Record store on plain tables: upsert, status counters, ledgers, queues and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions.scan import latest, ordered_scan

# Columns of the export projection.
EXPORT_COLUMNS = (
    "id", "source_file", "source_page", "source_record", "status", "confidence", "bil", "nama_suami", "nama_isteri",
    "tarikh_nikah", "mas_kahwin", "wali", "review_reason", "created_at", "updated_at",
)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str], created: str = "created_at") -> DataFrame:
    """Source rows replace target rows of the same key; the last source row wins and ``created`` is kept."""
    newest = latest(source, keys, order).drop(*[o for o in order if o not in target.columns])
    values = [c for c in target.columns if c not in keys]
    incoming = newest.select(*keys, F.lit(True).alias("__new"), *[F.col(c).alias(f"__{c}") for c in values])
    joined = target.withColumn("__old", F.lit(True)).join(incoming, list(keys), "full_outer")
    fresh = F.coalesce("__new", F.lit(False))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c == created:
            out.append(F.coalesce(F.col(c), F.col(f"__{c}")).alias(c))
        else:
            out.append(F.when(fresh, F.col(f"__{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def status_transitions(
    events: DataFrame, key: Sequence[str], order: Sequence[str], batch: Sequence[str], chunk: Sequence[Column], status: str = "status"
) -> DataFrame:
    """Counter changes per batch: +1 for the new bucket and -1 for the old one when a status changes.

    A key that holds a large part of all events is split into chunks.
    """
    slim = events.select(*dict.fromkeys([*key, *order, *batch, status]))
    moved = ordered_scan(slim, key, order, chunk, lag={"__before": F.col(status)})
    changed = moved.where(~F.col("__before").eqNullSafe(F.col(status)))
    bucket = lambda c: F.when(F.col(c) == "OK", "ok").otherwise("review")
    deltas = F.array(
        F.struct(bucket(status).alias("bucket"), F.lit(1).alias("delta")),
        F.when(F.col("__before").isNotNull(), F.struct(bucket("__before").alias("bucket"), F.lit(-1).alias("delta"))),
    )
    return (
        changed.select(*batch, F.inline(F.array_compact(deltas)))
        .groupBy(*batch)
        .agg(*[F.sum(F.when(F.col("bucket") == b, F.col("delta")).otherwise(0)).alias(f"{b}_records") for b in ("ok", "review")])
    )


def file_ledger(events: DataFrame, path: str = "path", order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Latest state per path; an error is kept only while the file has failed."""
    last = latest(events, [path], list(order))
    return last.withColumn("error", F.when(F.col("status") == "FAILED", F.col("error")))


def batch_summary(records: DataFrame, ledger: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Totals per batch derived from the rows themselves, newest batch first."""
    files = ledger.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("status") == "DONE").alias("processed_files"),
        F.count_if(F.col("status") == "FAILED").alias("failed_files"),
    )
    rows = records.groupBy(batch).agg(
        F.count_if(F.col("status") == "OK").alias("ok_records"), F.count_if(F.col("status") != "OK").alias("review_records")
    )
    joined = files.join(rows, batch, "full_outer")
    return joined.na.fill(0).orderBy(F.col(batch).desc())


def status_report(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """Counts by status for records and for files with a total row each, largest first."""

    def counted(df: DataFrame, kind: str) -> DataFrame:
        return df.rollup("status").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(kind).alias("kind"), F.coalesce("status", F.lit("TOTAL")).alias("status"), "rows"
        )

    return counted(records, "records").unionByName(counted(ledger, "files")).orderBy("kind", F.col("rows").desc(), "status")


def review_queue(records: DataFrame, columns: Sequence[str], order: Sequence[str] = ("id",)) -> DataFrame:
    return records.where(F.col("status") == "REVIEW").select(*columns).orderBy(*order)


def export_projection(records: DataFrame, columns: Sequence[str] = EXPORT_COLUMNS, order: Sequence[str] = ("id",)) -> DataFrame:
    """Projection of the store in id order; ``wali`` is filled from ``nama_wali`` where it has no own column."""
    df = records
    if "wali" in columns and "wali" not in df.columns and "nama_wali" in df.columns:
        df = df.withColumn("wali", F.col("nama_wali"))
    return df.select(*columns).orderBy(*order)


def job_log(events: DataFrame, outputs: DataFrame | None = None, job: str = "job_id", order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Latest metadata per job, newest first; with ``outputs`` only jobs that have one."""
    last = latest(events, [job], list(order))
    if outputs is not None:
        last = last.join(outputs.select(job), job, "left_semi")
    return last.orderBy(F.col("created_at").desc(), F.col(job).desc())
