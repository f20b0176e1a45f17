"""Batch flow: files that are not done yet, their records into the store, and what became of each file."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions.scan import ordered_scan
from recordforge.operators import store as D
from recordforge.sources import files as IO

KEYS = ("source_file", "source_page", "source_record")


@dataclass(frozen=True)
class Batch:
    """Tables after a run: the store, the events of the ledger with those of the run, and the records of the run in order."""

    store: DataFrame
    events: DataFrame
    merged: DataFrame

    def summary(self) -> DataFrame:
        return D.batch_summary(self.store, D.file_ledger(self.events))


def run_batch(
    listing: DataFrame, produced: DataFrame, store: DataFrame, events: DataFrame, batch_id: int, now: str,
    order: Sequence[str], chunk: Sequence[Column], match: Sequence[str] = ("path",),
) -> Batch:
    """Store the records of all listed files that the ledger does not have as done.

    ``listing`` has ``path`` and ``content_hash``; ``produced`` has ``path``, ``error``, ``source_page``, ``source_record``, the columns of
    ``order`` and those of the store; ``events`` has path, content_hash, status, error, batch_id, ts and event_id.  A file with
    an error has failed as a whole: none of its records is stored, and the next run takes it again.  Records without a page are on
    page 1, those without a number are numbered in order.  A record that is stored already is replaced and keeps its ``created_at``.
    """
    todo = IO.skip_done(listing, D.file_ledger(events), ("DONE",), match).select("path", "content_hash")
    rows = produced.join(todo.select("path"), "path", "left_semi")
    failed = rows.where(F.col("error").isNotNull()).groupBy("path").agg(F.min("error").alias("error"))
    good = rows.where(F.col("error").isNull()).join(failed.select("path"), "path", "left_anti")
    numbered = ordered_scan(good, ["path"], order, chunk, index="__ix")
    kept = [c for c in store.columns if c not in (*KEYS, "batch_id", "created_at", "updated_at")]
    moment = F.lit(now)
    new = numbered.select(
        F.col("path").alias("source_file"), F.coalesce("source_page", F.lit(1)).cast("int").alias("source_page"), F.coalesce(F.col("source_record").cast("long"), F.col("__ix")).alias("source_record"),
        *kept, F.lit(batch_id).alias("batch_id"), moment.alias("created_at"), moment.alias("updated_at"), *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
    )
    stored = D.upsert(store, new, list(KEYS), [f"__o{i}" for i in range(len(order))])
    outcome = todo.join(failed, "path", "left").select(
        "path", "content_hash", F.when(F.col("error").isNull(), "DONE").otherwise("FAILED").alias("status"), "error", F.lit(batch_id).alias("batch_id"), moment.alias("ts"), F.lit(batch_id).alias("event_id")
    )
    merged = stored.where(F.col("batch_id") == batch_id).orderBy(*KEYS)
    return Batch(stored, events.unionByName(outcome.select(*events.columns)), merged)
