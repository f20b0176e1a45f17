"""Restartable runs: new files only, keyed upserts, rolling status counters, failure isolation.

Keyed state is Spark's: a streaming aggregation holds the newest row of every key in the state store, versioned by the
checkpoint, so a run that starts again goes on where the last one stopped.  The store grows with the keys; a cluster sets
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider, so that it lies on disk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def incremental_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", **options: str) -> DataFrame:
    """File stream; together with a checkpoint each file is read once, also over restarts."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything that is there now through ``sink`` and stop."""
    query = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_sink(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Write a micro-batch to its own folder; a repeated batch replaces itself."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return sink


# ---------------------------------------------------------------- keyed state


def once(stream: DataFrame, event_id: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop events whose id was seen within ``delay`` of event time, and events later than that.

    The watermark bounds the ids that are held.  Choose the longest delay with which an event may arrive.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(event_id))


def newest_rows(stream: DataFrame, keys: Sequence[str], order: Sequence[str], created: str | None = None) -> DataFrame:
    """Newest row of every key by the order columns, held by Spark's state; in update mode each micro-batch gives the changed keys.

    Late and repeated rows lose by their order columns, which are total within a key.  ``created`` keeps the value of the
    key's first row in that order.
    """
    place = F.struct(*order)
    rest = [c for c in stream.columns if c not in keys]
    row = F.max_by(F.struct(*rest), place).alias("__row")
    first = [F.min_by(F.struct(created), place).alias("__first")] if created else []
    held = stream.groupBy(*keys).agg(row, *first)
    value = lambda c: F.col("__first")[c] if c == created else F.col("__row")[c]
    return held.select(*[F.col(c) if c in keys else value(c).alias(c) for c in stream.columns])


def table_sink(path: str, keys: Sequence[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """Replace the rows of the keys of a micro-batch in a table of hash buckets; only touched buckets are read and rewritten.

    A micro-batch holds the whole newest row of each key it has, so a repeated one replaces rows by themselves.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Read three times; a lost block is computed again from the state.
        new = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r[0] for r in new.select("bucket").distinct().collect()]
            held = read_table(spark, path, batch.schema, partitions=True).where(F.col("bucket").isin(touched))
            same = [F.col(f"__old.{k}").eqNullSafe(F.col(f"__new.{k}")) for k in ("bucket", *keys)]
            kept = held.alias("__old").join(new.select("bucket", *keys).alias("__new"), same, "left_anti")
            after = kept.select(*new.columns).unionByName(new).repartition("bucket", *keys)
            after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        finally:
            new.unpersist()

    return sink


def read_table(spark: SparkSession, path: str, schema: T.StructType, partitions: bool = False) -> DataFrame:
    """The table that ``table_sink`` writes; empty before its first micro-batch."""
    whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    try:
        rows = spark.read.schema(whole).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], whole)
    return rows if partitions else rows.drop("bucket")


def run_keyed(changes: DataFrame, path: str, keys: Sequence[str], checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Bring the table at ``path`` up to date with what ``newest_rows`` gives for everything that is there now, and stop."""
    return run_available(changes, table_sink(path, keys, buckets), checkpoint, mode="update")


def status_counters(state: DataFrame, batch: Sequence[str], status: str = "status") -> DataFrame:
    """Counters per batch from the newest status of every key."""
    return state.groupBy(*batch).agg(
        F.count_if(F.col(status) == "OK").cast("long").alias("ok_records"), F.count_if(F.col(status) != "OK").cast("long").alias("review_records")
    )


def isolate_failures(df: DataFrame, error: str | Column) -> tuple[DataFrame, DataFrame]:
    """Rows without and with an error; a bad row never stops the others."""
    column = F.col(error) if isinstance(error, str) else error
    failed = F.coalesce(column, F.lit("")) != ""
    return df.where(~failed), df.where(failed)


def failure_report(df: DataFrame, group: Sequence[str], error: str) -> DataFrame:
    """Good and failed rows per group; a group with both is a partial failure."""
    failed = F.coalesce(F.col(error), F.lit("")) != ""
    counted = df.groupBy(*group).agg(F.count_if(~failed).alias("good_rows"), F.count_if(failed).alias("failed_rows"))
    outcome = F.when(F.col("failed_rows") == 0, "success").when(F.col("good_rows") == 0, "failed").otherwise("partial")
    return counted.withColumn("outcome", outcome)
