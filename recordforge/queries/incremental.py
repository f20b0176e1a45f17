"""Streaming runs over the given tables; their results equal those of the batch operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.operators import reconcile as M
from recordforge.queries import query
from recordforge.queries.reconcile import PAYLOADS
from recordforge.queries.store import TRANSITIONS
from recordforge.session import ensure_checkpoint_dir, stored
from recordforge.sources import records
from recordforge.streaming import incremental as S


def _work(spark: SparkSession, name: str) -> str:
    """New folder for one run below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # The glob names exactly one given table; a file source wants a folder or a pattern.
    return S.incremental_files(spark, f"{sf_dir.rstrip('/')}/{name}.parquet*", fixtures.table(spark, sf_dir, name).schema)


@query("s1_incremental_files", "select event_id, event_type, user_id from events")
def s1_incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _work(spark, "s1")
    stream = _stream(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    # The second run finds nothing new.
    for _ in range(2):
        S.run_available(stream, S.append_sink(f"{work}/out"), f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out").select("event_id", "event_type", "user_id")


def _drops(rows: DataFrame, work: str, deal: str, repeated: str) -> Iterator[DataFrame]:
    """Write ``rows`` to a landing folder in three drops, dealt regardless of their order; some come again with the last one.

    Yields the stream over the folder after each drop.
    """
    for k in range(3):
        due = F.pmod(F.col(deal), F.lit(3)) == k
        if k == 2:
            due = due | (F.pmod(F.col(repeated), F.lit(7)) == 0)
        rows.where(due).write.mode("append").parquet(f"{work}/in")
        yield S.incremental_files(rows.sparkSession, f"{work}/in", rows.schema)


@query(
    "s2_upsert_stream",
    "select o_custkey as source_file, o_orderpriority as source_record, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as status, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey, min(o_orderdate) as created_at from orders group by 1, 2",
)
def s2_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, keys = _work(spark, "s2"), ["source_file", "source_record"]
    orders = fixtures.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("source_file"), F.col("o_orderpriority").alias("source_record"), F.col("o_orderstatus").alias("status"), "o_orderkey", "o_orderdate",
        F.col("o_orderdate").alias("created_at"),
    )
    # Each run is a restart from the checkpoint.
    for stream in _drops(orders, work, "o_orderkey", "o_orderkey"):
        S.run_keyed(S.newest_rows(stream, keys, ["o_orderdate", "o_orderkey"], "created_at"), f"{work}/out", keys, f"{work}/checkpoint")
    return S.read_table(spark, f"{work}/out", orders.schema).drop("o_orderdate")


@query("s3_isolate_failures", "select rec, case when rec%6=5 or rec%24=0 then 'bad' else 'good' end as side from fx_responses")
def s3_isolate_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = fixtures.sql(spark, sf_dir, PAYLOADS.format(n="'\\n'"))
    # Both sides read the responses, which are parsed once.
    parsed = stored(M.parse_responses(payloads, "payload", "k bigint", ["rec"]).select("rec", "parse_error"))
    good, bad = S.isolate_failures(parsed, "parse_error")
    return good.select("rec", F.lit("good").alias("side")).unionByName(bad.select("rec", F.lit("bad").alias("side")))


@query(
    "s3_failure_report",
    "select user_id, count_if(event_type<>'error') as good_rows, count_if(event_type='error') as failed_rows, case when count_if(event_type='error')=0 then 'success' when count_if(event_type<>'error')=0 then 'failed' else 'partial' end as outcome from events group by 1",
)
def s3_failure_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.sql(spark, sf_dir, "select user_id, case when event_type='error' then 'boom' end as error from events")
    return S.failure_report(events, ["user_id"], "error")


@query(
    "s4_status_stream",
    f"""with {TRANSITIONS}, c as (select batch_id, case when status='OK' then 1 else 0 end - case when p='OK' then 1 else 0 end as ok, case when status<>'OK' then 1 else 0 end - case when p<>'OK' then 1 else 0 end as rv
 from t where status is distinct from p) select batch_id, cast(sum(ok) as bigint) as ok_records, cast(sum(rv) as bigint) as review_records from c group by 1""",
)
def s4_status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = _work(spark, "s4")
    events = fixtures.view(spark, sf_dir, "fx_status_events").withColumn("ts", F.col("ts").cast("timestamp"))
    for stream in _drops(events, work, "event_id", "event_id"):
        # The drops cross each other in time: an event may be as late as the table is long, a month.
        fresh = S.once(stream, ["event_id"], "ts", "40 days")
        S.run_keyed(S.newest_rows(fresh, ["rec_key"], ["ts", "event_id"]), f"{work}/out", ["rec_key"], f"{work}/checkpoint")
    return S.status_counters(S.read_table(spark, f"{work}/out", events.schema), ["batch_id"])


# ---------------------------------------------------------------- sinks, read back from the shared folder


@query("io9_write_records", "select distinct l_orderkey, l_linenumber, l_returnflag, l_linestatus from lineitem")
def io9_write_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{_work(spark, 'io9')}/out"
    rows = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    # The second append adds nothing.
    for mode in ("reset", "append"):
        records.write_records(rows.distinct() if mode == "reset" else rows, out, mode)
    return spark.read.parquet(out)


@query("io11_write_ordered_csv", "select o_orderkey, o_orderstatus, o_orderpriority from orders")
def io11_write_ordered_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{_work(spark, 'io11')}/out"
    rows = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    records.write_ordered_csv(rows, out, ["o_orderkey"])
    return spark.read.schema(rows.schema).option("header", True).csv(out)


@query("io12_write_sidecars", "select doc_id, text as raw_text, lang, n_chars from documents")
def io12_write_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{_work(spark, 'io12')}/out"
    docs = fixtures.table(spark, sf_dir, "documents")
    nested = docs.select("doc_id", F.struct("text").alias("raw"), F.struct("lang", "n_chars").alias("validated"))
    records.write_sidecars(nested, out)
    return spark.read.schema(nested.schema).json(out).select("doc_id", F.col("raw.text").alias("raw_text"), "validated.lang", "validated.n_chars")
