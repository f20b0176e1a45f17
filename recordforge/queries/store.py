"""Store queries on derived records and status events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.functions.scan import steps
from recordforge.operators import store as D
from recordforge.queries import query

KEYS = ["source_file", "source_page", "source_record"]
TARGET = "select source_file, source_page, source_record, status, confidence, batch_id, 't0' as created_at, 't0' as updated_at from fx_records where source_record%3<>0"
# Every second key comes twice; the row with the larger sequence number must win.
SOURCE = """select source_file, source_page, source_record, case when s=1 then 'REVIEW' else 'OK' end as status, confidence/2+s as confidence, batch_id, 't1' as created_at, 't'||cast(s as {s}) as updated_at, s as seq
 from fx_records {explode} where source_record%2=0"""


@query(
    "d1_upsert",
    f"""with t as ({TARGET}), s as (select * from ({SOURCE.format(s='varchar', explode='cross join (values (1), (2)) as z(s)')}) where seq=2)
 select source_file, source_page, source_record, case when s.seq is null then t.status else s.status end as status, case when s.seq is null then t.confidence else s.confidence end as confidence,
 coalesce(s.batch_id, t.batch_id) as batch_id, coalesce(t.created_at, s.created_at) as created_at, coalesce(s.updated_at, t.updated_at) as updated_at from t full outer join s using (source_file, source_page, source_record)""",
)
def d1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = fixtures.sql(spark, sf_dir, SOURCE.format(s="string", explode="lateral view explode(array(1, 2)) z as s"))
    return D.upsert(fixtures.sql(spark, sf_dir, TARGET), source, KEYS, ["seq"])


TRANSITIONS = """t as (select *, lag(status) over (partition by rec_key order by ts, event_id) as p from fx_status_events)"""


@query(
    "d2_status_transitions",
    f"""with {TRANSITIONS}, c as (select batch_id, case when status='OK' then 1 else 0 end - case when p='OK' then 1 else 0 end as ok, case when status<>'OK' then 1 else 0 end - case when p<>'OK' then 1 else 0 end as rv
 from t where status is distinct from p) select batch_id, cast(sum(ok) as bigint) as ok_records, cast(sum(rv) as bigint) as review_records from c group by 1""",
)
def d2_status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.view(spark, sf_dir, "fx_status_events")
    chunk = [steps(F.unix_micros(F.col("ts").cast("timestamp")), 86_400_000_000)]
    return D.status_transitions(events, ["rec_key"], ["ts", "event_id"], ["batch_id"], chunk)


FILES = "select 'file_'||cast(rec_key as {s}) as path, event_id, ts, batch_id, case when status='OK' then 'DONE' when status='FAILED' then 'FAILED' else 'DONE' end as status, case when status<>'OK' then 'error '||cast(event_id as {s}) end as error from fx_status_events"
LEDGER = f"l as (select path, event_id, ts, batch_id, status, case when status='FAILED' then error end as error from (select *, row_number() over (partition by path order by ts desc, event_id desc) as r from ({FILES.format(s='varchar')})) where r=1)"


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.file_ledger(fixtures.sql(spark, sf_dir, FILES.format(s="string")))


@query("d3_file_ledger", f"with {LEDGER} select path, event_id, batch_id, status, error from l")
def d3_file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(spark, sf_dir).select("path", "event_id", "batch_id", "status", "error")


@query(
    "d4_batch_summary",
    f"""with {LEDGER}, f as (select batch_id, count(*) as total_files, count_if(status='DONE') as processed_files, count_if(status='FAILED') as failed_files from l group by 1),
 r as (select batch_id, count_if(status='OK') as ok_records, count_if(status<>'OK') as review_records from fx_records group by 1)
 select batch_id, coalesce(total_files, 0) as total_files, coalesce(processed_files, 0) as processed_files, coalesce(failed_files, 0) as failed_files, coalesce(ok_records, 0) as ok_records, coalesce(review_records, 0) as review_records from f full outer join r using (batch_id)""",
)
def d4_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.batch_summary(fixtures.view(spark, sf_dir, "fx_records"), ledger(spark, sf_dir))


@query(
    "d5_status_report",
    f"""with {LEDGER} select 'records' as kind, coalesce(status, 'TOTAL') as status, count(*) as rows from fx_records group by rollup(status)
 union all select 'files', coalesce(status, 'TOTAL'), count(*) from l group by rollup(status)""",
)
def d5_status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.status_report(fixtures.view(spark, sf_dir, "fx_records"), ledger(spark, sf_dir))


@query("d6_review_queue", "select source_record, source_file, confidence, field_a from fx_records where status='REVIEW' order by source_record")
def d6_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.review_queue(fixtures.view(spark, sf_dir, "fx_records"), ["source_record", "source_file", "confidence", "field_a"], ["source_record"])


@query("d7_export_projection", "select source_record as id, source_file, source_page, status, confidence, field_a as wali from fx_records order by 1")
def d7_export_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fixtures.view(spark, sf_dir, "fx_records").withColumnsRenamed({"source_record": "id", "field_a": "nama_wali"})
    return D.export_projection(records, ["id", "source_file", "source_page", "status", "confidence", "wali"])


JOBS = "select user_id as job_id, event_id, ts, event_type as status, cast(floor(value) as bigint) as created_at from events"
OUTPUTS = "select distinct user_id as job_id from events where event_type='purchase'"


@query(
    "d8_job_log",
    f"select job_id, event_id, status, created_at from (select *, row_number() over (partition by job_id order by ts desc, event_id desc) as r from ({JOBS})) where r=1 and job_id in (select job_id from ({OUTPUTS}))",
)
def d8_job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.job_log(fixtures.sql(spark, sf_dir, JOBS), fixtures.sql(spark, sf_dir, OUTPUTS)).drop("ts")
