"""Export shaping on derived records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from recordforge import fixtures
from recordforge.operators import export as X
from recordforge.queries import query
from recordforge.session import ensure_checkpoint_dir
from recordforge.sources import records


@query("x1_project_columns", "select status as \"Status\", field_a as \"Bil\", source_file as \"Source File\", confidence as \"Confidence\" from fx_records")
def x1_project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fixtures.view(spark, sf_dir, "fx_records").withColumnsRenamed({"status": "status_review", "field_a": "bil"})
    return X.project_columns(records, ["Status", " Bil", "Source File", "Status", "Confidence"], hidden=False)


# Offered rows: some repeated, some without a source, some of those with a crop folder.
OFFERED = """select case when source_record%10=0 then null else source_file end as source_file, source_page, source_record, case when source_record%20=0 then 'crop'||cast(source_record%40 as {s}) end as crop_folder, status, r as attempt
 from fx_records {explode}"""
THERE = "select source_file, source_page, source_record, cast(null as {s}) as crop_folder from fx_records where source_record%4=0"
SPARK_TWICE, DUCK_TWICE = "lateral view explode(array(1, 2)) z as r", "cross join (values (1), (2)) as z(r)"


@query(
    "x2_dedupe_by_source",
    f"""with o as ({OFFERED.format(s='varchar', explode=DUCK_TWICE)}), k as (select *, case when source_file is not null then 's|'||source_file||'|'||source_page||'|'||source_record when crop_folder is not null then 'c|'||crop_folder||'|'||source_record end as key from o),
 f as (select * from (select *, row_number() over (partition by key order by attempt) as n from k where key is not null) where n=1 and key not in (select 's|'||source_file||'|'||source_page||'|'||source_record from fx_records where source_record%4=0))
 select source_file, source_page, source_record, crop_folder, status, attempt from f union all select source_file, source_page, source_record, crop_folder, status, attempt from k where key is null""",
)
def x2_dedupe_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    offered = fixtures.sql(spark, sf_dir, OFFERED.format(s="string", explode=SPARK_TWICE))
    return X.dedupe_by_source(offered, fixtures.sql(spark, sf_dir, THERE.format(s="string")), ["attempt"])


LINES = "select case when l_linenumber=7 then '' else l_returnflag end as a, case when l_linenumber<>7 then l_linestatus end as b, case when l_linenumber<>7 then cast(l_partkey%500 as {s}) end as c, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice from lineitem"
OLD_LINES = "select l_returnflag as a, l_linestatus as b, cast(l_partkey%500 as {s}) as c from lineitem where l_linenumber=1 and l_partkey%500<100"
PLACE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(
    "x3_dedupe_by_row",
    f"""with n as ({LINES.format(s='varchar')}), k as (select *, case when coalesce(a, '')||coalesce(b, '')||coalesce(c, '')<>'' then coalesce(a, '')||'|'||coalesce(b, '')||'|'||coalesce(c, '') end as key from n),
 f as (select * from (select *, row_number() over (partition by key order by {PLACE}) as rn from k where key is not null) where rn=1 and key not in (select a||'|'||b||'|'||c from ({OLD_LINES.format(s='varchar')})))
 select a, b, c, l_orderkey, l_linenumber from f union all select a, b, c, l_orderkey, l_linenumber from k where key is null""",
)
def x3_dedupe_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, old = fixtures.sql(spark, sf_dir, LINES.format(s="string")), fixtures.sql(spark, sf_dir, OLD_LINES.format(s="string"))
    kept = X.dedupe_by_row(new, old, ["a", "b", "c"], PLACE.split(", "))
    return kept.select("a", "b", "c", "l_orderkey", "l_linenumber")


@query(
    "x4_stamp",
    """select source_record, case when source_record%3=0 then '2020-01-01T00:00:00' else '2024-05-06T07:08:09' end as created_at, '2024-05-06T07:08:09' as updated_at,
 case when source_record%2=0 then 'one; two' else '' end as review_reason_text, status from fx_records""",
)
def x4_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fixtures.sql(
        spark, sf_dir,
        """select source_record, status as status_review, case source_record%3 when 0 then '2020-01-01T00:00:00' when 1 then '' end as created_at,
 case when source_record%2=0 then array('one', 'two') else cast(array() as array<string>) end as review_reason from fx_records""",
    )
    return X.stamp(records, "2024-05-06T07:08:09").select("source_record", "created_at", "updated_at", "review_reason_text", "status")


@query(
    "x5_export_counts",
    f"with n as ({LINES.format(s='varchar')}) select count(distinct coalesce(a, '')||'|'||b||'|'||c) + count_if(coalesce(a, '')='' and b is null) as written_count, count(*) - (count(distinct coalesce(a, '')||'|'||b||'|'||c) + count_if(coalesce(a, '')='' and b is null)) as skipped_duplicates, count(distinct coalesce(a, '')||'|'||b||'|'||c) + count_if(coalesce(a, '')='' and b is null) as total_rows from n",
)
def x5_export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = fixtures.sql(spark, sf_dir, LINES.format(s="string"))
    return X.export_counts(new, X.dedupe_by_row(new, None, ["a", "b", "c"], PLACE.split(", ")), None)


COUNTED = "count(distinct coalesce(a, '')||'|'||b||'|'||c) + count_if(coalesce(a, '')='' and b is null)"


@query(
    "x5_write_summary",
    f"""with n as ({LINES.format(s='varchar')}), h as (select * from n where l_orderkey%2=0), one as (select {COUNTED} as w, count(*) as n from h), whole as (select {COUNTED} as w, count(*) as n from n),
 blank as (select count_if(coalesce(a, '')='' and b is null) as b from h)
 select 1 as run, w as written_count, n-w as skipped_duplicates, w as total_rows from one
 union all select 2, whole.w-one.w+b, whole.n-(whole.w-one.w+b), whole.w+b from one, whole, blank""",
)
def x5_write_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to one table, every second order and then all of them; the counts are those the writes observed."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/x5-{uuid.uuid4().hex}"
    new = fixtures.sql(spark, sf_dir, LINES.format(s="string"))
    runs = []
    for run, rows in ((1, new.where("l_orderkey % 2 = 0")), (2, new)):
        done = records.append_rows(rows.select("a", "b", "c"), out)
        runs.append((run, done.written_count, done.skipped_duplicates, done.total_rows))
    return spark.createDataFrame(runs, "run int, written_count long, skipped_duplicates long, total_rows long")


@query(
    "x6_typed_rows",
    """with l as (select o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as k, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) as p from orders group by 1)
 select 'Doc_'||o_custkey as "Source File", k||'/1990' as "Bil", p as "Processing Status", 'true' as "Review Required", 'Bil; Saksi 1' as "Failed Fields", '1' as "Retry Count", '' as "Error Message" from l""",
)
def x6_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = fixtures.sql(
        spark, sf_dir,
        """select 'Doc_'||cast(o_custkey as string) as source_file, cast(o_orderkey as string)||'/1990' as bil, o_orderpriority as processing_status, true as review_required, array('Bil', 'Saksi 1') as failed_fields,
 1 as retry_count, cast(null as string) as error_message, o_orderdate as processed_at, o_orderkey as tie from orders""",
    )
    rows = X.typed_rows(results, None, ["processed_at", "tie"])
    return rows.select("Source File", "Bil", "Processing Status", "Review Required", "Failed Fields", "Retry Count", "Error Message")
