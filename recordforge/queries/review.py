"""Review queries: documents stand for records, labels for corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.functions.scan import steps
from recordforge.operators import review as R
from recordforge.queries import query

VALIDATED = "select doc_id, lang, source, case when n_chars%3=0 then 'OK' else 'REVIEW' end as status_review from documents"
CORRECTIONS = "select l.doc_id, 'xx' as lang, case when l.toxic=1 then null else 'fixed' end as source, 'OK' as status_review, l.quality=1 as verified, ' ann ' as reviewed_by from labels l join documents d on l.doc_id=d.doc_id"
BUNDLES = f"""b as (select v.doc_id, case when c.doc_id is null then v.lang else c.lang end as lang, case when c.doc_id is null then v.source else c.source end as source,
 case when c.doc_id is null then v.status_review else c.status_review end as status_review, c.doc_id is not null as corrected, coalesce(c.verified, false) as verified, trim(c.reviewed_by) as reviewed_by
 from ({VALIDATED}) v left join ({CORRECTIONS}) c using (doc_id))"""
COLS = ["doc_id", "lang", "source", "status_review", "corrected", "verified", "reviewed_by"]


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.overlay(fixtures.sql(spark, sf_dir, VALIDATED), fixtures.sql(spark, sf_dir, CORRECTIONS), ["doc_id"]).select(*COLS)


@query("r1_overlay", f"with {BUNDLES} select * from b")
def r1_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles(spark, sf_dir)


READ = "select doc_id, 'lang' as cell, case when doc_id%4=0 then '  ' else lang||'  '||{n}||'read ' end as text from documents where doc_id%3<>0"
FIXED = "select doc_id, 'lang' as cell, 'fix'||cast(quality as {s}) as text from labels where quality=1 union all select doc_id, 'source', ' ' from labels"


@query(
    "r2_cell_labels",
    f"""with c as (select doc_id, 'lang' as cell, 'fix1' as label, 0 as p from labels where quality=1
 union all select doc_id, 'lang', lang||chr(10)||'read', 1 from documents where doc_id%3<>0 and doc_id%4<>0 union all select doc_id, 'lang', lang, 2 from documents union all select doc_id, 'source', source, 2 from documents)
 select doc_id, cell, label, p=0 as corrected_label from (select *, row_number() over (partition by doc_id, cell order by p, label) as r from c) where r=1""",
)
def r2_cell_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fixtures.sql(spark, sf_dir, "select doc_id, lang, source, '' as raw_lang from documents")
    read = fixtures.sql(spark, sf_dir, READ.format(n="'\\n'"))
    fixed = fixtures.sql(spark, sf_dir, FIXED.format(s="string"))
    return R.cell_labels(records, read, fixed, ["doc_id"], {"lang": ("raw_lang", "lang"), "source": ("source",)})


@query("r3_bundle_order", "select source_file, source_page, source_record, status from fx_records order by 1, 2, 3")
def r3_bundle_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.bundle_order(fixtures.view(spark, sf_dir, "fx_records").select("source_file", "source_page", "source_record", "status"))


@query("r4_search", f"with {BUNDLES} select * from b where status_review in ('OK', 'REVIEW') and not verified and contains(lower(coalesce(lang, '')||' '||coalesce(source, '')), 'e')")
def r4_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.search(bundles(spark, sf_dir), ["OK", "REVIEW"], False, " E ", ["lang", "source"])


@query("r5_review_metrics", f"with {BUNDLES} select count(*) as total, count_if(status_review<>'OK') as needs_review, count_if(corrected) as corrected, count_if(verified) as verified from b")
def r5_review_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.review_metrics(bundles(spark, sf_dir))


ROWS = "select o_orderkey, o_orderstatus, o_orderpriority from orders"
EDITS = "select c_custkey as edit_ix, c_mktsegment as o_orderpriority from customer"


@query(
    "r6_positional_patch",
    f"""with p as (select *, row_number() over (order by o_orderkey)-1 as pos from ({ROWS}))
 select o_orderkey, o_orderstatus, case when e.edit_ix is null then p.o_orderpriority else e.o_orderpriority end as o_orderpriority from p left join ({EDITS}) e on p.pos=e.edit_ix+5""",
)
def r6_positional_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, edits = fixtures.sql(spark, sf_dir, ROWS), fixtures.sql(spark, sf_dir, EDITS)
    return R.positional_patch(rows, edits, 5, ["o_orderpriority"], ["o_orderkey"], [steps("o_orderkey", 65536)])


@query("r7_preview", "select source_record, source_file, status, confidence from fx_records order by source_record offset 400 limit 200")
def r7_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.preview(fixtures.view(spark, sf_dir, "fx_records"), ["source_record", "source_file", "status", "confidence"], ["source_record"], 400)


FIXES = "select batch_id, source_record, 'OK' as status from fx_records where batch_id<7"


@query(
    "r8_preferred_source",
    f"with f as ({FIXES}) select batch_id, source_record, status, 'original' as row_source from fx_records where batch_id not in (select batch_id from f) union all select *, 'corrected' from f",
)
def r8_preferred_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = fixtures.view(spark, sf_dir, "fx_records").select("batch_id", "source_record", "status")
    return R.preferred_source(original, fixtures.sql(spark, sf_dir, FIXES), ["batch_id"])


BASE = "select p_partkey as rec, p_name as name, p_size as size, '' as status_review from part"
CHANGES = "select p_partkey as rec, case when p_partkey%4=0 then '  ' else ' '||p_brand||' ' end as name, case when p_partkey%6=0 then '' else ' '||cast(p_size+1 as {s})||' ' end as size, 'a'||{n}||' '||{n}||' b ' as review_reason, 'OK' as status_review from part where p_partkey%2=0"


@query(
    "r9_apply_edits",
    """select p_partkey as rec, case when p_partkey%4=0 then null when p_partkey%2=0 then p_brand else p_name end as name, case when p_partkey%6=0 then null when p_partkey%2=0 then p_size+1 else p_size end as size,
 case when p_partkey%2=0 then 'OK' else '' end as status_review, case when p_partkey%2=0 then 'a; b' else 'old' end as review_reason from part""",
)
def r9_apply_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = fixtures.sql(spark, sf_dir, BASE).withColumn("review_reason", F.array(F.lit("old")))
    edits = fixtures.sql(spark, sf_dir, CHANGES.format(s="string", n="'\\n'"))
    return R.apply_edits(base, edits, ["rec"], ["size"]).withColumn("review_reason", F.array_join("review_reason", "; "))


@query("r10_export_reviewed", f"with {BUNDLES} select * from b where verified")
def r10_export_reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.export_reviewed(bundles(spark, sf_dir), verified_only=True)
