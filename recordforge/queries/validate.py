"""Validation over records derived from the orders table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.operators import validate as V
from recordforge.queries import query

RECORDS = """select rec, case rec%7 when 0 then null when 1 then 'AB 1' else 'AB CD' end as nama_suami, case rec%9 when 0 then '' else 'EF GH' end as nama_isteri,
 case rec%5 when 0 then '1111111' when 1 then 'A123456' when 2 then 'XX' end as ic_lama_suami, case when rec%11=0 then '900230101234' when rec%11=1 then '900101101234' end as ic_baru_suami,
 case when rec%6<>0 then 'B7654321' end as ic_lama_isteri, cast(null as {s}) as ic_baru_isteri, cast(rec%120 as int) as umur_suami, case when rec%10<>0 then 30 end as umur_isteri,
 case when rec%8<>0 then 'RM 80.00' end as mas_kahwin, case when rec%4=0 then '80.00' else 'rm 80' end as mas_kahwin_raw,
 case rec%6 when 0 then '31-02-1990' when 1 then null else '01-02-1990' end as tarikh_nikah, case when rec%3=0 then '01-02-1990' end as tarikh_keluar, case when rec%5=0 then 'x' end as tarikh_keluar_raw,
 case when rec%13<>0 then 'N' end as nama_pendaftar, case when rec%2=0 then 'A' end as alamat_pendaftar, case when rec%14<>0 then 'W' end as nama_wali, case when rec%15<>0 then 'BAPA' end as hubungan_wali,
 case when rec%16<>0 then 'S' end as saksi_1, case when rec%17<>0 then 'T' end as saksi_2, rec%29<>0 as layout_ok, cast(rec%50 as double)/50+0.5 as layout_confidence from fx_strings"""
# Cells: two per record, blank ones for some, so that both cells are silent for a part of them.
CELLS = "select rec, 'a' as cell, case when rec%19=0 then ' ' else 'text' end as text, case when rec%23<>0 then cast(rec%10 as double)/10 end as avg_conf from fx_strings union all select rec, 'b', case when rec%2=0 then '' else 'more' end, 0.7 from fx_strings where rec%19<>0 or rec%2=0"

CHECKS = f"""r as ({RECORDS.format(s='varchar')}), cl as (select rec, avg(coalesce(avg_conf, 0)) filter (trim(text)<>'') as ocr from ({CELLS}) group by rec),
 k as (select r.*, ocr, coalesce(rec%5 in (0, 1), false) or rec%11=1 as h_id, rec%6<>0 as w_id, rec%5=0 as h_odd, coalesce(umur_suami between 15 and 100, false) as h_age, rec%10<>0 as w_age,
  rec%6 not in (0, 1) as nikah, rec%3=0 as keluar from r left join cl using (rec)),
 s as (select *, 1.0::double - (case when coalesce(nama_suami, '')='' then 0.2 when nama_suami='AB 1' then 0.15 else 0 end)::double - (case when nama_isteri='' then 0.2 else 0 end)::double
  - (case when not h_id then 0.15 else 0 end)::double - (case when not w_id then 0.15 else 0 end)::double - (case when h_odd then 0.15 else 0 end)::double - (case when not h_age then 0.1 else 0 end)::double - (case when not w_age then 0.1 else 0 end)::double
  - (case when mas_kahwin is null then 0.1 else 0 end)::double - (case when not nikah then 0.1 else 0 end)::double - (case when tarikh_keluar_raw is not null and not keluar then 0.1 else 0 end)::double
  - (case when ocr<0.5 then 0.1 else 0 end)::double - (case when layout_confidence<0.75 then 0.2 else 0 end)::double as score,
  list_filter([case when coalesce(nama_suami, '')='' then 'missing husband name' when nama_suami='AB 1' then 'suspicious symbols in husband name' end, case when nama_isteri='' then 'missing wife name' end,
  case when not h_id then 'missing or invalid husband IC' end, case when not w_id then 'missing or invalid wife IC' end, case when not h_id and not w_id then 'missing both IC values' end,
  case when h_odd then 'suspicious husband IC (implausible digits)' end, case when not h_age then 'invalid husband age' end, case when not w_age then 'invalid wife age' end,
  case when mas_kahwin is null then 'missing mas kahwin' end, case when mas_kahwin is not null and mas_kahwin_raw='80.00' then 'mas kahwin missing RM prefix' end, case when not nikah then 'invalid nikah date' end,
  case when tarikh_keluar_raw is not null and not keluar then 'invalid keluar date' end, case when nama_pendaftar is null then 'missing pendaftar name' end, case when alamat_pendaftar is null then 'missing pendaftar address' end,
  case when nama_wali is null then 'missing wali name' end, case when hubungan_wali is null then 'missing wali relationship' end, case when saksi_1 is null then 'missing saksi 1' end, case when saksi_2 is null then 'missing saksi 2' end,
  case when ocr<0.5 then 'low OCR confidence' end, case when layout_confidence<0.75 then 'low layout confidence' end], lambda x: x is not null) as rs from k),
 v as (select rec, case when not layout_ok or ocr is null then 0.0 else greatest(0.0, round(score, 4)) end::double as confidence,
  case when not layout_ok then 'FAILED_LAYOUT' when ocr is null then 'FAILED_OCR' when len(rs)=0 and round(score, 4)>=0.85 then 'OK' else 'REVIEW' end as status_review,
  case when not layout_ok then ['layout detection failed'] when ocr is null then ['OCR returned empty text'] else rs end as reasons from s)"""


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fixtures.sql(spark, sf_dir, RECORDS.format(s="string"))
    return V.validate_records(records, fixtures.sql(spark, sf_dir, CELLS), ["rec"])


@query("v1_validate_records", f"with {CHECKS} select rec, round(confidence, 3) as confidence, status_review, array_to_string(reasons, '; ') as review_reason from v")
def v1_validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).select("rec", F.round("confidence", 3).alias("confidence"), "status_review", F.array_join("review_reason", "; ").alias("review_reason"))


TYPED = """select rec, case rec%5 when 0 then '12/1994' when 1 then '12' else '7 / 2001' end as bil, case rec%6 when 0 then 'Nama:  Suami' when 1 then null else 'AB CD' end as nama_suami, 'A123456' as ic_lama_suami,
 case when rec%4=0 then '9001' end as ic_baru_suami, cast(rec%130 as int) as umur_suami, 'EF' as nama_isteri, cast(null as {s}) as ic_lama_isteri, case when rec%3=0 then '900101101234' end as ic_baru_isteri, 30 as umur_isteri,
 case when rec%2=0 then 'RM 1,200' else '80' end as mas_kahwin, 'P' as nama_pendaftar, 'Q' as alamat_pendaftar, 'W' as nama_wali, 'BAPA' as hubungan_wali, 'S' as saksi_1, 'T' as saksi_2,
 case rec%4 when 0 then '01-02-1990' when 1 then '1/2-1990' when 2 then '1. 2. 1990' end as tarikh_nikah from fx_strings"""
RAW = "select rec, f as field, case f when 'bil' then case when rec%7=0 then ' ' else 'no 12' end when 'umur_suami' then '25'||{n}||'bangsa' when 'saksi_1' then case when rec%9=0 then 'saksi kedua: bangsa' else 'S' end else 'x' end as raw_text, case f when 'nama_wali' then cast(rec%10 as double)/10 else 0.9 end as confidence from fx_strings {explode}"
STRICT_RAW = ("bil", "umur_suami", "saksi_1", "nama_wali", "tarikh_nikah")


@query(
    "v2_validate_strict",
    f"""with t as ({TYPED.format(s='varchar')}), d as (select rec, 1 as no, 'bil' as field, rec%5<>1 as ok, rec%7<>0 as has, 0.9::double as conf, null as bad from t
 union all select rec, 2, 'nama_suami', rec%6 not in (0, 1), false, 0, null from t union all select rec, 3, 'id_suami', rec%4<>0, false, 0, null from t union all select rec, 4, 'umur_suami', umur_suami between 16 and 120, true, 0.9, null from t
 union all select rec, 5, 'nama_isteri', true, false, 0, null from t union all select rec, 6, 'id_isteri', rec%3=0, false, 0, null from t union all select rec, 7, 'umur_isteri', true, false, 0, null from t
 union all select rec, 8, 'mas_kahwin', rec%2=0, false, 0, null from t union all select rec, 9, 'nama_pendaftar', true, false, 0, null from t union all select rec, 10, 'alamat_pendaftar', true, false, 0, null from t
 union all select rec, 11, 'nama_wali', true, true, (rec%10)::double/10, null from t union all select rec, 12, 'hubungan_wali', true, false, 0, null from t
 union all select rec, 13, 'saksi_1', true, true, 0.9, case when rec%9=0 then 'contamination: BANGSA, SAKSI KEDUA' end from t union all select rec, 14, 'saksi_2', true, false, 0, null from t
 union all select rec, 15, 'tarikh_nikah', coalesce(rec%4 in (0, 2), false), true, 0.9, null from t),
 j as (select *, ok and not (has and conf<0.5) and bad is null as valid, array_to_string(list_filter([case when has and conf<0.5 then 'confidence below threshold: '||printf('%.3f', conf) end, bad, case when not has then 'missing field' end], lambda x: x is not null), '; ') as issues from d)
 select rec, array_to_string(list(field order by no) filter (not valid), ',') as failed, count(*) filter (not valid) as n_failed, coalesce(string_agg(field||'='||issues, '|' order by no) filter (issues<>''), '') as issues,
 (select 15 - (case when t.rec%6=1 then 1 else 0 end) - (case when t.rec%3<>0 then 1 else 0 end) - (case when t.rec%4=3 then 1 else 0 end) from t where t.rec=j.rec) as meaningful_field_count from j group by rec""",
)
def v2_validate_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ", ".join(f"'{f}'" for f in STRICT_RAW)
    raw = fixtures.sql(spark, sf_dir, RAW.format(n="'\\n'", explode=f"lateral view explode(array({names})) e as f"))
    out = V.validate_strict(fixtures.sql(spark, sf_dir, TYPED.format(s="string")), raw, ["rec"], threshold=0.5, max_retry=len(V.TYPED_FIELDS))
    issues = F.transform(
        F.filter("diagnostics", lambda d: F.size(d["issues"]) > 0), lambda d: F.concat(d["field"], F.lit("="), F.array_join(d["issues"], "; "))
    )
    failed = F.when(F.size("retry_fields") > 0, F.array_join("retry_fields", ","))
    n_failed = F.size("failed_fields").cast("long").alias("n_failed")
    return out.select("rec", failed.alias("failed"), n_failed, F.array_join(issues, "|").alias("issues"), "meaningful_field_count")


BASIC = """select rec, case when rec%7<>0 then 'x' end as bil, case rec%3 when 0 then 'AB' when 1 then 'AB 1234' else 'ABC' end as nama_suami, 'EFG' as nama_isteri, case rec%4 when 0 then '900101-10-1234' when 1 then '901301101234' end as ic_baru_suami,
 '' as ic_baru_isteri, case rec%5 when 0 then '1/2/1990' when 1 then '1990-2-30' when 2 then '1/2-1990' when 3 then '1990-02-28' end as tarikh_nikah, case when rec%2=0 then cast(rec%10 as double)/10 end as confidence from fx_strings"""


@query(
    "v3_validate_basic",
    f"""with e as (select rec, confidence, list_filter([case when rec%7=0 then 'Missing bil' end, case when rec%3<>2 then 'Suspicious nama_suami' end, case when rec%4=1 then 'Invalid ic_baru_suami' end,
 case when rec%5 in (1, 2) then 'Invalid tarikh_nikah' end], lambda x: x is not null) as er from ({BASIC}))
 select rec, array_to_string(er, '; ') as validation_errors, case when len(er)>0 then 'REVIEW' else 'OK' end as status, case when len(er)>0 then least(coalesce(confidence, 0.5), 0.5) else greatest(coalesce(confidence, 0.8), 0.8) end::double as confidence from e""",
)
def v3_validate_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = V.validate_basic(fixtures.sql(spark, sf_dir, BASIC))
    return out.select("rec", F.array_join("validation_errors", "; ").alias("validation_errors"), "status", "confidence")


RESULTS = "select o_orderkey as rec, case when o_orderkey%11=0 then 'boom' end as document_error, cast(o_orderkey%16 as int) as meaningful_field_count, cast(o_orderkey%3 as int) as retry_count, o_orderkey%4=0 as failed from orders"


@query(
    "v4_document_status",
    f"""select rec, case when document_error is not null or meaningful_field_count=0 then 'FAILED' when failed then 'REVIEW_REQUIRED' when retry_count>0 then 'SUCCESS_WITH_RETRY' else 'SUCCESS' end as status from ({RESULTS})""",
)
def v4_document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = fixtures.sql(spark, sf_dir, RESULTS)
    results = results.withColumn("failed_fields", F.when(F.col("failed"), F.array(F.lit("Bil"))).otherwise(F.array().cast("array<string>")))
    return V.document_status(results).select("rec", "status")


@query("v5_status_counts", "select status, count(*) as records from fx_records group by status")
def v5_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.status_counts(fixtures.view(spark, sf_dir, "fx_records"))


@query("v6_reason_counts", f"with {CHECKS} select reason, count(*) as records from (select unnest(reasons) as reason from v) group by reason")
def v6_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.reason_counts(validated(spark, sf_dir))
