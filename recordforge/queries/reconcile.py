"""Two-source merge of the part table with an altered copy of it, and of event payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.operators import reconcile as M
from recordforge.queries import query

# Fenced, wrapped, comma-ended, truncated and unreadable forms of every payload; inner trailing commas, brackets inside of
# strings, a cut inside a nested list, a long text without an object, a value of another type.
PAYLOADS = """select rec, failed, case rec%6 when 0 then case when rec%24=0 then replace(payload, ': ', ': "') else payload end
 when 1 then '```json'||{n}||payload||{n}||'```' when 2 then 'Here: '||payload||' done'
 when 3 then replace(payload, '}}', case when rec%12=3 then ',}}' else ', "o": {{"z": [1, 2,],}}, "note": "x, }}",}}' end)
 when 4 then replace(payload, '}}', case when rec%12=4 then ', "note": "cut' else ', "note": "cut", "o": [1, {{"z": "y' end)
 else case when rec%12=5 then 'no object' else repeat('no object ', 700) end end as payload from fx_responses"""


@query(
    "m1_parse_responses",
    """select rec, case when rec%6<>5 and rec%24<>0 then cast(json_extract(payload, '$.k') as bigint) end as k,
 case when rec%6=4 then 'cut' when rec%12=9 then 'x, }' end as note, coalesce(rec%6 in (2, 3, 4) or rec%24=0, false) as repaired,
 case when rec%6=5 then 'invalid JSON' when rec%24=0 then 'type mismatch' end as parse_error,
 case when rec%6=5 then case when rec%12=5 then 9 else 7000 end when rec%24=0 then length(payload)+1 end as payload_chars from fx_responses""",
)
def m1_parse_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = M.parse_responses(fixtures.sql(spark, sf_dir, PAYLOADS.format(n="'\\n'")), "payload", "k bigint, note string", ["rec"])
    return parsed.select("rec", "response.k", "response.note", "repaired", "parse_error", F.length("payload").cast("int").alias("payload_chars"))


CONFIDENCES = """select event_id as rec, case when event_id%2=0 then '{{"a": '||cast(round(value/100, 5) as {s})||', "b": "x", "c": 2}}'
 else '[{{"field": "a", "confidence": 0.1}}, {{"field": " ", "confidence": 1}}, {{"field": "b", "confidence": -3}}, {{"field": "c", "confidence": "1.5"}}, {{"field": "a", "confidence": '||cast(round(value/100, 5) as {s})||'}}]' end as conf from events"""


@query(
    "m2_confidence_map",
    """with v as (select event_id as rec, greatest(0.0::double, least(1.0::double, round(round(value/100, 5), 4))) as a from events)
 select rec, a, 0.0::double as b, 1.0::double as c, round((a+0.0+1.0)/3, 4) as mean from v""",
)
def m2_confidence_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = M.confidence_map(fixtures.sql(spark, sf_dir, CONFIDENCES.format(s="string")), "conf")
    pick = lambda k: F.try_element_at("field_confidence", F.lit(k)).alias(k)
    return mapped.select("rec", pick("a"), pick("b"), pick("c"), F.col("field_confidence_mean").alias("mean"))


FIELDS = ("brand", "type", "name", "size")
CRITICAL = ("brand", "name")


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = fixtures.view(spark, sf_dir, "fx_left").withColumns(
        {
            "cells": F.create_map(F.lit("brand"), (F.col("rec") % 10) / 10, F.lit("type"), F.lit(0.5)),
            "review_reason": F.when(F.col("rec") % 4 == 0, F.array(F.lit("parser note"))).otherwise(F.array().cast("array<string>")),
        }
    )
    right = fixtures.view(spark, sf_dir, "fx_right").where("rec % 17 <> 0").withColumns(
        {
            "field_confidence": F.create_map(F.lit("brand"), F.col("conf"), F.lit("name"), F.lit(1.0) - F.col("conf")),
            "confidence": F.col("conf"),
            "uncertain_fields": F.when(F.col("rec") % 3 == 0, F.array(F.lit("type"), F.lit("size"))).otherwise(F.array().cast("array<string>")),
        }
    )
    return M.reconcile(left, right, ["rec"], FIELDS, CRITICAL, cell_confidence="cells")


def _field_sql(f: str, model: str, cell: str) -> str:
    same = lambda c: f"trim(regexp_replace(translate(upper({c}), '.,', ''), '\\s+', ' ', 'g'))"
    filled = f"{f}: filled by model" + (" with no parser corroboration; review required" if f in CRITICAL else "")
    return f"""select l.rec, '{f}' as field, {FIELDS.index(f)} as no, l.{f} as a, r.{f} as b, {model}::double as m, {cell}::double as c,
 case when r.{f} is null or trim(r.{f})='' then case when l.{f} is null or trim(l.{f})='' then 'empty' else 'parser_only' end
 when l.{f} is null or trim(l.{f})='' then 'filled' when {same('l.' + f)}={same('r.' + f)} then 'agree' when {model}>=0.70 then 'model' else 'parser' end as outcome,
 '{filled}' as filled_text from fx_left l left join rr r using (rec)"""


LONG = "rr as (select * from fx_right where rec%17<>0), u as (" + " union all ".join(
    [
        _field_sql("brand", "coalesce(r.conf, 0)", "(l.rec%10)/10"),
        _field_sql("type", "coalesce(r.conf, 0)", "0.5"),
        _field_sql("name", "coalesce(1.0-r.conf, 0)", "0"),
        _field_sql("size", "coalesce(r.conf, 0)", "0"),
    ]
) + """), w as (select *, case outcome when 'parser_only' then c when 'filled' then m when 'agree' then greatest(m, c) when 'model' then m*0.95::double when 'parser' then least(m, c) end as weight,
 case outcome when 'filled' then filled_text when 'model' then field||': parser/model disagreement; chose model' when 'parser' then field||': parser/model disagreement; review required' end as reason,
 case when outcome in ('filled', 'model') then b else a end as chosen from u),
 g as (select rec, max(chosen) filter (no=0) as brand, max(chosen) filter (no=1) as type, max(chosen) filter (no=2) as name, max(chosen) filter (no=3) as size,
  round(round(avg(weight), 4), 3) as merge_confidence, string_agg(reason, '; ' order by no) as r1 from w group by rec),
 h as (select g.*, list_filter([case when g.rec%4=0 then 'parser note' end, r1, case when conf<0.80 then 'low model confidence: brand' end, case when 1.0-conf<0.80 then 'low model confidence: name' end,
  case when rr.rec%3=0 then 'model uncertain fields: type, size' end], lambda x: x is not null) as rs from g left join rr using (rec))"""


@query(
    "m3_reconcile",
    f"with {LONG} select rec, brand, type, name, size, merge_confidence, array_to_string(rs, '; ') as review_reason, regexp_matches(array_to_string(rs, '; '), 'disagreement|low model confidence|no parser corroboration') as must_review from h",
)
def m3_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _merged(spark, sf_dir).withColumns({"review_reason": F.array_join("review_reason", "; "), "merge_confidence": F.round("merge_confidence", 3)})
    return merged.select("rec", *FIELDS, "merge_confidence", "review_reason", "must_review")


CELL_FIELDS = "select conv_id as doc_id, turn as record_ix, f as field from conversations {explode}"


@query(
    "m4_field_cell_confidence",
    f"""select f.doc_id, f.record_ix, f.field, coalesce(c.avg_conf, 0) as cell_confidence from ({CELL_FIELDS.format(explode="cross join (values ('ask'), ('answer'), ('other')) as z(f)")}) f
 left join fx_cells c on f.doc_id=c.doc_id and f.record_ix=c.record_ix and c.cell=case f.field when 'ask' then 'user' when 'answer' then 'assistant' end""",
)
def m4_field_cell_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = fixtures.sql(spark, sf_dir, CELL_FIELDS.format(explode="lateral view explode(array('ask', 'answer', 'other')) z as f"))
    cells = fixtures.view(spark, sf_dir, "fx_cells")
    return M.field_cell_confidence(fields, cells, ["doc_id", "record_ix"], {"ask": "user", "answer": "assistant"}).drop("cell")


@query(
    "m5_agreement_report",
    f"with {LONG} select field, " + ", ".join(f"count_if(outcome='{o}') as {o}" for o in M.OUTCOMES) + " from u group by field",
)
def m5_agreement_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.agreement_report(_merged(spark, sf_dir))


@query(
    "m6_enrich_or_fallback",
    """select e.event_id as rec, case when e.event_id%7=0 then 'REVIEW' when failed or e.event_id%5=0 then 'REVIEW' else 'OK' end as status_review,
 array_to_string(list_filter([case when e.event_id%7=0 then 'old' end, case when e.event_id%5=0 then 'model unavailable: missing' when failed then 'model unavailable: ServerError' end], lambda x: x is not null), '; ') as review_reason,
 not (failed or e.event_id%5=0) as enriched from events e join fx_responses r on e.event_id=r.rec""",
)
def m6_enrich_or_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    validated = fixtures.sql(
        spark, sf_dir, "select event_id as rec, case when event_id%7=0 then 'REVIEW' else 'OK' end as status_review, case when event_id%7=0 then array('old') else cast(array() as array<string>) end as review_reason from events"
    )
    responses = fixtures.sql(spark, sf_dir, "select rec, case when failed then 'ServerError' end as error_class from fx_responses where rec%5<>0")
    out = M.enrich_or_fallback(validated, responses, ["rec"])
    return out.withColumn("review_reason", F.array_join("review_reason", "; "))


@query(
    "m6_run_switch",
    """with r as (select rec, case when rec%400=399 then 'ClientError: 403 PERMISSION_DENIED' when failed then 'ServerError' end as e from fx_responses where rec%5<>0),
 f as (select min(rec) as first from r where e like '%403%'), v as (select event_id as rec, coalesce(event_id > (select first from f), false) as off_ from events)
 select v.rec, case when not off_ and (r.rec is null or e is not null) then 'REVIEW' else 'OK' end as status_review,
 case when not off_ and (r.rec is null or e is not null) then 'model unavailable: '||coalesce(e, 'missing') else '' end as review_reason,
 not off_ and r.rec is not null and e is null as enriched from v left join r on v.rec=r.rec""",
)
def m6_run_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    validated = fixtures.sql(spark, sf_dir, "select event_id as rec, 'OK' as status_review, cast(array() as array<string>) as review_reason from events")
    responses = fixtures.sql(
        spark, sf_dir, "select rec, case when rec%400=399 then 'ClientError: 403 PERMISSION_DENIED' when failed then 'ServerError' end as error_class from fx_responses where rec%5<>0"
    )
    out = M.enrich_or_fallback(validated, responses, ["rec"], order="rec")
    return out.withColumn("review_reason", F.array_join("review_reason", "; "))
