"""Operator inputs derived from the given tables, in Spark and in DuckDB dialect."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from recordforge.functions.scan import ordered_scan, steps
from recordforge.session import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SERIAL_TEXT = """select batch_id, k, case when k%7=0 then null when k%11=0 then cast(100+batch_id*37+i+1 as string)
 else cast(100+batch_id*37+i as string)||'/9'||cast(batch_id%10 as string) end as observed from {rows} t"""

# name -> (Spark text, DuckDB text or None when the Spark text is valid there as well)
VIEWS: dict[str, tuple[str, str | None]] = {
    "fx_records": (
        """select 'batch_'||cast(o_custkey%20 as string) as source_file, cast(o_orderkey%5+1 as int) as source_page,
 cast(o_orderkey as int) as source_record,
 case o_orderstatus when 'F' then 'OK' when 'O' then 'REVIEW' else 'FAILED_OCR' end as status,
 cast(o_orderkey%100 as double)/100 as confidence, o_orderpriority as field_a, cast(o_custkey%20 as int) as batch_id from orders""",
        None,
    ),
    "fx_status_events": (
        """select cast(user_id as bigint) as rec_key, event_id, ts, cast(user_id%10 as int) as batch_id,
 case when event_type in ('purchase','signup') then 'OK' when event_type='error' then 'FAILED' else 'REVIEW' end as status from events""",
        None,
    ),
    "fx_serials": (
        "",
        SERIAL_TEXT.format(rows="(select o_custkey%20 as batch_id, o_orderkey as k, row_number() over (partition by o_custkey%20 order by o_orderkey)-1 as i from orders)"),
    ),
    "fx_left": (
        """select p_partkey as rec, case when p_partkey%11=0 then null else p_brand end as brand, p_type as type, p_name as name,
 cast(p_size as string) as size from part""",
        None,
    ),
    "fx_right": (
        """select p_partkey as rec, case when p_partkey%5=0 then null else p_brand end as brand,
 case when p_partkey%3=0 then lower(p_type) else p_type end as type,
 case when p_partkey%7=0 then p_name||' x' else p_name end as name, cast(p_size as string) as size,
 cast((p_partkey*13)%100 as double)/100 as conf from part""",
        None,
    ),
    "fx_profile": (
        """select event_type as page, cast(floor((unix_timestamp(ts)-1704067200)/3600) as int) as y, cast(count(*) as int) as coverage
 from events group by 1,2""",
        """select event_type as page, cast(floor((epoch(ts)-1704067200)/3600) as int) as y, cast(count(*) as int) as coverage
 from events group by 1,2""",
    ),
    "fx_boxes": (
        """select label as page_no, vec_id as word_ix, x1, y1, x1+60 as x2, y1+40 as y2 from (select label, vec_id,
 cast(floor((cast(embedding[0] as double)+0.6)*500) as int) as x1, cast(floor((cast(embedding[1] as double)+0.6)*500) as int) as y1 from embeddings) t""",
        """select label as page_no, vec_id as word_ix, x1, y1, x1+60 as x2, y1+40 as y2 from (select label, vec_id,
 cast(floor((cast(embedding[1] as double)+0.6)*500) as int) as x1, cast(floor((cast(embedding[2] as double)+0.6)*500) as int) as y1 from embeddings) t""",
    ),
    "fx_strings": (
        """select o_orderkey as rec,
 case o_orderkey%4 when 0 then dd||'.'||mm||'.'||substr(yy,3,2) when 1 then dd||'/'||mm||'/'||yy when 2 then yy||'-'||mm||'-'||dd else replace(dd,'0','O')||'-'||mm||'-'||yy end as date_text,
 case o_orderkey%3 when 0 then 'RM '||amt||'.00' when 1 then 'RM.'||amt||'.5O' else amt||'.00' end as money_text,
 case o_orderkey%3 when 0 then 'A '||substr(idn,1,7) when 1 then substr(yy,3,2)||mm||dd||'-10-'||substr(idn,4,4) else 'R/F '||substr(idn,2,6) end as id_text,
 cast(15+o_orderkey%80 as string)||' TAHUN' as age_text
 from (select o_orderkey, lpad(cast(day(o_orderdate) as string),2,'0') as dd, lpad(cast(month(o_orderdate) as string),2,'0') as mm, cast(year(o_orderdate) as string) as yy,
  cast(cast(floor(o_totalprice/1000) as int) as string) as amt, lpad(cast(o_orderkey*7+1000000 as string),7,'1') as idn from orders) t""",
        None,
    ),
    "fx_cells": (
        """select conv_id as doc_id, turn as record_ix, role as cell, text, 0.4+cast((conv_id*31+turn*17)%60 as double)/100 as avg_conf from conversations""",
        None,
    ),
    "fx_reviews": (
        """select d.doc_id, d.lang, d.source, d.n_chars, l.doc_id is not null as corrected, coalesce(l.quality,0)=1 as verified,
 coalesce(l.toxic,0) as toxic from documents d left join labels l on d.doc_id=l.doc_id""",
        None,
    ),
    "fx_responses": (
        "select event_id as rec, props as payload, event_type='error' as failed from events",
        None,
    ),
    "fx_words": (
        """select doc_id, 1 as page_no, ln, tn, cast(ln as bigint)*100000+tn as word_ix, tok as text, 0.5D+cast((ln*7+tn*3)%32 as double)/64 as confidence,
 tn*50.0D as x1, ln*20.0D as y1, tn*50.0D+40 as x2, ln*20.0D+12 as y2
 from (select doc_id, ln, tn, tok from documents lateral view posexplode(split(text,'\\n')) a as ln, line lateral view posexplode(split(line,' ')) b as tn, tok) t where tok<>''""",
        """select doc_id, 1 as page_no, ln, tn, cast(ln as bigint)*100000+tn as word_ix, tok as text, 0.5::double+cast((ln*7+tn*3)%32 as double)/64 as confidence,
 tn*50.0::double as x1, ln*20.0::double as y1, tn*50.0::double+40 as x2, ln*20.0::double+12 as y2
 from (select doc_id, ln, unnest(range(len(w))) as tn, unnest(w) as tok from (select doc_id, ln, string_split(line,' ') as w from (select doc_id, unnest(range(len(p))) as ln, unnest(p) as line from (select doc_id, string_split(text, chr(10)) as p from documents)))) where tok<>''""",
    ),
}


_LOADED: dict[tuple[str, int, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; the file listing and schema are read once per session."""
    # An application's id is never used again, unlike the address of a session.
    place = (spark.sparkContext.applicationId, id(spark), sf_dir, name)
    if place not in _LOADED:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _LOADED[place] = spread(df) if name in ("documents", "pages", "orders") else df
    return _LOADED[place]


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run Spark SQL over the given tables and the fixture views named in ``text``."""
    for name in VIEWS:
        if re.search(rf"\b{name}\b", text):
            view(spark, sf_dir, name).createOrReplaceTempView(name)
    for name in TABLES:
        if re.search(rf"\b{name}\b", text):
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(text)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "fx_serials":
        rows = sql(spark, sf_dir, "select o_custkey%20 as batch_id, o_orderkey as k from orders")
        ordered_scan(rows, ["batch_id"], ["k"], [steps("k", 65536)], index="i").createOrReplaceTempView("serial_rows")
        return spark.sql(SERIAL_TEXT.format(rows="(select batch_id, k, i-1 as i from serial_rows)"))
    return sql(spark, sf_dir, VIEWS[name][0])


def oracle(text: str) -> str:
    """Prefix a DuckDB query with the fixture views it names."""
    needed: list[str] = []

    def visit(body: str) -> None:
        for name, (spark_sql, duck_sql) in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", body):
                visit(duck_sql or spark_sql)
                needed.append(name)

    visit(text)
    # The views are used several times in some oracles: let DuckDB compute them once.
    parts = [f"{n} as materialized ({VIEWS[n][1] or VIEWS[n][0]})" for n in needed]
    body = text.strip()
    if not parts:
        return body
    match = re.match(r"with(\s+recursive)?\s", body, re.IGNORECASE)
    if match:
        recursive = "recursive " if match.group(1) else ""
        return f"with {recursive}" + ", ".join(parts) + ", " + body[match.end():]
    return "with " + ", ".join(parts) + " " + body
