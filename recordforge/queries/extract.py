"""Field extraction over cell texts derived from the orders table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.operators import extract as E
from recordforge.queries import query

SQ = lambda c: f"upper(trim(regexp_replace({c}, '\\s+', ' ', 'g')))"

SERIALS = "select k as rec, batch_id, case k%5 when 0 then replace(observed, '1', 'I') when 1 then replace(observed, '/', ' | ') when 2 then replace(observed, '0', 'O') when 3 then 'no '||observed else '4'||observed end as text from fx_serials"


def cleaned(d: str) -> str:
    cut = f"case when length({d})>3 and {d} like '4%' then substr({d}, 1, 3) else {d} end"
    return f"cast(cast({cut} as bigint) as varchar)"


@query(
    "e1_extract_serial",
    f"""with t as (select rec, text, translate({SQ("coalesce(text, '')")}, 'OQSLI', '00511') as v from ({SERIALS})),
 m as (select *, regexp_extract(v, '\\b(\\d{{3,5}})\\s*[/\\\\|]\\s*(\\d{{2,4}})\\b', 1) as n, regexp_extract(v, '\\b(\\d{{3,5}})\\s*[/\\\\|]\\s*(\\d{{2,4}})\\b', 2) as y, regexp_extract(v, '\\b(\\d{{1,5}})\\b', 1) as a from t),
 s as (select rec, text, case when n<>'' then {cleaned('n')}||'/'||right(y, 2) when a<>'' then {cleaned('a')} end as serial from m)
 select rec, serial, text as serial_raw, serial is null as serial_needs_review from s""",
)
def e1_extract_serial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.extract_serial(fixtures.sql(spark, sf_dir, SERIALS), "text").select("rec", "serial", "serial_raw", "serial_needs_review")


# A number above and a text line below the price, so that the last readable line must be found.
PRICES = "select rec, '12345' || {n} || money_text || {n} || case rec%4 when 0 then 'paid' when 1 then '7' else '' end as text from fx_strings"


@query(
    "e2_extract_money",
    f"""with l as (select rec, unnest(range(len(p))) as i, unnest(p) as line from (select rec, list_filter(list_transform(string_split(text, chr(10)), lambda x: {SQ('x')}), lambda x: x<>'') as p from ({PRICES.format(n='chr(10)')}))),
 c as (select *, replace(line, 'O', '0') as t from l), g as (select *, regexp_extract_all(t, '\\d+') as g from c where not regexp_matches(replace(t, 'RM', ''), '[A-Z]')),
 v as (select *, case when len(g)=0 or (t not like '%RM%' and length(g[-1])<2 and len(g)=1) then null
  when len(g)>=2 and length(g[-1])<=2 then 'RM '||cast(cast(array_to_string(g[:-2], '') as bigint) as varchar)||'.'||rpad(g[-1], 2, '0')
  when len(g)=1 and length(g[1])>=3 then 'RM '||cast(cast(left(g[1], -2) as bigint) as varchar)||'.'||right(g[1], 2)
  when len(g)=1 then 'RM '||cast(cast(g[1] as bigint) as varchar)||'.00' end as money from g),
 b as (select rec, arg_max(money, i) as money, arg_max(line, i) as money_raw from v where money is not null group by 1)
 select rec, money, money_raw, coalesce(money_raw not like '%RM%', false) as money_needs_review from (select rec from fx_strings) left join b using (rec)""",
)
def e2_extract_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.extract_money(fixtures.sql(spark, sf_dir, PRICES.format(n="'\\n'")), "text").drop("text")


AGES = "select rec, age_text || ' / ' || cast(70+rec%30 as {s}) || case rec%3 when 0 then ' THN' when 1 then ' TAHUH.' else ' years' end as text from fx_strings"


@query(
    "e3_extract_ages",
    f"""with d as (select rec, regexp_extract_all(translate(upper(text), 'OoIl|SB', '0011158'), '(?:^|[\\s/\\-])([1-9]\\d{{1,2}})\\s*(?:TAHUN|TAHUH|TAHN|THN)\\b', 1) as d from ({AGES.format(s='varchar')})),
 a as (select rec, list_filter(list_transform(d, lambda x: case when length(x)=2 and x like '7%' then x::int-50 else x::int end), lambda x: x between 15 and 100) as a from d)
 select rec, array_to_string(case when len(a)=2 and a[1]=a[2] then a[:1] else a end, ',') as ages, len(a)=0 as ages_needs_review from a""",
)
def e3_extract_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ages = E.extract_ages(fixtures.sql(spark, sf_dir, AGES.format(s="string")), "text")
    return ages.select("rec", F.array_join(F.transform("ages", lambda a: a.cast("string")), ",").alias("ages"), "ages_needs_review")


@query(
    "e4_extract_ids",
    """with t as (select rec, upper(id_text)||' '||substr(cast(rec*7919+10000 as varchar), 1, 5) as v from fx_strings),
 m as (select rec, v, nullif(regexp_replace(regexp_extract(v, '\\b\\d{6}[\\s./-]*\\d{2}[\\s./-]*\\d{4}\\b'), '\\D', '', 'g'), '') as id_modern,
  nullif(regexp_replace(regexp_extract(v, '(?:[A-Z]{1,3}/[A-Z]{1,3}|[A-Z])[-\\s./]*\\d{5,7}'), '[\\s.]', '', 'g'), '') as l, nullif(regexp_extract(v, '\\b\\d{7,8}\\b'), '') as b from t)
 select rec, case when id_modern is null then coalesce(l, b) end as id_legacy, id_modern, id_modern is null and coalesce(l, b) is null as id_needs_review from m""",
)
def e4_extract_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.sql(spark, sf_dir, "select rec, id_text||' '||substr(cast(rec*7919+10000 as string), 1, 5) as text from fx_strings")
    return E.extract_ids(texts, "text", profile="typed").select("rec", "id_legacy", "id_modern", "id_needs_review")


@query(
    "e4_extract_ids_ledger",
    """with t as (select rec, upper(id_text) as v from fx_strings),
 m as (select *, regexp_extract(v, '\\b(\\d{6})[-\\s./]?(\\d{2})[-\\s./]?(\\d{4})\\b') as mr, regexp_extract(v, '\\b([A-Z]{1,3}(?:/[A-Z]{1,3})?)[-\\s./]*(\\d{5,7})') as lr, regexp_extract(v, '\\b(\\d{5,7})') as br from t),
 d as (select *, regexp_replace(mr, '\\D', '', 'g') as md from m),
 e as (select *, md<>'' and try_cast('20'||md[1:2]||'-'||md[3:4]||'-'||md[5:6] as date) is not null or md<>'' and try_cast('19'||md[1:2]||'-'||md[3:4]||'-'||md[5:6] as date) is not null as good from d)
 select rec, case when lr<>'' then regexp_replace(lr, '[\\s.-]+', '', 'g') when br<>'' and mr='' then br end as id_legacy,
 case when good then md end as id_modern, nullif(array_to_string(list_filter([case when lr<>'' then trim(lr) when br<>'' then br end, nullif(mr, '')], lambda x: x is not null), ' / '), '') as id_raw from e""",
)
def e4_extract_ids_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.view(spark, sf_dir, "fx_strings").select("rec", "id_text")
    return E.extract_ids(texts, "id_text").select("rec", "id_legacy", "id_modern", "id_raw")


@query(
    "e5_extract_dates",
    """with t as (select rec, translate(upper('key ' || date_text || ' text'), 'OIL|ZSGB', '01112568') as v from fx_strings),
 p as (select rec, v, regexp_extract_all(v, '\\d+') as g0 from t), g as (select *, list_filter(g0, lambda x: length(x)>=1) as g from p),
 q as (select rec, v, case when rec%4=2 then [g[-1], g[-2], g[-3]] when rec%4=3 then g[-3:] else g[-3:] end as d from g),
 y as (select rec, v, d, case when length(d[3])=2 then case when d[3]::int<=30 then 2000+d[3]::int else 1900+d[3]::int end else d[3]::int end as yr from q)
 select rec, lpad(cast(d[1]::int as varchar), 2, '0')||'-'||lpad(cast(d[2]::int as varchar), 2, '0')||'-'||cast(yr as varchar) as date, false as date_needs_review from y
 where try_cast(yr||'-'||lpad(cast(d[2]::int as varchar), 2, '0')||'-'||lpad(cast(d[1]::int as varchar), 2, '0') as date) is not null""",
)
def e5_extract_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = fixtures.sql(spark, sf_dir, "select rec, 'key ' || date_text || ' text' as text from fx_strings")
    return E.extract_dates(texts, "text").select("rec", "date", "date_needs_review")


# Texts of typed forms: values between other text, on later lines, out of range, glued to letters, absent.
TYPED_SERIALS = "select rec, case rec%5 when 0 then 'No '||cast(rec as {s})||' /  '||cast(1900+rec%100 as {s})||' x' when 1 then cast(rec as {s})||'/2001' when 2 then 'A12/1994' when 3 then '12/199' end as text from fx_strings"
TYPED_PRICES = "select rec, case rec%6 when 0 then 'harga RM '||cast(1000+rec as {s}) when 1 then 'rm 2 500.50 tunai' when 2 then 'RM'||cast(rec%90+10 as {s})||'.5' when 3 then 'RM x' when 4 then 'FARM 80' end as text from fx_strings"
TYPED_AGES = "select rec, case rec%5 when 0 then {n}||' '||cast(10+rec%120 as {s})||' tahun' when 1 then 'umur 25'||{n}||'99' when 2 then 'x'||{n}||'30' when 3 then '1234' end as text from fx_strings"
TYPED_DATES = "select rec, case rec%4 when 0 then 'tarikh'||{n}||cast(1+rec%28 as {s})||'-'||cast(1+rec%12 as {s})||'-1990' when 1 then 'tiada' when 2 then '31/02/1990'||{n}||'5/6/1990' end as text from fx_strings"


@query(
    "e1_typed",
    f"""with t as ({TYPED_SERIALS.format(s='varchar')}), v as (select rec, text, case rec%5 when 0 then rec||'/'||(1900+rec%100) when 1 then rec||'/2001' end as serial from t)
 select rec, serial, text as serial_raw, serial is null as serial_needs_review from v""",
)
def e1_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.extract_serial(fixtures.sql(spark, sf_dir, TYPED_SERIALS.format(s="string")), "text", profile="typed").drop("text")


@query(
    "e2_typed",
    f"""with t as ({TYPED_PRICES.format(s='varchar')}), v as (select rec, text, case rec%6 when 0 then 'RM '||format('{{:,}}', 1000+rec) when 1 then 'RM 2,500.50' when 2 then 'RM '||(rec%90+10)||'.5' end as money from t)
 select rec, money, text as money_raw, money is null as money_needs_review from v""",
)
def e2_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.extract_money(fixtures.sql(spark, sf_dir, TYPED_PRICES.format(s="string")), "text", profile="typed").drop("text")


@query(
    "e3_typed",
    f"""with t as ({TYPED_AGES.format(s='varchar', n='chr(10)')}), v as (select rec, text, case rec%5 when 0 then case when 10+rec%120 between 16 and 120 then 10+rec%120 end when 1 then 25 end as ages from t)
 select rec, ages, ages is null as ages_needs_review from v""",
)
def e3_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ages = E.extract_ages(fixtures.sql(spark, sf_dir, TYPED_AGES.format(s="string", n="'\\n'")), "text", low=16, high=120, profile="typed")
    return ages.select("rec", "ages", "ages_needs_review")


@query(
    "e5_typed",
    f"""with t as ({TYPED_DATES.format(s='varchar', n='chr(10)')}), v as (select rec, case rec%4 when 0 then lpad((1+rec%28)::varchar, 2, '0')||'-'||lpad((1+rec%12)::varchar, 2, '0')||'-1990' when 2 then '05-06-1990' end as date from t)
 select rec, case when rec%4=0 and try_cast('1990-'||date[4:5]||'-'||date[1:2] as date) is null then null else date end as date,
 case when rec%4=0 then try_cast('1990-'||date[4:5]||'-'||date[1:2] as date) is null else date is null end as date_needs_review from v""",
)
def e5_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = E.extract_dates(fixtures.sql(spark, sf_dir, TYPED_DATES.format(s="string", n="'\\n'")), "text", profile="typed")
    return dates.select("rec", "date", "date_needs_review")


NAME = "translate(cast({k}+1000000 as {s}), '0123456789', 'KMNPRTUVWX')"
SPOUSES = """select rec, case when rec%6=0 then '[cell: 1]' || {n} else '' end || 'AB ' || """ + NAME.format(k="rec", s="{s}") + """ || case when rec%5=0 then {n} || 'CD' else '' end
 || case when rec%7=0 then ' ' else {n} end || id_text || ' ' || age_text || {n} || case when rec%9=0 then '-' || {n} else '' end
 || 'EF BINTI ' || """ + NAME.format(k="rec*3", s="{s}") + """ || {n} || cast(1000000+rec as {s}) || {n} || cast(20+rec%40 as {s}) || ' THN' || {n} || money_text as text from fx_strings"""
DETAIL = "(?:(?:[A-Z]{1,3}/[A-Z]{1,3}|[A-Z])[-\\s./]*\\d{5,8}\\b|\\b\\d{5,8}\\b|\\b\\d{6}[-\\s./]?\\d{2}[-\\s./]?\\d{4}\\b|\\b\\d{2,3}\\s*(?:TAHUN|TAHUH|TAHN|THN)\\b)"


@query(
    "e6_segment_people",
    f"""with l as (select rec, unnest(range(len(p))) as i, unnest(p) as line, len(p) as n from (select rec, list_filter(string_split(text, chr(10)), lambda x: x<>'') as p from ({SPOUSES.format(n='chr(10)', s='varchar')}))),
 k as (select * from l where i<n-1 and regexp_matches(line, '[A-Z0-9]') and line not like '[%'),
 d as (select rec, i, line, translate(line, 'OoIl|SB', '0011158') as num, regexp_matches(translate(line, 'OoIl|SB', '0011158'), '{DETAIL}') as det from k),
 e as (select *, case when det then trim(left(line, length(regexp_extract(num, '^(.*?){DETAIL}', 1)))) else line end as nm, case when det then substr(num, length(regexp_extract(num, '^(.*?){DETAIL}', 1))+1) end as dt,
  row_number() over w as pos, case when not det and lag(det) over w then 1 else 0 end as turn from d window w as (partition by rec order by i)),
 q as (select *, 1+sum(turn) over (partition by rec order by i rows unbounded preceding) as person_no from e),
 r as (select *, row_number() over (partition by rec, person_no order by i) as inner_pos from q)
 select rec, person_no::int as person_no, string_agg(case when nm<>'' and (not det or inner_pos=1) then nm end, ' ' order by i) as name,
 string_agg(dt, chr(10) order by i) as detail from r where person_no<=2 group by rec, person_no""",
)
def e6_segment_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fixtures.sql(spark, sf_dir, SPOUSES.format(n="'\\n'", s="string"))
    return E.segment_people(cells, "text", ["rec"]).select("rec", "person_no", "name", "detail")


OFFICES = "select rec, 'hi. ' || " + NAME.format(k="rec", s="{s}") + " || case when rec%3<>0 then {n} || ' pejabat  masjio ' || cast(rec%9 as {s}) || {n} || case when rec%3=1 then 'kawasah islan' else ' ' end else '' end as text from fx_strings"


@query(
    "e7_extract_name_address",
    "select rec, 'HJ. '||" + NAME.format(k="rec", s="varchar") + """ as name, case rec%3 when 0 then null when 1 then 'PEJABAT MASJID '||cast(rec%9 as varchar)||chr(10)||'KAWASAN ISLAM'
 else 'PEJABAT MASJID '||cast(rec%9 as varchar) end as address, rec%3=0 as address_needs_review from fx_strings""",
)
def e7_extract_name_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fixtures.sql(spark, sf_dir, OFFICES.format(n="'\\n'", s="string"))
    return E.extract_name_address(cells, "text").drop("text")


GUARDIANS = "select rec, 'GH ' || " + NAME.format(k="rec", s="{s}") + """ || case rec%5 when 0 then ' (BAPA)' when 1 then ' SAUDARA LELAKl' when 2 then ' WALI HAKIN' else '' end as who,
 case rec%5 when 3 then 'abang' when 4 then 'none' else '' end as relation_text from fx_strings"""


@query(
    "e8_extract_guardian",
    "select rec, 'GH '||" + NAME.format(k="rec", s="varchar") + " || case when rec%5=4 then ' NONE' else '' end as guardian, case rec%5 when 0 then 'BAPA' when 1 then 'SAUDARA LELAKI' when 2 then 'WALI HAKIM' when 3 then 'ABANG' end as relation from fx_strings",
)
def e8_extract_guardian(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fixtures.sql(spark, sf_dir, GUARDIANS.format(s="string"))
    return E.extract_guardian(cells, "who", "relation_text").select("rec", "guardian", "relation")


PEOPLE = "select rec, case rec%4 when 0 then '① ' || a || {n} || '② ' || b when 1 then '1) ' || a || ' 2) ' || b when 2 then a || {n} || b || {n} || 'ZZ' else a end as text from (select rec, 'AA '||" + NAME.format(k="rec", s="{s}") + " as a, 'BB '||" + NAME.format(k="rec*7", s="{s}") + " as b from fx_strings) t"


@query(
    "e9_split_numbered",
    "select rec, a as person_1, case rec%4 when 2 then b||' ZZ' when 3 then null else b end as person_2 from (select rec, 'AA '||" + NAME.format(k="rec", s="varchar") + " as a, 'BB '||" + NAME.format(k="rec*7", s="varchar") + " as b from fx_strings) t",
)
def e9_split_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.split_numbered(fixtures.sql(spark, sf_dir, PEOPLE.format(n="'\\n'", s="string")), "text").drop("text")


@query(
    "e10_pivot_cells",
    """select doc_id, record_ix, max(case when cell='user' then text end) as raw_user, max(case when cell='assistant' then text end) as raw_assistant,
 max(case when cell='system' then text end) as raw_system from fx_cells group by all""",
)
def e10_pivot_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.pivot_cells(fixtures.view(spark, sf_dir, "fx_cells"), ["doc_id", "record_ix"], ["user", "assistant", "system"])


def record_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell table of whole records: one row per record and cell, built from the derived texts."""
    spouses = fixtures.sql(spark, sf_dir, SPOUSES.format(n="'\\n'", s="string")).selectExpr("rec", "text as suami_isteri")
    rest = fixtures.sql(
        spark, sf_dir,
        f"""select s.rec, cast(s.rec%900+100 as string)||'/94' as bil, o.text as pendaftar, g.who as wali, g.relation_text as hubungan_wali, p.text as saksi,
 s.date_text as tarikh_nikah, case when s.rec%8=0 then 'unknown' else s.date_text end as tarikh_keluar, 'diambil oleh' as remarks
 from fx_strings s join ({OFFICES.format(n="'\\n'", s='string')}) o on s.rec=o.rec join ({GUARDIANS.format(s='string')}) g on s.rec=g.rec join ({PEOPLE.format(n="'\\n'", s='string')}) p on s.rec=p.rec""",
    )
    wide = spouses.join(rest, "rec")
    cells = [c for c in wide.columns if c != "rec"]
    return wide.unpivot("rec", cells, "cell", "text").withColumn("avg_conf", 0.4 + (F.col("rec") % 60) / 100)


# What the texts of ``record_cells`` stand for.  Where an identity number follows a name on its line (every seventh record), the last letter
# of the name and the first six digits of a modern number read as a number with a letter. A leading 7 of an age is a misread 2.
RECORDS_SQL = f"""raws as (select s.rec, p.text as raw_suami_isteri, o.text as raw_pendaftar, g.who as raw_wali, nullif(g.relation_text, '') as raw_hubungan_wali, w.text as raw_saksi from fx_strings s
  join ({SPOUSES.format(n='chr(10)', s='varchar')}) p on s.rec=p.rec join ({OFFICES.format(n='chr(10)', s='varchar')}) o on s.rec=o.rec join ({GUARDIANS.format(s='varchar')}) g on s.rec=g.rec
  join ({PEOPLE.format(n='chr(10)', s='varchar')}) w on s.rec=w.rec),
 base as (select f.*, {NAME.format(k='f.rec', s='varchar')} as n1, {NAME.format(k='f.rec*3', s='varchar')} as n3, {NAME.format(k='f.rec*7', s='varchar')} as n7, f.rec%7=0 and f.rec%3=1 as clash,
  'AB '||{NAME.format(k='f.rec', s='varchar')}||case when f.rec%5=0 then ' CD' else '' end as husband, replace(f.date_text, 'O', '0') as dated, regexp_extract(f.money_text, '[0-9]+', 0) as amount,
  case f.rec%4 when 2 then f.date_text[9:10]||'-'||f.date_text[6:7]||'-'||f.date_text[1:4] when 0 then f.date_text[1:2]||'-'||f.date_text[4:5]||'-'||case when f.date_text[7:8]::int<=30 then '20' else '19' end||f.date_text[7:8]
   else replace(f.date_text[1:2], 'O', '0')||'-'||f.date_text[4:5]||'-'||f.date_text[7:10] end as day from fx_strings f),
 whole as (select b.rec, (b.rec%900+100)||'/94' as bil, case when b.rec%35=0 then 'AB '||n1 when clash then left(husband, length(husband)-1) else husband end as nama_suami,
  case when clash then right(husband, 1)||id_text[1:6] when b.rec%3<>1 then replace(id_text, ' ', '') end as ic_lama_suami, case when b.rec%3=1 then replace(id_text, '-', '') end as ic_baru_suami,
  case when clash then right(husband, 1)||' '||id_text[1:6]||' / '||id_text when b.rec%3=1 then id_text[1:6]||' / '||id_text else id_text end as id_suami_raw, (case when 15+b.rec%80 between 70 and 79 then b.rec%80-35 else 15+b.rec%80 end)::int as umur_suami,
  'EF BINTI '||n3 as nama_isteri, (1000000+b.rec)::varchar as ic_lama_isteri, null::varchar as ic_baru_isteri, (1000000+b.rec)::varchar as id_isteri_raw, (20+b.rec%40)::int as umur_isteri,
  'RM '||amount||case when b.rec%3=1 then '.50' else '.00' end as mas_kahwin, money_text as mas_kahwin_raw, 'HJ. '||n1 as nama_pendaftar,
  case b.rec%3 when 1 then 'PEJABAT MASJID '||b.rec%9||chr(10)||'KAWASAN ISLAM' when 2 then 'PEJABAT MASJID '||b.rec%9 end as alamat_pendaftar, 'GH '||n1||case when b.rec%5=4 then ' NONE' else '' end as nama_wali,
  case b.rec%5 when 0 then 'BAPA' when 1 then 'SAUDARA LELAKI' when 2 then 'WALI HAKIM' when 3 then 'ABANG' end as hubungan_wali, 'AA '||n1 as saksi_1,
  case b.rec%4 when 2 then 'BB '||n7||' ZZ' when 3 then null else 'BB '||n7 end as saksi_2, day as tarikh_nikah, dated as tarikh_nikah_raw, case when b.rec%8<>0 then day end as tarikh_keluar,
  case when b.rec%8<>0 then dated else 'UNKNOWN' end as tarikh_keluar_raw, 'Diambil oleh suami' as remarks, (b.rec%900+100)||'/94' as raw_bil, raw_suami_isteri, raw_pendaftar, raw_wali, raw_hubungan_wali, raw_saksi,
  date_text as raw_tarikh_nikah, case when b.rec%8=0 then 'unknown' else date_text end as raw_tarikh_keluar, 'diambil oleh' as raw_remarks,
  array_to_string(list_filter([case when b.rec%3=2 then 'mas_kahwin_missing_rm' end, case when b.rec%3=0 then 'pendaftar_address_missing' end, case when b.rec%5=4 then 'wali_relationship_missing' end,
   case when b.rec%4=3 then 'saksi_2_missing' end, case when b.rec%8=0 then 'tarikh_keluar_unparsed' end], lambda x: x is not null), '; ') as review_reason from base b join raws using (rec))"""


@query("e10_assemble_records", f"with {RECORDS_SQL} select *, case when review_reason='' then 'OK' else 'REVIEW' end as status_review from whole")
def e10_assemble_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = E.assemble_records(record_cells(spark, sf_dir), ["rec"])
    return records.withColumn("review_reason", F.array_join("review_reason", "; "))


ORDINALS = "select rec, case rec%4 when 0 then 'record_'||lpad(cast(rec as {s}), 3, '0') when 1 then cast(rec as {s}) when 2 then 'page 3 of '||cast(rec%50 as {s})||'.' else 'none' end as text from fx_strings"


@query(
    "e11_coerce_ordinal",
    f"select rec, coalesce(try_cast(regexp_extract_all(text, '\\d+')[-1] as int), 1) as ordinal from ({ORDINALS.format(s='varchar')})",
)
def e11_coerce_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.coerce_ordinal(fixtures.sql(spark, sf_dir, ORDINALS.format(s="string")), "text", out="ordinal").select("rec", "ordinal")
