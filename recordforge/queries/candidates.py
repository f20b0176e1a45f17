"""Candidate generation and decisions on the derived field texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.operators import candidates as C
from recordforge.queries import query
from recordforge.queries.normalize import RATIOS

NAMES = """select rec, 'nama_suami' as field, case rec%5 when 0 then ' ab b1n '||n when 1 then 'CD BINT1 '||n||' BJN X.' when 2 then n||' HI. #Q' when 3 then 'AKMAL ALIAS.' else 'AHMAD B.' end as value
 from (select rec, replace(upper(substr(age_text, 4)), 'UN', 'XX') as n from fx_strings) t"""
PHRASES = "select 'nama_suami' as field, 'AKMAL ALIAS' as phrase, 'AKMAL BIN ALIAS' as replacement"
PREPARED = """p as (select rec, field, value, trim(regexp_replace(regexp_replace(upper(value), '[^A-Z0-9\\s.''/()@-]', ' ', 'g'), '\\s+', ' ', 'g')) as q from ({n})),
 pp as (select rec, field, value, case when q like '%.' and length(replace(string_split(q, ' ')[-1], '.', ''))>3 then rtrim(q, '.') else q end as p from p),
 t as (select *, array_to_string(list_transform(string_split(p, ' '), lambda x: case x when 'B1N' then 'BIN' when 'BJN' then 'BIN' when 'BLN' then 'BIN' when 'BINT1' then 'BINTI'
  when 'B1NTI' then 'BINTI' when 'M0HD' then 'MOHD' when 'MOHO' then 'MOHD' when 'A8D' then 'ABD' when 'HI.' then 'HJ.' else x end), ' ') as tok,
  case when p='AKMAL ALIAS' then 'AKMAL BIN ALIAS' end as ph from pp)"""


@query(
    "c1_name_candidates",
    f"""with {PREPARED.format(n=NAMES)},
 c as (select rec, field, value as original_value, p as value, 'safe_normalisation' as source, 'safe_normalisation' as correction_type, 0 as substitutions, false as requires_retry, false as requires_review from t
 union all select rec, field, value, ph, 'phrase_rule', 'phrase_correction', 2, false, false from t where ph is not null
 union all select rec, field, value, tok, 'typo_rule', 'connector_typo', len(list_filter(list_zip(string_split(p, ' '), string_split(tok, ' ')), lambda z: z[1]<>z[2])), true, true from t where tok<>p)
 select *, greatest(0.0::double, 1.0::double-substitutions*0.05::double) as validity, greatest(0.0::double, 0.98::double-substitutions*0.04::double) as plausibility,
 greatest(0.0::double, 0.99::double-substitutions*0.05::double) as similarity from c""",
)
def c1_name_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.name_candidates(fixtures.sql(spark, sf_dir, NAMES), rules=fixtures.sql(spark, sf_dir, PHRASES))


IDS = "select rec, 'ic_baru_suami' as field, case rec%4 when 0 then replace(id_text, '1', 'I') when 1 then id_text when 2 then replace(id_text, '-', '') else '90'||lpad(cast(rec%14 as {s}), 2, '0')||lpad(cast(rec%33 as {s}), 2, '0')||'1O1234' end as value from fx_strings"
SCORES = "greatest(0.0::double, {v}::double-n*0.05::double) as validity, greatest(0.0::double, {p}::double-n*{w}::double) as plausibility, greatest(0.0::double, 0.99::double-n*0.05::double) as similarity"


@query(
    "c2_id_candidates",
    f"""with p as (select rec, field, value, trim(regexp_replace(regexp_replace(upper(value), '[^A-Z0-9|./\\-\\s]', ' ', 'g'), '\\s+', ' ', 'g')) as p from ({IDS.format(s='varchar')})),
 f as (select *, regexp_replace(p, '[^A-Z0-9|]', '', 'g') as c, regexp_replace(p, '[\\s.-]+', '', 'g') as j from p),
 g as (select *, translate(c, 'OQIL|ZSGB', '001112568') as m, regexp_extract(c, '^([A-Z])?([A-Z0-9|]{{5,8}})([A-Z])?$', 2) as b,
  regexp_extract(c, '^([A-Z])?([A-Z0-9|]{{5,8}})([A-Z])?$', 1) as b1, regexp_extract(c, '^([A-Z])?([A-Z0-9|]{{5,8}})([A-Z])?$', 3) as b3 from f),
 h as (select *, length(c)=12 and regexp_matches(m, '^\\d{{12}}$') and (try_cast('19'||m[1:2]||'-'||m[3:4]||'-'||m[5:6] as date) is not null or try_cast('20'||m[1:2]||'-'||m[3:4]||'-'||m[5:6] as date) is not null) as modern,
  length(c)<>12 and regexp_matches(j, '^[A-Z]{{1,3}}(?:/[A-Z]{{1,3}})?\\d{{5,8}}$') as lettered,
  length(c)<>12 and regexp_matches(translate(b, 'OQIL|ZSGB', '001112568'), '^\\d+$') as plain from g),
 n as (select rec, field, value as original_value, case when modern then m when lettered then j else b1||translate(b, 'OQIL|ZSGB', '001112568')||b3 end as value,
  case when modern then length(c)-length(translate(c, 'OQIL|ZSGB', '')) when lettered then 0 else length(b)-length(translate(b, 'OQIL|ZSGB', '')) end as n, modern, lettered from h where modern or lettered or plain)
 select rec, field, original_value, value, case when n>0 then 'typo_rule' else 'safe_normalisation' end as source, case when n>0 then 'digit_confusion' else 'safe_normalisation' end as correction_type, n as substitutions,
 false as requires_retry, false as requires_review, greatest(0.0::double, (case when modern or lettered then 1.0 else 0.98 end)::double-n*0.05::double) as validity,
 greatest(0.0::double, (case when modern then 0.99 when lettered then 1.0 else 0.97 end)::double-n*0.03::double) as plausibility, greatest(0.0::double, 0.99::double-n*0.05::double) as similarity from n""",
)
def c2_id_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.id_candidates(fixtures.sql(spark, sf_dir, IDS.format(s="string")))


DATES = "select rec, 'tarikh_nikah' as field, case rec%6 when 0 then replace(date_text, '1', 'I') when 1 then '31.'||substr(date_text, 4) when 2 then '2'||cast(rec%9 as {s})||'.'||cast(1+rec%9 as {s})||'94' else date_text end as value from fx_strings"


@query(
    "c3_date_candidates",
    f"""with p as (select rec, field, value, length(value)-length(translate(upper(value), 'OQIL|ZSGB', '')) as n,
  list_filter(regexp_split_to_array(trim(regexp_replace(translate(upper(value), 'OQIL|ZSGB', '001112568'), '[^0-9./\\-\\s]', ' ', 'g')), '[-./\\s]+'), lambda x: x<>'') as g from ({DATES.format(s='varchar')})),
 o as (select *, unnest(case when len(g)=3 and length(g[1])=4 then [[g[3], g[2], g[1]]] when len(g)=3 then [g] when len(g)=2 and length(g[2])=3 then [[g[1], g[2][1:1], g[2][2:3]]] else [] end) as d from p),
 y as (select *, case when length(d[3])=2 then case when d[3]::int<=30 then 2000+d[3]::int else 1900+d[3]::int end else d[3]::int end as y from o)
 select rec, field, value as original_value, lpad(d[1]::int::varchar, 2, '0')||'-'||lpad(d[2]::int::varchar, 2, '0')||'-'||y::varchar as value, case when n>0 then 'typo_rule' else 'safe_normalisation' end as source,
 case when n>0 then 'date_digit_confusion' else 'date_normalisation' end as correction_type, n as substitutions, n>0 as requires_retry, false as requires_review, {SCORES.format(v='1.0', p='0.98', w='0.04')}
 from y where try_cast(lpad(y::varchar, 4, '0')||'-'||lpad(d[2]::int::varchar, 2, '0')||'-'||lpad(d[1]::int::varchar, 2, '0') as date) is not null""",
)
def c3_date_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.date_candidates(fixtures.sql(spark, sf_dir, DATES.format(s="string")))


FLAGGED = "select rec, case when rec%10=0 then repeat(cast(rec%7 as {s}), cast(4+rec%5 as int)) else id_text end as id_text, case when rec%6=0 then '30/02/19'||cast(10+rec%80 as {s}) else date_text end as date_text, case rec%4 when 0 then '...' when 1 then 'AB 1' when 2 then '' else 'A. B' end as name_text from fx_strings"


@query(
    "c4_validity_flags",
    f"""with f as (select *, regexp_replace(upper(id_text), '[^A-Z0-9]', '', 'g') as c, regexp_replace(upper(id_text), '[ .]', '', 'g') as s, regexp_replace(id_text, '[^0-9]', '', 'g') as g from ({FLAGGED.format(s='varchar')})),
 d as (select *, try_cast('19'||c[1:2]||'-'||c[3:4]||'-'||c[5:6] as date) is not null or try_cast('20'||c[1:2]||'-'||c[3:4]||'-'||c[5:6] as date) is not null as birth from f)
 select rec, case when regexp_matches(c, '^\\d{{12}}$') then birth else regexp_matches(s, '^[A-Z]{{1,3}}(/[A-Z]{{1,3}})?\\d{{5,8}}$') or regexp_matches(c, '^\\d{{5,8}}$') end as id_valid,
 length(g)>=5 and length(replace(g, g[1:1], ''))=0 as id_suspicious, rec%6<>0 as date_valid, rec%4 in (1, 2) as name_suspicious from d""",
)
def c4_validity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.sql(spark, sf_dir, FLAGGED.format(s="string"))
    df = C.validity_flags(C.validity_flags(C.validity_flags(df, "id_text", "id"), "date_text", "date"), "name_text", "name")
    return df.select("rec", "id_valid", "id_suspicious", "date_valid", "name_suspicious")


# Candidates as they leave the generators: several readings per part, some from a retry with a confidence.
READINGS = """select l_partkey as rec, 'nama_suami' as field, l_returnflag||'-'||l_linestatus||cast(l_linenumber as {s}) as value, case l_linenumber%4 when 0 then 'retry_gray' when 1 then 'typo_rule' when 2 then 'safe_normalisation' else 'original_ocr' end as source,
 l_tax*10 as validity, 1-l_discount as plausibility, l_discount*5 as similarity, l_linenumber%3 as substitutions, l_linenumber%2=0 as requires_review, case when l_linenumber%4=0 then l_quantity/100 end as ocr_confidence, 'N-O'||cast(l_partkey%9 as {s}) as base from lineitem"""
SCORED = """sc as (select *, case when ocr_confidence is null then validity*0.475::double+plausibility*0.375::double+greatest(similarity, ratio)*0.15::double+0.0::double+bonus
 else validity*0.35::double+plausibility*0.25::double+greatest(similarity, ratio)*0.15::double+ocr_confidence*0.25::double+bonus end as score from
 (select *, 1.0::double-levenshtein(base, value)/greatest(length(base), length(value))::double as ratio,
 (case when source like 'retry_%' then 0.10 when source='typo_rule' then -0.05 when source='safe_normalisation' then -0.02 else 0.0 end)::double as bonus from ({r})))"""
DUCK_SCORED = SCORED.format(r=READINGS.format(s="varchar"))
RANK = "round(score, 9) desc, requires_review, substitutions, round(validity, 9) desc, source, value"


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = C.score_candidates(fixtures.sql(spark, sf_dir, READINGS.format(s="string")), "base")
    return scored.withColumns({"score": F.round("score", 9), "validity": F.round("validity", 9)})


@query("c5_score_candidates", f"with {DUCK_SCORED} select rec, value, source, substitutions, round(score, 6) as score from sc")
def c5_score_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(spark, sf_dir).select("rec", "value", "source", "substitutions", F.round("score", 6).alias("score"))


@query(
    "c5_score_gestalt",
    f"""with recursive r as ({READINGS.format(s="varchar")}), pairs as (select distinct base as a, value as b from r), {RATIOS},
 {SCORED.format(r="select r.* from r").replace("1.0::double-levenshtein(base, value)/greatest(length(base), length(value))::double as ratio", "(select ratio from ratios where a=base and b=value) as ratio")}
 select rec, value, source, substitutions, round(score, 6) as score from sc""",
)
def c5_score_gestalt(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = C.score_candidates(fixtures.sql(spark, sf_dir, READINGS.format(s="string")), "base", metric="gestalt")
    return scored.select("rec", "value", "source", "substitutions", F.round("score", 6).alias("score"))


@query(
    "c6_merge_candidates",
    f"with {DUCK_SCORED}, m as (select *, row_number() over (partition by rec, field, value order by {RANK}) as r from sc) select rec, field, value, source, substitutions, round(score, 6) as score from m where r=1",
)
def c6_merge_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = C.merge_candidates(_readings(spark, sf_dir), ["rec", "field"])
    return merged.select("rec", "field", "value", "source", "substitutions", F.round("score", 6).alias("score"))


@query(
    "c7_select_best",
    f"with {DUCK_SCORED}, m as (select *, row_number() over (partition by rec, field order by {RANK}) as r from sc) select rec, field, value, source, substitutions, round(score, 6) as score from m where r=1",
)
def c7_select_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = C.select_best(_readings(spark, sf_dir), ["rec", "field"])
    return best.select("rec", "field", "value", "source", "substitutions", F.round("score", 6).alias("score"))


# One field of each class per record; every class has good, odd and empty values.
FIELDS = """select rec, 'tarikh_nikah' as field, case when rec%6=0 then '30/02/1990' when rec%11=0 then ' ' else date_text end as value from fx_strings
 union all select rec, 'ic_lama_suami', case when rec%5=0 then 'X9' else id_text end from fx_strings
 union all select rec, 'nama_suami', case rec%4 when 0 then 'AB B1N CD' when 1 then 'AB 4 CD' when 2 then null else 'AB BIN CD' end from fx_strings"""
# The same in Spark, in one projection.
FIELDS_SPARK = """select rec, inline(array(
 struct('tarikh_nikah' as field, case when rec%6=0 then '30/02/1990' when rec%11=0 then ' ' else date_text end as value),
 struct('ic_lama_suami' as field, case when rec%5=0 then 'X9' else id_text end as value),
 struct('nama_suami' as field, case rec%4 when 0 then 'AB B1N CD' when 1 then 'AB 4 CD' when 2 then null else 'AB BIN CD' end as value))) from fx_strings"""
RETRIES = """select rec, field, a as attempt, 'v'||cast(a as {s}) as variant, case field when 'tarikh_nikah' then '28-02-199'||cast(a as {s}) when 'ic_lama_suami' then 'A123456'||cast(a as {s}) else 'AB BIN CD' end as text,
 cast(rec%10 as double)/10 as confidence from (select distinct rec, field from ({f}) t where rec%3<>0) q {explode}"""
FACTS = "select rec, field, rec%13<>0 as has_crop, case when rec%3<>0 then 3 else 0 end as retry_count, case when rec%3=0 and rec%2=0 then 3 else 0 end as retry_errors from ({f}) t"


def _refined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fields, second readings and facts of the second reading; a field has one row, so nothing has to be made distinct."""
    fields = fixtures.sql(spark, sf_dir, FIELDS_SPARK)
    text = RETRIES.replace("select distinct rec, field", "select rec, field")
    retries = fixtures.sql(spark, sf_dir, text.format(s="string", f=FIELDS_SPARK, explode="lateral view explode(array(1, 2, 3, 4)) e as a"))
    return fields, retries, fixtures.sql(spark, sf_dir, FACTS.format(f=FIELDS_SPARK))


@query(
    "c8_retry_queue",
    f"""select rec, field, value from ({FIELDS}) t where trim(coalesce(value, ''))='' or (field='tarikh_nikah' and (rec%6=0 or (rec%4=3 and value like '%O%')))
 or (field='ic_lama_suami' and rec%5=0) or (field='ic_lama_suami' and rec%3=1 and try_cast('19'||value[1:2]||'-'||value[3:4]||'-'||value[5:6] as date) is null and try_cast('20'||value[1:2]||'-'||value[3:4]||'-'||value[5:6] as date) is null)
 or (field='nama_suami' and rec%4 in (0, 1))""",
)
def c8_retry_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields, _, _ = _refined(spark, sf_dir)
    initial = C.score_candidates(C.refine_candidates(fields, None, ["rec"]), "base")
    # A date whose letters had to be read as digits is best explained by a typo rule.
    typo = initial.where(F.col("source") != "original_ocr")
    return C.retry_queue(fields, C.select_best(typo, ["rec", "field"]), ["rec"]).select("rec", "field", "value")


# Dates as day, month, year (texts) of a date text with digits repaired; the first row of a value that is a real day.
DAYS = """{n}_g as (select *, list_filter(regexp_split_to_array(trim(regexp_replace(translate(upper(text), 'OQIL|ZSGB', '001112568'), '[^0-9./\\-\\s]', ' ', 'g')), '[-./\\s]+'), lambda x: x<>'') as g from {t}),
 {n}_d as (select *, unnest(case when len(g)=3 and length(g[1])=4 then [[g[3], g[2], g[1]]] when len(g)=3 then [g] when len(g)=2 and length(g[2])=3 then [[g[1], g[2][1:1], g[2][2:3]]] else [] end) as d from {n}_g),
 {n}_y as (select *, case when length(d[3])=2 then case when d[3]::int<=30 then 2000+d[3]::int else 1900+d[3]::int end else d[3]::int end as y from {n}_d),
 {n} as (select text, lpad(d[1]::int::varchar, 2, '0')||'-'||lpad(d[2]::int::varchar, 2, '0')||'-'||y::varchar as value from {n}_y
  where try_cast(lpad(y::varchar, 4, '0')||'-'||lpad(d[2]::int::varchar, 2, '0')||'-'||lpad(d[1]::int::varchar, 2, '0') as date) is not null)"""
CONFUSED = "length({c})-length(translate({c}, 'OQIL|ZSGB', ''))"
BIRTH = "(try_cast('19'||{c}[1:2]||'-'||{c}[3:4]||'-'||{c}[5:6] as date) is not null or try_cast('20'||{c}[1:2]||'-'||{c}[3:4]||'-'||{c}[5:6] as date) is not null)"
RETRIED = RETRIES.format(s="varchar", f=FIELDS, explode=", (select unnest([1, 2, 3, 4]) as a) e")
DECIDED = f"""fields as ({FIELDS}), retries as ({RETRIED}), facts as ({FACTS.format(f="fields")}),
 texts as (select rec, field, value as base, value as text, null::double as conf, null::varchar as variant from fields
  union all select r.rec, r.field, f.value, r.text, r.confidence, 'retry_'||r.variant from retries r join fields f on r.rec=f.rec and r.field=f.field where r.attempt<=3),
 each as (select distinct field, text from texts where text is not null),
 day_text as (select text from each where field='tarikh_nikah'), {DAYS.format(n="day", t="day_text")},
 ip as (select text, trim(regexp_replace(regexp_replace(upper(text), '[^A-Z0-9|./\\-\\s]', ' ', 'g'), '\\s+', ' ', 'g')) as p from each where field='ic_lama_suami'),
 ifo as (select *, regexp_replace(p, '[^A-Z0-9|]', '', 'g') as c, regexp_replace(p, '[\\s.-]+', '', 'g') as j from ip),
 ig as (select *, translate(c, 'OQIL|ZSGB', '001112568') as m, regexp_extract(c, '^([A-Z])?([A-Z0-9|]{{5,8}})([A-Z])?$', 2) as b,
  regexp_extract(c, '^([A-Z])?([A-Z0-9|]{{5,8}})([A-Z])?$', 1) as b1, regexp_extract(c, '^([A-Z])?([A-Z0-9|]{{5,8}})([A-Z])?$', 3) as b3 from ifo),
 ih as (select *, length(c)=12 and regexp_matches(m, '^\\d{{12}}$') and {BIRTH.format(c="m")} as modern, length(c)<>12 and regexp_matches(j, '^[A-Z]{{1,3}}(?:/[A-Z]{{1,3}})?\\d{{5,8}}$') as lettered,
  length(c)<>12 and regexp_matches(translate(b, 'OQIL|ZSGB', '001112568'), '^\\d+$') as plain from ig),
 ids as (select text, case when modern then m when lettered then j else b1||translate(b, 'OQIL|ZSGB', '001112568')||b3 end as value,
  case when modern then {CONFUSED.format(c="c")} when lettered then 0 else {CONFUSED.format(c="b")} end as n from ih where modern or lettered or plain),
 np as (select text, trim(regexp_replace(regexp_replace(upper(text), '[^A-Z0-9\\s.''/()@-]', ' ', 'g'), '\\s+', ' ', 'g')) as p from each where field='nama_suami'),
 nt as (select *, array_to_string(list_transform(string_split(p, ' '), lambda x: case when x in ('B1N', 'BJN', 'BLN') then 'BIN' else x end), ' ') as tok from np where p<>''),
 listed as (select field, text, trim(text) as value, 'original_ocr' as source, 'original_ocr' as correction_type, 0 as n, false as review, 1.0::double as similarity from each where trim(text)<>''
  union all select 'tarikh_nikah', text, value, case when {CONFUSED.format(c="upper(text)")}>0 then 'typo_rule' else 'safe_normalisation' end, case when {CONFUSED.format(c="upper(text)")}>0 then 'date_digit_confusion' else 'date_normalisation' end,
   {CONFUSED.format(c="upper(text)")}, false, greatest(0.0::double, 0.99::double-({CONFUSED.format(c="upper(text)")})*0.05::double) from day
  union all select 'ic_lama_suami', text, value, case when n>0 then 'typo_rule' else 'safe_normalisation' end, case when n>0 then 'digit_confusion' else 'safe_normalisation' end, n, false, greatest(0.0::double, 0.99::double-n*0.05::double) from ids
  union all select 'nama_suami', text, p, 'safe_normalisation', 'safe_normalisation', 0, false, 0.99::double from nt
  union all select 'nama_suami', text, tok, 'typo_rule', 'connector_typo', k, true, greatest(0.0::double, 0.99::double-k*0.05::double) from (select *, len(list_filter(list_zip(string_split(p, ' '), string_split(tok, ' ')), lambda z: z[1]<>z[2])) as k from nt where tok<>p)),
 judged as (select distinct field, value as text from listed union select field, value from fields where value is not null),
 good_text as (select text from judged where field='tarikh_nikah'), {DAYS.format(n="good_day", t="good_text")},
 good as (select field, text, case field when 'tarikh_nikah' then text in (select text from good_day)
   when 'ic_lama_suami' then case when regexp_matches(regexp_replace(upper(text), '[^A-Z0-9]', '', 'g'), '^\\d{{12}}$') then {BIRTH.format(c="regexp_replace(upper(text), '[^A-Z0-9]', '', 'g')")}
    else regexp_matches(regexp_replace(upper(text), '[ .]', '', 'g'), '^[A-Z]{{1,3}}(/[A-Z]{{1,3}})?\\d{{5,8}}$') or regexp_matches(regexp_replace(upper(text), '[^A-Z0-9]', '', 'g'), '^\\d{{5,8}}$') end
   else not regexp_matches(text, '[0-9]') end as ok from judged),
 cands as (select t.rec, t.field, t.base, l.value, coalesce(t.variant, l.source) as source, l.correction_type, l.n, l.review, l.similarity, t.conf,
   case when g.ok then 1.0 when t.field='nama_suami' then 0.25 else 0.0 end::double as validity, case when g.ok then 1.0 when t.field='nama_suami' then 0.35 else 0.0 end::double as plausibility,
   1.0::double-levenshtein(trim(t.base), l.value)/greatest(length(trim(t.base)), length(l.value))::double as ratio
  from texts t join listed l on t.field=l.field and t.text=l.text and (t.variant is null or l.source<>'original_ocr') join good g on g.field=l.field and g.text=l.value),
 scored as (select *, case when conf is null then validity*0.475::double+plausibility*0.375::double+greatest(similarity, ratio)*0.15::double+0.0::double+bonus
   else validity*0.35::double+plausibility*0.25::double+greatest(similarity, ratio)*0.15::double+conf*0.25::double+bonus end as score
  from (select *, (case when source like 'retry_%' then 0.10 when source='typo_rule' then -0.05 when source='safe_normalisation' then -0.02 else 0.0 end)::double as bonus from cands)),
 ranked as (select *, source like 'retry_%' as again, {{{{'score': score, 'value': value, 'source': source, 'kind': correction_type, 'review': review}}}} as pack,
  row_number() over (partition by rec, field order by score desc, review, n, validity desc, source, value) as place from scored),
 summed as (select rec, field, arg_min(pack, place) filter (not again) as initial, arg_min(pack, place) as overall, max(pack) filter (source='original_ocr') as original, count_if(again) as n_retry from ranked group by 1, 2),
 joined as (select f.rec, f.field, f.value as original_value, initial, overall, original, coalesce(n_retry, 0) as n_retry, x.has_crop, x.retry_count, x.retry_errors,
   trim(coalesce(f.value, ''))='' or not coalesce(g.ok, false) or coalesce(initial.source='typo_rule', false) as wanted
  from fields f left join summed s on f.rec=s.rec and f.field=s.field left join facts x on f.rec=x.rec and f.field=x.field left join good g on f.field=g.field and f.value=g.text),
 outcome as (select *, case when not wanted then 'accepted_without_retry' when not has_crop then 'missing_crop' when overall is null then 'no_valid_candidates'
   when n_retry>0 and overall.source like 'retry_%' and overall.score>=0.75::double and (overall.score-coalesce(original.score, 0.0::double)>=0.12::double or original is null) then 'accepted_after_retry'
   when n_retry>0 then 'retry_candidates_below_threshold' when retry_errors>0 then 'retry_ocr_failed' else 'accepted_without_retry' end as reason from joined),
 picked as (select *, case when not wanted then initial when reason in ('missing_crop', 'no_valid_candidates') then null when reason in ('accepted_after_retry', 'accepted_without_retry') then overall else coalesce(original, overall) end as s from outcome),
 decided as (select rec, field, original_value, coalesce(s.value, case when s is null then original_value end) as selected_value, coalesce(original.score, 0.0) as original_score, coalesce(s.score, 0.0) as selected_score,
  coalesce(s.kind, 'none') as correction_type, coalesce(s.source, 'none') as candidate_source, reason,
  s is null or reason in ('retry_candidates_below_threshold', 'retry_ocr_failed') or (wanted and reason='accepted_without_retry') or coalesce(s.review, false) as requires_review, retry_count from picked)"""
ROUNDED_SQL = "replace (round(original_score, 6) as original_score, round(selected_score, 6) as selected_score)"


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields, retries, facts = _refined(spark, sf_dir)
    decided = C.decide_fields(fields, retries, ["rec"], facts)
    return decided.withColumns({c: F.round(c, 6) for c in ("original_score", "selected_score")})


@query("c9_decide", f"with {DECIDED} select * {ROUNDED_SQL} from decided".replace("{{", "{").replace("}}", "}"))
def c9_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decisions(spark, sf_dir)


@query(
    "c10_audit_rows",
    f"""with {DECIDED} select 'batch_'||cast(rec%20 as varchar) as source_file, (rec%5+1)::int as page_number, rec as record_index, field as field_name, original_value, selected_value,
 original_score, selected_score, correction_type, candidate_source, reason, requires_review, 'crops/'||cast(rec as varchar)||'/'||field as crop_path, retry_count from (select * {ROUNDED_SQL} from decided)""".replace("{{", "{").replace("}}", "}"),
)
def c10_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _decisions(spark, sf_dir).withColumns(
        {
            "source_file": F.concat(F.lit("batch_"), (F.col("rec") % 20).cast("string")),
            "page_number": (F.col("rec") % 5 + 1).cast("int"),
            "record_index": F.col("rec"),
            "crop_path": F.concat_ws("/", F.lit("crops"), F.col("rec").cast("string"), F.col("field")),
        }
    )
    return C.audit_rows(named)


PRIORITY = tuple(str(n) for n in range(7, 0, -1))
FIRST = "select l_orderkey as doc, cast(l_linenumber as {s}) as field, min(l_returnflag) as value, min(l_tax)>0.03 as valid, min(l_discount) as confidence from lineitem group by 1, 2"
SECOND = "select l_orderkey as doc, cast(l_linenumber as {s}) as field, max(l_linestatus) as value, max(l_tax)>0.05 as valid, max(l_discount) as confidence from lineitem where l_quantity>10 group by 1, 2"


@query(
    "c11_prefer_retry",
    f"""with r as (select *, row_number() over (partition by doc order by 8-field::int) as turn from ({SECOND.format(s='varchar')})),
 j as (select o.*, r.value as rv, r.confidence as rc, coalesce(r.valid and (not o.valid or r.confidence>=o.confidence+0.05::double), false) as better from ({FIRST.format(s='varchar')}) o left join r on o.doc=r.doc and o.field=r.field and turn<=3)
 select doc, field, case when better then rv else value end as value, case when better then rc else confidence end as confidence, better or valid as valid, better as accepted_retry from j""",
)
def c11_prefer_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (fixtures.sql(spark, sf_dir, q.format(s="string")) for q in (FIRST, SECOND))
    return C.prefer_retry(first, second, ["doc"], PRIORITY, n=3)


AUDIT = "select p_partkey as rec, 'nama_suami' as field, p_brand as selected_value from part union all select p_partkey, 'ic_lama_suami', p_type from part union all select p_partkey, 'tarikh_nikah', cast(p_size as {s}) from part"
REVIEWED = "select p_partkey as rec, p_partkey%3=0 as verified, p_name as bundle, case when p_partkey%2=0 then p_brand||' ' else 'none' end as nama_suami, p_type as ic_lama_suami, cast(p_size+p_partkey%5 as {s}) as tarikh_nikah from part"


@query(
    "c12_exact_match_baseline",
    f"""with f as (select * from ({REVIEWED.format(s='varchar')}) where verified order by bundle, rec limit 25), u as (unpivot f on nama_suami, ic_lama_suami, tarikh_nikah into name field value reviewed_value),
 p as (select u.field, trim(selected_value)=trim(reviewed_value) as same from u join ({AUDIT.format(s='varchar')}) a on u.rec=a.rec and u.field=a.field)
 select count_if(same and field='nama_suami') as name_exact_match_count, count_if(same and field='ic_lama_suami') as id_exact_match_count, count_if(same and field='tarikh_nikah') as date_exact_match_count,
 (select count(*) from f) as record_count from p""",
)
def c12_exact_match_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit, reviewed = (fixtures.sql(spark, sf_dir, q.format(s="string")) for q in (AUDIT, REVIEWED))
    reviewed = reviewed.withColumn("rec_order", F.col("rec"))
    return C.exact_match_baseline(audit, reviewed, ["rec"], ["bundle", "rec_order"])
