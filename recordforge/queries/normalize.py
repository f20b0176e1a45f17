"""Text normalisation over the whole texts of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.functions.rules import RuleTable
from recordforge.operators import normalize as N
from recordforge.queries import query

# Misread connectors and abbreviations are put into every text by the same replacements in both engines.
NOISY = """select doc_id, lang, replace(replace(replace(replace(replace(text, ' the ', ' b1n '), ' de ', ' BINT1  '), ' of ', ' hj. '), ' un ', ' kg.x mohd. '), ' der ', ' 8in bjn ') as text from documents"""
EDGE_L, EDGE_R = "(^|[^\\p{L}\\p{N}_])", "($|[^\\p{L}\\p{N}_])"


def twice(text: str, pattern: str, replacement: str) -> str:
    """Neighbouring words share an edge, so RE2 needs a second pass where look-around needs none."""
    once = f"regexp_replace({text}, '{EDGE_L}{pattern}{EDGE_R}', '{replacement}', 'g')"
    return f"regexp_replace({once}, '{EDGE_L}{pattern}{EDGE_R}', '{replacement}', 'g')"


UPPER = "replace(upper({c}), 'ẞ', 'SS')"


def normalised(column: str) -> str:
    text = f"regexp_replace(replace({UPPER.format(c=column)}, chr(13), chr(10)), '[ \\t]+', ' ', 'g')"
    text = twice(text, "(?:B1N|8IN|BJN)", "\\1BIN\\2")
    text = twice(text, "(?:BINT1|B1NTI|8INTI)", "\\1BINTI\\2")
    text = twice(text, "(BT|BTE|HJ|HJH|MOHD|KG)\\.", "\\1\\2\\3")
    return f"trim({text}, ' ' || chr(9) || chr(10) || chr(13))"


@query("n1_normalise_text", f"select doc_id, {normalised('text')} as text from ({NOISY})")
def n1_normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalise_text(fixtures.sql(spark, sf_dir, NOISY), ["text"]).select("doc_id", "text")


@query("n2_repair_digits", "select rec, translate(date_text, 'OoIl|SB', '0011158') as date_text, translate(money_text, 'OoIl|SB', '0011158') as money_text from fx_strings")
def n2_repair_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["date_text", "money_text"]
    return N.repair_digits(fixtures.view(spark, sf_dir, "fx_strings"), cols).select("rec", *cols)


ID_NOISE = "select rec, lower(replace(replace(id_text, '1', 'I'), '10', 'IO')) || '  s5 ' || substr(money_text, 4) as id_text from fx_strings"


@query(
    "n3_repair_ids",
    f"""with v as (select rec, trim(regexp_replace(regexp_replace({normalised('id_text')}, '[^A-Z0-9./\\-\\s]', ' ', 'g'), '\\s+', ' ', 'g')) as t from ({ID_NOISE})),
 p as (select rec, regexp_extract_all(t, '(\\s+|[./-]|[^\\s./-]+)') as parts from v)
 select rec, trim(array_to_string(list_transform(parts, lambda x: case
 when length(x)=1 and regexp_matches(x, '^[A-Z./ -]$') then x
 when length(x)>1 and regexp_matches(x, '^[A-Z].*[0-9]') then x[1] || translate(x[2:], 'OoQqIl|SB', '000011158')
 else translate(x, 'OoQqIl|SB', '000011158') end), '')) as id_text from p""",
)
def n3_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.repair_ids(fixtures.sql(spark, sf_dir, ID_NOISE), ["id_text"])


@query(
    "n4_clean_names",
    f"""with v as (select doc_id, regexp_replace({normalised('text')}, '[^A-Z\\s.''/()-]', ' ', 'g') as t from ({NOISY})),
 w as (select doc_id, trim(regexp_replace(regexp_replace(t, '\\b(?:TAHUN|TAHN|TAHUH|THN|RM|NO|NIKAH|KELUAR)\\b', ' ', 'g'), '\\s+', ' ', 'g')) as t from v)
 select doc_id, nullif(case when t like '%.' and length(replace(string_split(t, ' ')[-1], '.', ''))>3 then rtrim(t, '.') else t end, '') as text from w""",
)
def n4_clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.clean_names(fixtures.sql(spark, sf_dir, NOISY), ["text"]).select("doc_id", "text")


@query(
    "n5_split_lines",
    f"""with l as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace({UPPER.format(c='x')}, '\\s+', ' ', 'g'))), lambda x: x<>'') as ls from documents)
 select doc_id, unnest(range(len(ls)))::int as line_ix, unnest(ls) as line from l""",
)
def n5_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.split_lines(fixtures.sql(spark, sf_dir, "select doc_id, text from documents"), "text")


TOKENS = {"the": "THE", "de": "OF", "un": "ONE"}
PATTERNS = (("[0-9]+", "#"), ("[.]{2,}", "."))


@query(
    "n6_apply_token_rules",
    """select doc_id, regexp_replace(regexp_replace(array_to_string(list_transform(string_split(text, ' '),
 lambda t: case t when 'the' then 'THE' when 'de' then 'OF' when 'un' then 'ONE' else t end), ' '), '[0-9]+', '#', 'g'), '[.]{2,}', '.', 'g') as text from documents""",
)
def n6_apply_token_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixtures.sql(spark, sf_dir, "select doc_id, text from documents")
    return N.apply_token_rules(docs, ["text"], TOKENS, PATTERNS)


PHRASES = "select 'type' as field, p_type as phrase, upper(p_type)||' *' as replacement from part where p_size>25 group by p_type"
VALUES = "select p_partkey as rec, 'type' as field, p_type as value from part union all select p_partkey, 'brand', p_brand from part"


@query(
    "n7_apply_phrase_rules",
    f"select v.rec, v.field, coalesce(r.replacement, v.value) as value from ({VALUES}) v left join ({PHRASES}) r on v.field=r.field and v.value=r.phrase",
)
def n7_apply_phrase_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.apply_phrase_rules(fixtures.sql(spark, sf_dir, VALUES), fixtures.sql(spark, sf_dir, PHRASES)).select("rec", "field", "value")


@query(
    "n6_rule_table",
    """select p_partkey as rec, case when p_name='hot gear' then 'fixed' else regexp_replace(w[1]||' '||upper(w[2]), 'G[A-Z]+R', 'GxR', 'g') end as value
 from (select p_partkey, p_name, string_split(p_name, ' ') as w from part)""",
)
def n6_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts by a table of rules: the nouns in capitals, then a pattern, then one whole value."""
    rules = fixtures.sql(
        spark, sf_dir,
        """select distinct 'name' as field, 'token' as kind, split(p_name, ' ')[1] as pattern, upper(split(p_name, ' ')[1]) as value, 1 as place from part
 union all select 'name', 'pattern', 'G[A-Z]+R', 'GxR', 2 union all select 'name', 'phrase', 'hot GxR', 'fixed', 3
 union all select 'name', 'phrase', 'hot GxR', 'never', 4 union all select 'brand', 'pattern', '[A-Z]', '', 1""",
    )
    values = fixtures.sql(spark, sf_dir, "select p_partkey as rec, p_name as value from part")
    return N.apply_rules(values, RuleTable.read(rules), {"value": "name"})


VOCABULARY = ("URGENT", "HIGH", "MEDIUM", "LOW", "NOT SPECIFIED")
MISREAD = "select o_orderkey as rec, case o_orderkey%4 when 0 then replace(o_orderpriority, 'E', 'F') when 1 then replace(o_orderpriority, 'I', 'L') when 2 then lower(o_orderpriority) else o_orderpriority||'X' end as value from orders"


@query(
    "n8_snap_vocabulary",
    f"""with l as (select rec, value, trim(regexp_replace(regexp_replace(upper(value), '[^A-Z ]', ' ', 'g'), '\\s+', ' ', 'g')) as t from ({MISREAD})),
 s as (select rec, value, t, v, case when greatest(length(t), length(v))=0 then 1.0::double else 1.0::double - levenshtein(t, v)/greatest(length(t), length(v))::double end as ratio
  from l cross join (values {', '.join(f"('{v}')" for v in VOCABULARY)}) as vo(v)),
 b as (select rec, value, t, max((ratio, v)) as b from s group by all)
 select rec, value, case when t='' then null when t in {VOCABULARY} then t when b[1]>=0.72 then b[2] end as snapped from b""",
)
def n8_snap_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.snap_vocabulary(fixtures.sql(spark, sf_dir, MISREAD), "value", VOCABULARY)


# The longest common block of two parts of texts, the first in the left text, then in the right one, and both sides of it again.
BLOCK = """coalesce(list_max(flatten(list_transform(range(al, ah), lambda i: list_transform(range(bl, bh), lambda j:
 {'k': coalesce(list_max(list_filter(range(1, least(ah-i, bh-j)+1), lambda k: a[i+1:i+k]=b[j+1:j+k])), 0), 'i': -i, 'j': -j})))), {'k': 0, 'i': 0, 'j': 0})"""
RATIOS = f"""parts(a, b, al, ah, bl, bh) as (select a, b, 0::bigint, length(a)::bigint, 0::bigint, length(b)::bigint from pairs
 union all select a, b, c.al, c.ah, c.bl, c.bh from (select a, b, unnest([{{'al': al, 'ah': -m.i, 'bl': bl, 'bh': -m.j}}, {{'al': -m.i+m.k, 'ah': ah, 'bl': -m.j+m.k, 'bh': bh}}]) as c
  from (select *, {BLOCK} as m from parts where al<ah and bl<bh) where m.k>0)),
 ratios as (select a, b, case when length(a)+length(b)=0 then 1.0::double else 2.0::double*sum(case when al<ah and bl<bh then {BLOCK}.k else 0 end)/(length(a)+length(b)) end as ratio from parts group by a, b)"""


@query(
    "n8_snap_vocabulary_gestalt",
    f"""with recursive l as (select rec, value, trim(regexp_replace(regexp_replace(upper(value), '[^A-Z ]', ' ', 'g'), '\\s+', ' ', 'g')) as t from ({MISREAD})),
 pairs as (select distinct v as a, t as b from l cross join (values {', '.join(f"('{v}')" for v in VOCABULARY)}) as vo(v)), {RATIOS},
 best as (select b as t, max((ratio, a)) as m from ratios group by b)
 select rec, value, case when l.t='' then null when l.t in {VOCABULARY} then l.t when m[1]>=0.72 then m[2] end as snapped from l join best on l.t=best.t""",
)
def n8_snap_vocabulary_gestalt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.snap_vocabulary(fixtures.sql(spark, sf_dir, MISREAD), "value", VOCABULARY, metric="gestalt")


# Printed labels are put in front of every line and into it, again by the same text in both engines.
LABELLED = """select doc_id, ln, ' nama : ' || replace(replace(line, ' the ', ' umur: '), ' de ', ' : NO. SIRI ') as line from (select doc_id, ln, line from {src}) t"""
SPARK_LINES = "documents lateral view posexplode(split(text, '\\n')) a as ln, line"
DUCK_LINES = "(select doc_id, unnest(range(len(p))) as ln, unnest(p) as line from (select doc_id, string_split(text, chr(10)) as p from documents))"
NOISE = "(?i)(?:NO\\.?\\s*SIRI|NO\\.?\\s*SIN|UMUR|BANGSA|WARGANEGARA|ALAMAT|PENDAFTAR|HUBUNGAN|SAKSI\\s+PERTAMA|SAKSI\\s+KEDUA)"


def stripped(column: str) -> str:
    body = f"trim(regexp_replace(replace(regexp_replace({column}, '(?i)^\\s*(nama\\s*:?\\s*)', ''), ':', ' '), '[ \\t]+', ' ', 'g'))"
    body = f"trim(regexp_replace({body}, '(^|[^\\p{{L}}\\p{{N}}_]){NOISE}($|[^\\p{{L}}\\p{{N}}_].*$)', '\\1'))"
    return f"trim(regexp_replace({body}, '[ \\t]+', ' ', 'g'), ' ,')"


@query("n9_strip_labels", f"select doc_id, ln::int as ln, {stripped('line')} as line from ({LABELLED.format(src=DUCK_LINES)})")
def n9_strip_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.strip_labels(fixtures.sql(spark, sf_dir, LABELLED.format(src=SPARK_LINES)), "line", "nama_suami")


# One printed label for each field that has one, as it may stand on a form, and as the rule knows it.
PRINTED = (
    ("nama_suami", "Nama", "nama"), ("nama_isteri", "NAMA ", "nama"), ("nama_pendaftar", "nama", "nama"), ("nama_wali", " Nama", "nama"), ("hubungan_wali", "Hubungan", "hubungan"),
    ("saksi_1", "Saksi 1", "saksi\\s*1"), ("saksi_2", "saksi2", "saksi\\s*2"), ("tarikh_nikah", "Tarikh  Nikah", "tarikh\\s*nikah"), ("alamat_pendaftar", "ALAMAT", "alamat"),
    ("mas_kahwin", "Mas kahwin", "mas\\s*kahwin"),
)
ENDS = ("umur", "No. Siri", "NO SIN", "bangsa", "Warganegara", "alamat", "Pendaftar", "hubungan", "saksi  pertama", "SAKSI KEDUA")


def _cases(values: list[str]) -> str:
    return " ".join(f"when {i} then {value}" for i, value in enumerate(values))


FORM_LINES = f"""select doc_id, cast(doc_id%10 as int) as kind, case doc_id%10 {_cases([f"'{label}'" for _, label, _ in PRINTED])} end || case when doc_id%3=0 then ': ' else ' ' end
 || 'ab' || '  ' || cast(n_chars as {{s}}) || case when doc_id%4<3 then ' ' || case doc_id%11 {_cases([f"'{end}'" for end in ENDS])} else 'umurnya' end || ' cd' else ',' end as line from documents"""


@query(
    "n9_strip_all_labels",
    f"select doc_id, case kind {_cases([stripped('line').replace('(nama', '(' + rule) for _, _, rule in PRINTED])} end as line from ({FORM_LINES.format(s='varchar')})",
)
def n9_strip_all_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of each field in front of a value, and labels of other fields behind it."""
    lines = fixtures.sql(spark, sf_dir, FORM_LINES.format(s="string"))
    cleaned = F.coalesce(*[F.when(F.col("kind") == i, N.strip_label(F.col("line"), field)) for i, (field, _, _) in enumerate(PRINTED)])
    return lines.select("doc_id", cleaned.alias("line"))


@query(
    "n10_best_line",
    f"""with c as (select doc_id, ln, {stripped('trim(line)')} as line from {DUCK_LINES} t),
 s as (select *, {UPPER.format(c='line')} as u, len(regexp_extract_all({UPPER.format(c='line')}, '[A-Z@'']+')) as words, regexp_matches(line, '[0-9]') as digit from c where line<>''),
 r as (select *, words - (case when digit then 5 else 0 end) - (case when regexp_matches(u, '{"|".join(N.LOCATION_WORDS)}') then 3 else 0 end)
  + {' + '.join(f"(case when contains(u, '{h}') then 2 else 0 end)" for h in N.NAME_HINTS['nama_suami'])} as score from s),
 b as (select doc_id, max((not digit, score, words, -length(line), -ln, line)) as b from r group by 1)
 select d.doc_id, nullif(trim(regexp_replace(b.b[6], '\\s+', ' ', 'g'), ' ,'), '') as text from documents d left join b using (doc_id)""",
)
def n10_best_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.best_lines(fixtures.sql(spark, sf_dir, "select doc_id, text from documents"), "text", "nama_suami")
