"""Word-table queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.functions.scan import ordered_scan, steps
from recordforge.operators import words as W
from recordforge.queries import query
from recordforge.session import cut, stored

TEXTED_BOXES = "select page_no, word_ix, 'W'||cast(word_ix%2 as {s}) as text, x1, y1, x2, y2 from fx_boxes"

IOU_SQL = """(case when least({a}.x2,{b}.x2)>greatest({a}.x1,{b}.x1) and least({a}.y2,{b}.y2)>greatest({a}.y1,{b}.y1)
 then (least({a}.x2,{b}.x2)-greatest({a}.x1,{b}.x1))::double*(least({a}.y2,{b}.y2)-greatest({a}.y1,{b}.y1)) else 0.0 end)"""


def texted_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.sql(spark, sf_dir, TEXTED_BOXES.format(s="string"))


@query(
    "w1_duplicate_pairs",
    f"""with w as ({TEXTED_BOXES.format(s='varchar')}), u as (select page_no, text, x1, y1, x2, y2, min(word_ix) as word_ix from w group by all),
 p as (select a.page_no, a.text as text_key, a.word_ix, b.word_ix as duplicate_ix, {IOU_SQL.format(a='a', b='b')} as inter
 from u a join u b on a.page_no=b.page_no and a.text=b.text and a.word_ix<b.word_ix)
 select page_no, text_key, word_ix, duplicate_ix, inter/(4800.0-inter) as iou from p where inter/(4800.0-inter)>=0.5
 union all select page_no, text, u.word_ix, w.word_ix, 1.0 from w join u using (page_no, text, x1, y1, x2, y2) where w.word_ix>u.word_ix""",
)
def w1_duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.duplicate_pairs(texted_boxes(spark, sf_dir), ["page_no"])


@query(
    "w1_dedupe_words",
    f"""with w as ({TEXTED_BOXES.format(s='varchar')}),
 g as (select page_no, text, list_reduce(list([{{'ix': word_ix, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}] order by word_ix),
  lambda acc, x: case when len(list_filter(acc, lambda k: {IOU_SQL.format(a='k', b='x[1]')}
   / (4800.0 - {IOU_SQL.format(a='k', b='x[1]')}) >= 0.5)) > 0 then acc else list_concat(acc, x) end) as kept from w group by 1,2)
 select page_no, text, unnest(list_transform(kept, lambda k: k.ix)) as word_ix from g""",
)
def w1_dedupe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.dedupe_words(texted_boxes(spark, sf_dir), ["page_no"]).select("page_no", "text", "word_ix")


CELL_BOXES = "select page_no, word_ix as record_ix, 'cell_'||cast(word_ix%3 as {s}) as cell, x1-40 as x1, y1-40 as y1, x1+140 as x2, y1+80 as y2 from fx_boxes"


@query(
    "w2_assign_words",
    f"""with c as ({CELL_BOXES.format(s='varchar')})
 select w.page_no, c.record_ix, c.cell, w.word_ix from fx_boxes w join c on w.page_no=c.page_no
 where (((w.x1+w.x2)/2.0 between c.x1 and c.x2) and ((w.y1+w.y2)/2.0 between c.y1 and c.y2))
 or {IOU_SQL.format(a='w', b='c')}/2400.0 >= 0.45""",
)
def w2_assign_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = fixtures.view(spark, sf_dir, "fx_boxes")
    cells = fixtures.sql(spark, sf_dir, CELL_BOXES.format(s="string"))
    return W.assign_words(words, cells, ["page_no"]).select("page_no", "record_ix", "cell", "word_ix")


# Words shaken by up to two pixels, so that order and tolerance matter.
SHAKEN = "select doc_id, word_ix, text, confidence, x1, y1+(tn*7)%3 as y1, x2, y2+(tn*7)%3 as y2 from fx_words"
LAG_LINES = """select *, sum(cut) over (partition by doc_id order by {order} rows unbounded preceding) as line_no from
 (select *, case when abs((y1+y2)/2 - lag((y1+y2)/2) over (partition by doc_id order by {order})) <= {tol} then 0 else 1 end as cut from ({source}) s) t"""


@query(
    "w3_group_lines_px",
    f"""select doc_id, word_ix, cast(line_no as bigint) as segment, 0 as part from ({LAG_LINES.format(order='y1, x1, word_ix', tol=10, source=SHAKEN)})""",
)
def w3_group_lines_px(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = fixtures.sql(spark, sf_dir, SHAKEN)
    return W.group_lines_px(words, ["doc_id"]).select("doc_id", "word_ix", F.col("segment").cast("long").alias("segment"), "part")


# Here one line in three is shifted by half a line, so that neighbouring lines touch.
TOUCHING = "select doc_id, word_ix, text, x1, y1+(ln%3)*5+(tn*7)%3 as y1, x2, y2+(ln%3)*5+(tn*7)%3 as y2 from fx_words"


@query(
    "w3b_group_lines_gap",
    f"""select doc_id, word_ix, cast(line_no as bigint) as line_no from ({LAG_LINES.format(order='y1, x1, word_ix', tol=1.0, source=TOUCHING)})""",
)
def w3b_group_lines_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Packed lines of word numbers, read again for their number of parts.
    lines = stored(W.line_runs_gap(fixtures.sql(spark, sf_dir, TOUCHING), ["doc_id"], 1.0))
    # Number the lines of each document from the (segment, part) pairs.
    parts = lines.groupBy("doc_id", "segment").agg((F.max("part") + 1).alias("parts"))
    before = ordered_scan(parts, ["doc_id"], ["segment"], [steps("segment", 4096)], total={"upto": F.col("parts")})
    number = (F.col("upto") - F.col("parts") + F.col("part") + 1).cast("long").alias("line_no")
    return lines.join(before, ["doc_id", "segment"]).select("doc_id", F.explode("word_ix").alias("word_ix"), number)


@query(
    "w4_cell_text",
    """select doc_id, string_agg(text, chr(10) order by ln) as text, round(avg(confidence), 6) as avg_conf, count(*) as n_lines,
 min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2
 from (select doc_id, ln, string_agg(text, ' ' order by x1) as text, avg(confidence) as confidence, min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2
 from fx_words group by 1, 2) group by 1""",
)
def w4_cell_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = W.cell_text(fixtures.view(spark, sf_dir, "fx_words"), ["doc_id"], ["ln"])
    edge = lambda i, f: f(F.transform("lines", lambda l: l["bbox"][i]))
    return cells.select(
        "doc_id", "text", F.round("avg_conf", 6).alias("avg_conf"), F.size("lines").cast("long").alias("n_lines"),
        edge(0, F.array_min).alias("x1"), edge(1, F.array_min).alias("y1"), edge(2, F.array_max).alias("x2"), edge(3, F.array_max).alias("y2"),
    )


UNIT = "select doc_id, page_no, word_ix, text, confidence, x1/60000 as x1, y1/2100 as y1, x2/60000 as x2, y2/2100 as y2 from fx_words"


@query(
    "w5_group_lines_unit",
    f"""select doc_id, word_ix, cast(line_no as bigint) as segment, 0 as part from ({LAG_LINES.format(order='(y1+y2)/2, x1, word_ix', tol=0.008, source=UNIT)})""",
)
def w5_group_lines_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = fixtures.sql(spark, sf_dir, UNIT)
    return W.group_lines_unit(words, ["doc_id"]).select("doc_id", "word_ix", F.col("segment").cast("long").alias("segment"), "part")


# Blocks of six lines by forty words in which neighbouring lines touch, so that lines come from the fold over running means.
BLOCKS = """select doc_id, cast(floor(ln/6) as int) as page_no, cast(floor(tn/40) as int) as col_no, word_ix, text, x1, y1+(ln%3)*5+(tn*7)%3 as y1, x2,
 y2+(ln%3)*5+(tn*7)%3 as y2 from fx_words"""
FOLD_SQL = """with w as (select *, (y1+y2)/2.0 as cy from ({source}) t),
 f as (select doc_id, page_no, col_no, list_reduce(list([{{'ix': word_ix, 'cy': cy, 'line': 0::bigint, 'total': cy, 'n': 1}}] order by {order}), lambda acc, x: list_concat(acc,
  [case when abs(x[1].cy - acc[-1].total/acc[-1].n) > {tol} then {{'ix': x[1].ix, 'cy': x[1].cy, 'line': acc[-1].line+1, 'total': x[1].cy, 'n': 1}}
   else {{'ix': x[1].ix, 'cy': x[1].cy, 'line': acc[-1].line, 'total': acc[-1].total+x[1].cy, 'n': acc[-1].n+1}} end])) as k from w group by 1, 2, 3)
 select doc_id, page_no, col_no, unnest(list_transform(k, lambda r: r.ix)) as word_ix, unnest(list_transform(k, lambda r: r.line)) as line_no from f"""
BLOCK_KEYS = ["doc_id", "page_no", "col_no"]


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines of each block by number; a block has at most 240 words."""
    place = F.dense_rank().over(Window.partitionBy(*BLOCK_KEYS).orderBy("segment", "part"))
    return lines.withColumn("line_no", (place - 1).cast("long")).select(*BLOCK_KEYS, F.explode("word_ix").alias("word_ix"), "line_no")


@query("w3_group_lines_fold", FOLD_SQL.format(source=BLOCKS, order="y1, x1, word_ix", tol="10.0"))
def w3_group_lines_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(W.line_runs_px(fixtures.sql(spark, sf_dir, BLOCKS), BLOCK_KEYS))


@query("w5_group_lines_fold", FOLD_SQL.format(source=BLOCKS, order="cy, x1, word_ix", tol="6.0"))
def w5_group_lines_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(W.line_runs_unit(fixtures.sql(spark, sf_dir, BLOCKS), BLOCK_KEYS, tolerance=6.0))


REGIONS = (
    W.Region("title", 1, 0.0, 0.0, 0.01, 0.02),
    W.Region("left", 1, 0.0, 0.05, 0.005, 0.9),
    W.Region("middle", 1, 0.02, 0.2, 0.03, 0.6),
    W.Region("foot", 1, 0.0, 0.7, 0.5, 1.0),
)
REGION_VALUES = ", ".join(f"('{r.field}', {r.page_no}, {r.x1}::double, {r.y1}::double, {r.x2}::double, {r.y2}::double)" for r in REGIONS)
REGION_SQL = f"(values {REGION_VALUES}) as r(field, page_no, x1, y1, x2, y2)"


@query(
    "w6_words_in_regions",
    f"""select w.doc_id, r.field, w.word_ix from ({UNIT}) w join {REGION_SQL} on w.page_no=r.page_no
 where (w.x1+w.x2)/2 between greatest(0, r.x1-0.01::double) and least(1, r.x2+0.01::double)
 and (w.y1+w.y2)/2 between greatest(0, r.y1-0.01::double) and least(1, r.y2+0.01::double)""",
)
def w6_words_in_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.words_in_regions(fixtures.sql(spark, sf_dir, UNIT), REGIONS).select("doc_id", "field", "word_ix")


ANCHORS = (
    W.Anchor(1, "of the", 0.001, 0.002),
    W.Anchor(1, "de la", 0.001, 0.01),
    W.Anchor(1, "der", 0.0, 0.02),
    W.Anchor(1, "and", 0.002, 0.05),
    W.Anchor(1, "los", 0.001, 0.06),
    W.Anchor(1, "que de la", 0.002, 0.1),
)
ANCHOR_VALUES = ", ".join(
    f"({i}, '{a.phrase}', [{', '.join(repr(t) for t in a.phrase.upper().split())}], {a.x}::double, {a.y}::double)" for i, a in enumerate(ANCHORS)
)
MATCH_SQL = f"""tok as (select doc_id, page_no, x1, y1, word_ix, k, token from (select doc_id, page_no, x1, y1, word_ix, unnest(range(len(t))) as k, unnest(t) as token from
 (select *, list_filter(string_split(regexp_replace(replace(upper(text), 'ẞ', 'SS'), '[^A-Z0-9]+', ' ', 'g'), ' '), lambda z: z<>'') as t from ({UNIT})))),
 seq as (select *, lead(token, 1) over w as t1, lead(token, 2) over w as t2, row_number() over w as pos from tok window w as (partition by doc_id, page_no order by y1, x1, word_ix, k)),
 anchors(anchor_ix, phrase, toks, ex, ey) as (values {ANCHOR_VALUES}),
 hit as (select s.*, a.* from seq s join anchors a on s.token=a.toks[1] and (len(a.toks)<2 or s.t1=a.toks[2]) and (len(a.toks)<3 or s.t2=a.toks[3])),
 m as (select doc_id, page_no, anchor_ix, phrase, ex as expected_x, ey as expected_y, arg_min(x1, pos) as observed_x, arg_min(y1, pos) as observed_y from hit group by all)"""


@query("w7_match_phrases", f"with {MATCH_SQL} select * from m")
def w7_match_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.match_phrases(fixtures.sql(spark, sf_dir, UNIT), ANCHORS)


TRANSFORM_SQL = f"""{MATCH_SQL},
 pages as (select distinct doc_id, 1 as page_no from documents),
 d as (select doc_id, page_no, median(observed_x-expected_x) as dx, median(observed_y-expected_y) as dy from m group by all),
 r as (select a.doc_id, a.page_no, median(abs(b.observed_y-a.observed_y)/abs(b.expected_y-a.expected_y)) as ratio from m a join m b
  on a.doc_id=b.doc_id and a.page_no=b.page_no and a.anchor_ix<b.anchor_ix and a.expected_y<>b.expected_y group by all),
 t as (select p.doc_id, p.page_no, coalesce(dx, 0) as dx, coalesce(dy, 0) as dy, 1.0::double as sx,
  case when ratio is null or ratio<0.98 or ratio>1.02 then 1.0::double else ratio end as sy, ratio, dx is not null as located
  from pages p left join d using (doc_id, page_no) left join r using (doc_id, page_no)),
 tr as (select *, located and abs(dx)<=0.05 and abs(dy)<=0.05 and sy between 0.95 and 1.05 as safe from t)"""


def _transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = fixtures.sql(spark, sf_dir, UNIT)
    pages = fixtures.sql(spark, sf_dir, "select doc_id, 1 as page_no, n_chars as n_words from documents")
    return W.estimate_transform(pages, W.match_phrases(words, ANCHORS))


@query(
    "w8_estimate_transform",
    f"""with {TRANSFORM_SQL} select doc_id, page_no, dx, dy, sx, sy, safe, array_to_string(list_filter([
 case when not located then 'no anchor matches found' end,
 case when located and (ratio<0.98 or ratio>1.02) then printf('scale_y clamped from %.4f', floor(ratio*10000+0.5)/10000) end,
 case when located and not safe then printf('unsafe transform dx=%.4f dy=%.4f scale_x=%.4f scale_y=%.4f', floor(dx*10000+0.5)/10000, floor(dy*10000+0.5)/10000, 1.0, floor(sy*10000+0.5)/10000) end], lambda z: z is not null), '; ') as diagnostics from tr""",
)
def w8_estimate_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transforms(spark, sf_dir).withColumn("diagnostics", F.array_join("diagnostics", "; "))


@query(
    "w9_apply_transform",
    f"""with {TRANSFORM_SQL} select doc_id, tr.page_no, r.field, r.x1*sx+dx as x1, r.y1*(case when safe then sy else 1.0 end)+dy as y1,
 r.x2*sx+dx as x2, r.y2*(case when safe then sy else 1.0 end)+dy as y2 from tr join {REGION_SQL} on tr.page_no=r.page_no""",
)
def w9_apply_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.apply_transform(_transforms(spark, sf_dir), REGIONS)


PAGE_SIZES = "select doc_id, 1 as page_no, case when doc_id%3=0 then null when doc_id%3=1 then 0 else 5000 end as width, case when doc_id%2=0 then 3000 end as height from documents"


@query(
    "w10_normalise_boxes",
    f"""with e as (select doc_id, max(x2) as mx, max(y2) as my from fx_words group by 1), p as ({PAGE_SIZES})
 select w.doc_id, word_ix, x1/s.w as x1, y1/s.h as y1, x2/s.w as x2, y2/s.h as y2 from fx_words w
 join (select doc_id, coalesce(nullif(width, 0), nullif(mx, 0), 1)::double as w, coalesce(nullif(height, 0), nullif(my, 0), 1)::double as h from e join p using (doc_id)) s on w.doc_id=s.doc_id""",
)
def w10_normalise_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = fixtures.view(spark, sf_dir, "fx_words")
    pages = fixtures.sql(spark, sf_dir, PAGE_SIZES)
    return W.normalise_boxes(words, pages).select("doc_id", "word_ix", "x1", "y1", "x2", "y2")


@query(
    "w11_fields_from_regions",
    f"""with {TRANSFORM_SQL},
 placed as (select doc_id, tr.page_no, r.field, r.x1*sx+dx as x1, r.y1*(case when safe then sy else 1.0 end)+dy as y1,
  r.x2*sx+dx as x2, r.y2*(case when safe then sy else 1.0 end)+dy as y2 from tr join {REGION_SQL} on tr.page_no=r.page_no),
 hits as (select w.*, p.field from ({UNIT}) w join placed p on w.doc_id=p.doc_id and w.page_no=p.page_no
  where (w.x1+w.x2)/2 between greatest(0, p.x1-0.01::double) and least(1, p.x2+0.01::double)
  and (w.y1+w.y2)/2 between greatest(0, p.y1-0.01::double) and least(1, p.y2+0.01::double)),
 lines as (select *, sum(cut) over (partition by doc_id, field order by (y1+y2)/2, x1, word_ix rows unbounded preceding) as line_no from
  (select *, case when abs((y1+y2)/2 - lag((y1+y2)/2) over (partition by doc_id, field order by (y1+y2)/2, x1, word_ix)) <= 0.008 then 0 else 1 end as cut from hits)),
 txt as (select doc_id, field, string_agg(t, chr(10) order by line_no) as raw_text from
  (select doc_id, field, line_no, string_agg(text, ' ' order by x1) as t from lines group by all) group by all),
 cf as (select doc_id, field, avg(confidence) as confidence from hits group by all)
 select p.doc_id, p.page_no, p.field, coalesce(raw_text, '') as raw_text, round(coalesce(confidence, 0), 6) as confidence
 from placed p left join txt using (doc_id, field) left join cf using (doc_id, field)""",
)
def w11_fields_from_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One small row per page, read by several branches; so are the words of the regions, which are found once.
    fields = W.fields_from_regions(fixtures.sql(spark, sf_dir, UNIT), cut(_transforms(spark, sf_dir)), REGIONS, cut=stored)
    return fields.select("doc_id", "page_no", "field", "raw_text", F.round("confidence", 6).alias("confidence"))


SECOND_READING = "select doc_id, record_ix, cell, case when record_ix%2=0 then text||' '||text else '' end as text, cast((doc_id*13+record_ix*29)%100 as double)/100 as avg_conf from fx_cells where (doc_id+record_ix)%5<>0"
FIRST_READING = "select doc_id, record_ix, cell, case doc_id%4 when 0 then ' ' when 1 then substr(text, 1, cast(1+(doc_id+record_ix)%5 as int)) else text end as text, avg_conf from fx_cells"


@query(
    "w12_choose_cell_source",
    f"""with j as (select p.*, f.text as f_text, f.avg_conf as f_conf from ({FIRST_READING}) p left join ({SECOND_READING}) f using (doc_id, record_ix, cell)),
 k as (select *, coalesce(cell in ('user','assistant') and (trim(text)='' or avg_conf<0.60 or (cell='user' and length(trim(text))<4) or (cell='assistant' and length(trim(text))<2)) and f_conf is not null and
 ((trim(f_text)<>'' and trim(text)='') or f_conf>=avg_conf+0.10::double or (length(trim(f_text))>length(trim(text))*1.5 and f_conf>=0.50)), false) as take from j)
 select doc_id, record_ix, cell, case when take then f_text else text end as text, case when take then f_conf else avg_conf end as avg_conf,
 case when take then 'fallback' else 'primary' end as cell_source from k""",
)
def w12_choose_cell_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = fixtures.sql(spark, sf_dir, FIRST_READING)
    second = fixtures.sql(spark, sf_dir, SECOND_READING)
    return W.choose_cell_source(first, second, important=["user", "assistant"], date_cells=["user"], serial_cells=["assistant"])


PAGE_RESULTS = "select conv_id as doc_id, cast(turn as int) as page_no, role='user' as has_ocr, case when turn%7=3 then 'page '||cast(turn as {s})||' failed' end as error from conversations"


@query(
    "w13_page_completeness",
    f"""with g as (select doc_id, count(*) as page_count, count_if(has_ocr) as ocr_pages, coalesce(string_agg(error, '; ' order by page_no), '') as page_errors
 from ({PAGE_RESULTS.format(s='varchar')}) group by 1)
 select *, case when page_count<>2 then 'expected exactly 2 pages, found '||page_count when page_errors<>'' then page_errors when ocr_pages<page_count then 'missing OCR result' end as document_error from g""",
)
def w13_page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.page_completeness(fixtures.sql(spark, sf_dir, PAGE_RESULTS.format(s="string")))
