"""Layout queries: the hourly event profile stands for a page profile, embeddings for boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge import fixtures
from recordforge.operators import geometry as G
from recordforge.queries import query

PAGE = ["page"]

RUNS = """runs as (select page, y, coverage, y - row_number() over (partition by page order by y) as island from fx_profile where coverage>={t}),
 r{t} as (select page, arg_min(y, (-coverage, y)) as y, max(coverage) as coverage, min(y) as run_start, max(y) as run_end from runs group by page, island)"""


@query("g1_threshold_runs", f"with {RUNS.format(t=4)} select * from r4")
def g1_threshold_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.threshold_runs(fixtures.view(spark, sf_dir, "fx_profile"), PAGE, 4)


DENSE = "select page, y, coverage, y%11 as x_min, y%11 + coverage*12 as x_max from fx_profile"


@query(
    "g2_marker_runs",
    f"""with d as (select *, y - row_number() over (partition by page order by y) as island from ({DENSE}) where coverage>=2),
 m as (select page, min(x_min) as x, min(y) as y, max(x_max)-min(x_min)+1 as width, max(y)-min(y)+1 as height from d group by page, island)
 select * from m where height>=3 and width>=60""",
)
def g2_marker_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.marker_runs(fixtures.sql(spark, sf_dir, DENSE), PAGE, 2, min_length=3, min_width=60)


MARKERS = "select page, y%7 as x, y, coverage*3 as width, coverage+y%5 as height from fx_profile where coverage>=4"
MERGED = f"""mk as ({MARKERS}), gr as (select *, sum(cut) over (partition by page order by y) as g from
 (select *, case when y - lag(y) over (partition by page order by y) <= 2 then 0 else 1 end as cut from mk)),
 merged as (select page, b.x as x, b.y as y, b.width as width, b.height as height from
 (select page, g, max({{'a': width*height, 'y': y, 'x': x, 'width': width, 'height': height}}) as b from gr group by page, g))"""


@query("g3_merge_close", f"with {MERGED} select * from merged")
def g3_merge_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.merge_close(fixtures.sql(spark, sf_dir, MARKERS), PAGE, 2)


# The time axis is stretched so that search windows and gaps (in pixels) are met and missed.
STRETCHED = "select page, y*40 as y from merged"
TABLE_SPAN = "select page, 0 as \"left\", min(y)*40-30 as top, 1000 as \"right\", max(y)*40+200 as bottom from fx_profile group by page"
STARTS = f"""{MERGED}, s as ({STRETCHED}), t as ({TABLE_SPAN}), ln as (select page, y*40-7 as y from fx_profile where coverage%5=1),
 i as (select s.page, s.y, row_number() over (partition by s.page order by s.y) as record_ix, count(*) over (partition by s.page) as n, t.top from s join t using (page)),
 a as (select i.page, record_ix, max(ln.y) as line_y from i join ln on i.page=ln.page and ln.y<i.y and i.y-ln.y<=140 group by all),
 st as (select i.page, record_ix, case when n=1 then greatest(top, i.y-20)
  when record_ix=1 and line_y is null and exists(select 1 from ln where ln.page=i.page and ln.y=i.top) then top
  else coalesce(line_y, greatest(top, i.y-20)) end as start from i left join a using (page, record_ix)),
 starts as (select page, record_ix, record_ix*60 + max(start-record_ix*60) over (partition by page order by record_ix) as start from st)"""


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.sql(spark, sf_dir, TABLE_SPAN.replace('"', "`"))


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = G.merge_close(fixtures.sql(spark, sf_dir, MARKERS), PAGE, 2).select("page", (F.col("y") * 40).alias("y"))
    lines = fixtures.sql(spark, sf_dir, "select page, y*40-7 as y from fx_profile where coverage%5=1")
    return G.record_starts(merged, lines, _tables(spark, sf_dir), PAGE, min_height=120)


@query("g4_record_starts", f"with {STARTS} select page, record_ix, start from starts")
def g4_record_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _starts(spark, sf_dir)


# Pages of one to seven markers, each with ruled lines above it.
PLACED = "select l_orderkey as page, cast(l_linenumber*130+l_partkey%61 as int) as y from lineitem"
RULED = "select l_orderkey as page, cast(l_linenumber*130+l_partkey%61-e.k*23-l_suppkey%19 as int) as y, cast((l_suppkey*7+e.k*131)%400 as int) as coverage from lineitem {explode} where l_partkey%11>0 and (l_suppkey+e.k)%3>0"
SPANS = "select l_orderkey as page, 0 as \"left\", 40+cast(l_orderkey%50 as int) as top, 900 as \"right\", cast(max(l_linenumber)*130+200+l_orderkey%170 as int) as bottom from lineitem group by l_orderkey"
BOTH_COSTS = """abs(m.y-c.start-20)*2.0::double + abs(({end}-c.start)::double-m.expected)*2.0::double + case when {end}-c.start<90 then 250.0+(120-({end}-c.start))*4.0 else 0 end::double
 + case when {end}-c.start>m.allowed then 120.0+({end}-c.start-m.allowed)*2.5 else 0 end::double + case when c.coverage is null then 25.0 else -c.coverage::double/120.0 end::double"""


@query(
    "g4_optimised_starts",
    f"""with recursive mk as ({PLACED}), ln as (select page, y, max(coverage) as coverage from ({RULED.format(explode='cross join (select unnest(range(8)) as k) e')}) group by 1, 2), t as ({SPANS}),
 i as (select *, row_number() over (partition by page order by y) as ix, count(*) over (partition by page) as n from mk join t using (page)),
 m as (select *, (bottom-top)/n::double as expected, greatest(200*1.5::double, (bottom-top)/n::double*1.25) as allowed from i),
 e as (select page, ix, m.y, l.y as start, coverage, row_number() over (partition by page, ix order by l.y desc) as place from m join ln l using (page) where l.y<m.y and m.y-l.y<=140),
 a as (select page, ix, greatest(top, y-20) as start from m union select page, ix, top from m where ix=1),
 ch as (select page, ix, start, coverage from e where place<=5
  union all select a.page, a.ix, a.start, l.coverage from a left join ln l on l.page=a.page and l.y=a.start where (a.page, a.ix) not in (select (page, ix) from e)),
 w(page, ix, start, cost, starts) as (select m.page, m.ix, c.start, round({BOTH_COSTS.format(end='m.bottom')}, 6), [c.start] from m join ch c on c.page=m.page and c.ix=m.ix where m.ix=m.n and m.n between 2 and 8 and c.start<m.y and m.bottom>c.start
  union all select page, ix, start, best.cost, best.starts from (select m.page, m.ix, c.start, min({{'cost': round(w.cost+{BOTH_COSTS.format(end='w.start')}, 6), 'starts': list_concat([c.start], w.starts)}}) as best
   from w join m on m.page=w.page and m.ix=w.ix-1 join ch c on c.page=m.page and c.ix=m.ix where c.start<m.y and w.start>c.start+60 group by 1, 2, 3)),
 whole as (select page, min({{'cost': cost, 'starts': starts}}).starts as starts from w where ix=1 group by 1),
 near as (select page, ix, max(start) as line_y from e group by 1, 2),
 s as (select m.page, m.ix, case when n=1 then greatest(top, m.y-20) when ix=1 and line_y is null and (m.page, top) in (select (page, y) from ln) then top else coalesce(line_y, greatest(top, m.y-20)) end as start
  from m left join near using (page, ix)),
 g as (select page, ix, ix*60+max(start-ix*60) over (partition by page order by ix) as start from s)
 select g.page, g.ix as record_ix, coalesce(whole.starts[g.ix], g.start)::bigint as start from g left join whole using (page)""",
)
def g4_optimised_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    markers = fixtures.sql(spark, sf_dir, PLACED)
    lines = fixtures.sql(spark, sf_dir, RULED.format(explode="lateral view explode(sequence(0, 7)) e as k"))
    tables = fixtures.sql(spark, sf_dir, SPANS.replace('"', "`"))
    found = G.optimised_starts(markers, lines, tables, PAGE, min_height=120, max_height=200)
    return found.select("page", F.col("record_ix").cast("long").alias("record_ix"), F.col("start").cast("long").alias("start"))


@query(
    "g5_record_boxes",
    f"""with {STARTS}, b as (select s.page, t."left", s.start as top, t."right", coalesce(lead(start) over (partition by s.page order by record_ix), t.bottom) as bottom
 from starts s join t using (page)), k as (select * from b where bottom-top>=90)
 select * from k union all select page, "left", top, "right", bottom from t where page not in (select page from k)""",
)
def g5_record_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.record_boxes(_starts(spark, sf_dir), _tables(spark, sf_dir), PAGE, min_height=180)


EDGE_TABLES = "select l_orderkey as page, 0 as left_x, cast(400+sum(l_linenumber)*50 as int) as right_x from lineitem group by 1"
EDGES = "select page, e as edge_ix, cast(floor(right_x*e/6) as int) as x from ({t}) q {explode}"
DETECTED = "select l_orderkey as page, cast(floor(l_extendedprice) as int)%900 as x from lineitem"


@query(
    "g6_snap_edges",
    f"""with t as ({EDGE_TABLES}), ex as ({EDGES.format(t=EDGE_TABLES, explode='cross join (select unnest(range(7)) as e) z')}), dt as (select distinct * from ({DETECTED})),
 n as (select ex.page, ex.edge_ix, arg_min(dt.x, (abs(dt.x-ex.x), dt.x)) as lx from ex join t using (page) join dt on dt.page=ex.page
  and abs(dt.x-ex.x)<=greatest(24, floor(right_x*0.03)) where ex.edge_ix between 1 and 5 group by all),
 s as (select ex.page, ex.edge_ix, coalesce(lx, ex.x) as x, greatest(18, floor(right_x*0.02))::int as g from ex join t using (page) left join n using (page, edge_ix))
 select page, edge_ix, edge_ix*g + max(x-edge_ix*g) over (partition by page order by edge_ix) as x from s""",
)
def g6_snap_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fixtures.sql(spark, sf_dir, EDGE_TABLES)
    edges = tables.select("page", "right_x", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("edge_ix")).select(
        "page", "edge_ix", F.floor(F.col("right_x") * F.col("edge_ix") / 6).cast("int").alias("x")
    )
    detected = fixtures.sql(spark, sf_dir, DETECTED)
    frame = tables.withColumnsRenamed({"left_x": "left", "right_x": "right"})
    return G.snap_edges(edges, detected, frame, PAGE)


COLUMNS = (("first", 0, 60), ("second", 60, 300), ("third", 300, 305), ("fourth", 305, 1000))
COLUMN_VALUES = ", ".join(f"('{n}', {l}, {r}, {3 if i == 0 else 4})" for i, (n, l, r) in enumerate(COLUMNS))
RECORDS = "select page_no, word_ix as record_ix, y1 as top, y1+1+word_ix%70 as bottom, 900 as page_width, 560 as page_height from fx_boxes"
GRID = f"""g as (select r.page_no, r.record_ix, c.cell, l, rr, top, greatest(bottom, top+1) as bottom, page_width as w, page_height as h,
 least(pad, greatest(0, (greatest(1, rr-l)-1)//2)) as px, least(pad, greatest(0, (greatest(1, bottom-top)-1)//2)) as py
 from ({RECORDS}) r cross join (values {COLUMN_VALUES}) as c(cell, l, rr, pad)),
 g2 as (select page_no, record_ix, cell, l+px as x1, top+py as y1, greatest(l+px+1, rr-px) as x2, greatest(top+py+1, bottom-py) as y2, w, h from g),
 g3 as (select *, least(greatest(x1, 0), w-1) as cx, least(greatest(y1, 0), h-1) as cy from g2),
 grid as (select page_no, record_ix, cell, cx as x1, cy as y1, least(greatest(x2, cx+1), w) as x2, least(greatest(y2, cy+1), h) as y2 from g3)"""


@query("g7_cell_grid", f"with {GRID} select * from grid")
def g7_cell_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.cell_grid(fixtures.sql(spark, sf_dir, RECORDS), COLUMNS, ["page_no", "record_ix"])


# Disjoint records of 100 pixels, and boxes as markers.
STRIPS = "select page_no, r as record_ix, r*100 as top, r*100+100 as bottom from (select distinct page_no from fx_boxes) p {explode}"


@query(
    "g8_assign_markers",
    f"""with r as ({STRIPS.format(explode='cross join (select unnest(range(8)) as r) z')}), m as (select page_no, x1 as marker_x, y1 as marker_y, y1+20 as centre from fx_boxes),
 h as (select r.page_no, r.record_ix, min((centre, marker_y, marker_x)) as b from r join m on r.page_no=m.page_no and centre>=top and centre<bottom group by all)
 select r.page_no, r.record_ix, r.top, r.bottom, b[3] as marker_x, b[2] as marker_y from r left join h using (page_no, record_ix)""",
)
def g8_assign_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fixtures.sql(spark, sf_dir, STRIPS.format(explode="lateral view explode(sequence(0, 7)) z as r"))
    boxes = fixtures.view(spark, sf_dir, "fx_boxes")
    markers = boxes.select("page_no", F.col("x1").alias("x"), F.col("y1").alias("y"), F.lit(40).alias("height"))
    return G.assign_markers(records, markers, ["page_no"]).select("page_no", "record_ix", "top", "bottom", "marker_x", "marker_y")


BOUNDED = """select page_no, word_ix, x1, y1, x2, y2, 620 as page_width, 580 as page_height, y1-word_ix%20 as row_top, y2+word_ix%17 as row_bottom,
 x1-word_ix%9 as col_left, x2+word_ix%30 as col_right from fx_boxes"""


@query(
    "g9_pad_clamp",
    f"""select page_no, word_ix, greatest(0, x1-12, col_left) as x1, greatest(0, y1-12, row_top) as y1,
 least(page_width, x2+12, col_right) as x2, least(page_height, y2+12, row_bottom) as y2 from ({BOUNDED})""",
)
def g9_pad_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.pad_clamp(fixtures.sql(spark, sf_dir, BOUNDED)).select("page_no", "word_ix", "x1", "y1", "x2", "y2")


LAYOUTS = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag<>'N' as marker_present, cast(floor(l_quantity) as int)%12 as cell_count, cast(floor(l_extendedprice) as int)%900 as record_height from lineitem"


@query(
    "g10_layout_confidence",
    f"""select *, greatest(0.0::double, least(1.0::double, 1.0::double - (case when marker_present then 0.0 else 0.35 end)::double - (case when cell_count<8 then 0.2 else 0.0 end)::double
 - (case when record_height<150 then 0.2 else 0.0 end)::double - (case when record_height>600 then 0.2 else 0.0 end)::double)) as layout_confidence from ({LAYOUTS})""",
)
def g10_layout_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.layout_confidence(fixtures.sql(spark, sf_dir, LAYOUTS), min_height=200, max_height=400)


CONTOURS = "select l_orderkey as page, cast(floor(l_quantity) as int) as x, l_linenumber as y, cast(floor(l_extendedprice) as int)%1000 as width, cast(l_partkey as int)%700 as height from lineitem"
SHEETS = "select o_orderkey as page, 1000 as page_width, 800 as page_height from orders"


@query(
    "g11_pick_table_box",
    f"""with b as (select page, arg_max({{'x': x, 'y': y, 'width': width, 'height': height}}, (width*height, -y, -x)) as b from ({CONTOURS}) c join ({SHEETS}) s using (page)
 where width>=page_width*0.5 and height>=page_height*0.35 and width*height>=page_width*page_height*0.15 group by page)
 select page, coalesce(b.x, 0) as x, coalesce(b.y, 0) as y, coalesce(b.width, page_width) as width, coalesce(b.height, page_height) as height from ({SHEETS}) s left join b using (page)""",
)
def g11_pick_table_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.pick_table_box(fixtures.sql(spark, sf_dir, CONTOURS), fixtures.sql(spark, sf_dir, SHEETS), PAGE)
