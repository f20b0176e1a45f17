"""Serial number repair on the derived serial table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordforge import fixtures
from recordforge.functions.scan import steps
from recordforge.operators import sequence as Q
from recordforge.queries import query

BATCH = ["batch_id"]

# Every 13th serial shows a letter instead of a digit, and the remark names a calendar year.
NOISY = """select batch_id, k, case when k%13=0 then replace(observed, '0', 'O') else observed end as observed,
 'seen '||cast(1980+k%17 as {s})||' and '||cast(2000+batch_id as {s}) as remark from fx_serials"""

PLACED = f"p as (select *, row_number() over (partition by batch_id order by k)-1 as row_ix from ({NOISY.format(s='varchar')}))"
CANDIDATES = """c as (select batch_id, row_ix, case when length(d)>3 and d[1]='4' then substr(d, 1, 3)::int else d::int end as candidate from
 (select batch_id, row_ix, unnest(regexp_extract_all(translate(upper(coalesce(observed, '')), 'OQSIL', '00511'), '\\b\\d{3,5}\\b')) as d from p)),
 cc as (select * from c where candidate between 100 and 9999)"""
START = """v as (select batch_id, candidate-row_ix as start_number, count(*) as votes from cc group by all),
 s as (select batch_id, start_number, votes from (select *, row_number() over (partition by batch_id order by votes desc, start_number) as r from v) where r=1)"""
YEAR = """y0 as (select batch_id, row_ix, 0 as src, unnest(list_zip(regexp_extract_all(observed, '/\\s*(\\d{2,4})\\b', 1), range(9))) as z from p),
 y1 as (select batch_id, row_ix, 1 as src, unnest(list_zip(regexp_extract_all(remark, '\\b(?:19|20)(\\d{2})\\b', 1), range(9))) as z from p),
 ya as (select batch_id, row_ix, src, z[2] as nth, right(z[1], 2) as year, case src when 0 then 5 else 1 end as w from (select * from y0 union all select * from y1) where z[1] is not null),
 yv as (select batch_id, year, sum(w) as votes, min((row_ix, src, nth)) as seen from ya group by all),
 y as (select batch_id, year, cast(votes as bigint) as votes from (select *, row_number() over (partition by batch_id order by votes desc, seen) as r from yv) where r=1)"""
REPAIRED = """rep as (select p.batch_id, p.k, p.observed, case when start_number is null then observed when year is null then cast(start_number+row_ix as varchar)
 else cast(start_number+row_ix as varchar)||'/'||year end as repaired from p left join s using (batch_id) left join y using (batch_id))"""


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.positions(fixtures.sql(spark, sf_dir, NOISY.format(s="string")), BATCH, ["k"], [steps("k", 65536)])


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _placed(spark, sf_dir)
    starts = Q.infer_start(Q.serial_candidates(placed, ["observed"], BATCH), BATCH)
    years = Q.infer_year(placed, BATCH, ["observed"], ["remark"])
    return Q.repair_sequence(placed, BATCH, "observed", starts, years)


@query("q1_serial_candidates", f"with {PLACED}, {CANDIDATES} select * from cc")
def q1_serial_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.serial_candidates(_placed(spark, sf_dir), ["observed"], BATCH)


@query("q2_infer_start", f"with {PLACED}, {CANDIDATES}, {START} select * from s")
def q2_infer_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.infer_start(Q.serial_candidates(_placed(spark, sf_dir), ["observed"], BATCH), BATCH)


@query("q3_infer_year", f"with {PLACED}, {YEAR} select * from y")
def q3_infer_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.infer_year(_placed(spark, sf_dir), BATCH, ["observed"], ["remark"])


@query("q4_repair_sequence", f"with {PLACED}, {CANDIDATES}, {START}, {YEAR}, {REPAIRED} select * from rep")
def q4_repair_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir).select("batch_id", "k", "observed", "repaired")


@query("q5_sequence_gaps", f"with {PLACED}, {CANDIDATES}, {START}, {YEAR}, {REPAIRED} select * from rep where observed is distinct from repaired")
def q5_sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.sequence_gaps(_repaired(spark, sf_dir), "observed").select("batch_id", "k", "observed", "repaired")
