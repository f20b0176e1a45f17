"""Line dedup by distinct-site spread.

A line that occurs on many sites is boilerplate.  Every task sketches, for each line hash it sees, the sites in a HyperLogLog;
sketches merge in the aggregation, so a line on a third of all pages moves one small sketch per task.  Where the estimate is
within ``BAND`` of the threshold, the distinct sites are counted exactly; so the decision is that of exact counts as long as no
estimate is off by more than the band, which is over five standard errors (below about a hundred sites the sketch is
exact anyway).

Lines are compared without white space at their ends.  A line shorter than ``min_words`` words is never boilerplate: short
lines recur by chance.  Flagged lines go whatever their share of a page.  Only in copies, pages whose whole sequence of lines is on
several sites, a flagged line has to be on ``min_sites`` sites even if all copies of a page count as one page on one site.  So the
text of a page that many sites copy isn't lost as its own boilerplate; its copies are left to near-duplicate removal.

Thresholds are absolute.  With the defaults of the query and the pipeline, lines on two to nine sites and lines of one or two words
always stay, and a corpus of fewer than ten sites keeps all its lines: smaller corpora need a smaller ``min_sites``.

Everything is DataFrame functions.  Line texts never leave the scan: what is written and shuffled are hashes and sketches, and once the
documents with their flagged positions.  The table of boilerplate lines is broadcast if it has at most ``BROADCAST_ROWS`` rows
of 8 bytes; beyond that it is joined by line hash, where AQE splits frequent lines.

Nulls: a null text stays null, an empty one empty; neither has lines.  A null site counts for none.  Rows with the same
doc_id and text count as one page each, and all get the same result.  Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.llm.common import free_name, saved, table
from recordforge.llm.registry import query

MIN_SITES = 10
MIN_WORDS = 3
LG_K = 11
BAND = 0.12
BROADCAST_ROWS = 1_000_000


def _lines(text: F.Column) -> F.Column:
    return F.split(text, "\n")


def _trimmed(line: F.Column) -> F.Column:
    return F.trim(F.translate(line, "\t\r\x0b\x0c", "    "))


def line_rows(docs: DataFrame, key: str, text: str, site: str, min_words: int) -> DataFrame:
    """(doc, site, pos, h): every line of at least ``min_words`` words, by its 64-bit hash."""
    rows = docs.select(F.col(key).alias("doc"), F.col(site).cast("string").alias("site"), F.posexplode(_lines(F.col(text))).alias("pos", "line"))
    rows = rows.withColumn("line", _trimmed(F.col("line")))
    enough = F.col("line").rlike(r"^\S+(?:\s+\S+){" + str(min_words - 1) + "}") if min_words > 0 else F.col("line") != ""
    return rows.where(enough).select("doc", "site", "pos", F.xxhash64("line").alias("h"))


def boilerplate(rows: DataFrame, min_sites: int) -> DataFrame:
    """(h): the lines of (h, site) on at least ``min_sites`` distinct sites."""
    sketches = rows.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    spread = saved(sketches.select("h", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites * (1 - BAND) - 1))
    near = F.col("sites") <= min_sites * (1 + BAND) + 1
    # Sites of a line are made distinct before anything is dealt by line, so that a frequent line is a few rows.
    close, pairs = spread.where(near).select("h"), rows.select("h", "site")
    if close.count() <= BROADCAST_ROWS:
        pairs = pairs.join(F.broadcast(close), "h", "left_semi").distinct()
    else:
        pairs = saved(pairs.distinct()).join(close, "h", "left_semi")
    counted = pairs.groupBy("h").agg(F.count("site").alias("sites"))
    return saved(spread.where(~near).select("h").unionByName(counted.where(F.col("sites") >= min_sites).select("h")))


def copied_pages(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """(doc, least): the documents whose whole sequence of lines is on several sites, and the smallest of these."""
    pages = docs.select(F.col(key).alias("doc"), F.col(site).cast("string").alias("site"), F.xxhash64(F.transform(_lines(F.col(text)), _trimmed)).alias("page"))
    # The smallest and the largest site tell whether there are several, and merge in every task.
    copied = saved(pages.groupBy("page").agg(F.min("site").alias("least"), F.max("site").alias("most")).where("least < most").select("page", "least"))
    return pages.join(F.broadcast(copied) if copied.count() <= BROADCAST_ROWS else copied, "page").select("doc", "least").distinct()


def beyond_copies(hits: DataFrame, copied: DataFrame, min_sites: int) -> DataFrame:
    """``hits`` without those in copies that are only flagged because of the copies."""
    hits = saved(hits.join(copied, "doc", "left"))
    spread = hits.where("least is null or site = least").select("h", "site").distinct()
    own = saved(spread.groupBy("h").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites).select("h"))
    kept = hits.where("least is not null").join(F.broadcast(own) if own.count() <= BROADCAST_ROWS else own, "h", "left_semi")
    return hits.where("least is null").unionByName(kept)


def flagged_lines(docs: DataFrame, key: str, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, flagged array of positions): what is boilerplate in each document that has any.  ``key`` is unique."""
    # Hashes are read three times, the texts they come from once.
    rows = saved(line_rows(docs, key, text, site, min_words))
    found = boilerplate(rows, min_sites)
    hits = rows.join(F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, "h")
    hits = beyond_copies(hits, copied_pages(docs, key, text, site), min_sites)
    return hits.groupBy("doc").agg(F.collect_set("pos").alias("flagged"))


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    site: str = "source",
    key: str = "doc_id",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    details: bool = False,
) -> DataFrame:
    """``docs`` without cross-site boilerplate lines in ``text``.

    ``details`` adds n_lines and n_removed.  Documents are told apart by ``key`` and a hash of the text, so
    that repeated keys do no harm.
    """
    tag = free_name(docs, "page")
    pages = docs.withColumn(tag, F.xxhash64(F.col(key), F.col(text), F.col(site)))
    found = flagged_lines(pages.select(tag, text, site), tag, text, site, min_sites, min_words)
    flagged, line = free_name(docs, "flagged"), _lines(F.col(text))
    joined = pages.join(found.select(F.col("doc").alias(tag), F.col("flagged").alias(flagged)), tag, "left")
    some = F.col(flagged).isNotNull()
    kept = F.array_join(F.filter(line, lambda x, i: ~F.array_contains(F.col(flagged), i)), "\n")
    out = {text: F.when(some, kept).otherwise(F.col(text))}
    if details:
        size = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(line)).cast("long")
        out |= {"n_lines": size, "n_removed": F.when(some, F.size(F.col(flagged))).otherwise(F.lit(0)).cast("long")}
    return joined.withColumns(out).select(*docs.columns, *(["n_lines", "n_removed"] if details else []))


LINES_SQL = r"""line_rows as (select doc_id, text, source, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as pos from {docs}),
trimmed as (select doc_id, text, source, pos, raw, trim(translate(raw, chr(9) || chr(13) || chr(11) || chr(12), '    ')) as line from line_rows),
whole as (select text, list_transform(string_split(text, chr(10)), lambda x: trim(translate(x, chr(9) || chr(13) || chr(11) || chr(12), '    '))) as page, source from {docs} where text is not null),
copied as (select page, min(source) as least from whole group by page having min(source) < max(source)),
copies as (select distinct text, least from whole join copied using (page)),
long_enough as (select t.*, c.least, regexp_matches(line, '^\S+(?:\s+\S+){{2}}') as counts from trimmed t left join copies c on t.text = c.text),
spread as (select line from long_enough where counts group by line having count(distinct source) >= 10),
own as (select line from long_enough where counts and (least is null or source = least) group by line having count(distinct source) >= 10),
marked as (select l.*, l.counts and s.line is not null and (l.least is null or o.line is not null) as flag
  from long_enough l left join spread s on l.line = s.line left join own o on l.line = o.line),
pages as (select doc_id, text, source, count(*) as n_lines, count(*) filter (flag) as n_removed, string_agg(raw, chr(10) order by pos) filter (not flag) as rest
  from (select distinct * from marked) group by doc_id, text, source)"""


@query(
    "op8_line_dedup",
    "with " + LINES_SQL.format(docs="documents") + """
select d.doc_id, coalesce(p.n_lines, 0)::bigint as n_lines, coalesce(p.n_removed, 0)::bigint as n_removed,
  sha256(case when p.n_removed > 0 then coalesce(p.rest, '') else d.text end) as text_sha256
from documents d left join pages p on d.doc_id is not distinct from p.doc_id and d.text = p.text and d.source is not distinct from p.source""",
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document its lines, those removed as cross-site boilerplate, and the digest of what is left.

    Lines of at least 3 words on at least 10 sites count, about half of the sites of a table with 20.
    """
    cleaned = dedup_lines(table(spark, sf_dir, "documents"), details=True)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
