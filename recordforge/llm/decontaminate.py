"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle similarity.

Texts become runs of letters and digits in lower case, and these five-word shingles; a text of fewer words is one shingle.
A window has as many shingles as the benchmark item it is held against.  A window that reaches the similarity shares a
shingle with the item, so windows are laid where document and item agree on a shingle, aligned at it; all others can't
match and are not fingerprinted.  Each window gets the SimHash of its shingles with their multiplicities.  Fingerprints
are cut into eight blocks of eight bits; two within ``RADIUS`` = 23 bits have a block with at most two differing bits, so
looking every block up among the items' blocks with up to two bits flipped finds all within the radius (expected distance
at similarity 0.8: ten bits, at most 23 with a chance above 0.99999).  Candidates are verified exactly: the sum of the smaller
multiplicities over that of the larger ones, ``SIMILARITY`` or more.

Everything is DataFrame functions.  Documents are read once; their text never moves.  The shingle index of the benchmark is
broadcast only if it has at most ``BROADCAST_ROWS`` rows (16 bytes each), beyond that both sides are shuffled by shingle
and only window positions come back to the documents.  A passage on a third of all documents gives each of them a few windows,
merged within the task that reads the document; no document meets another.

Nulls and ties: a null or empty text, or item, has no shingle and leaks nothing.  Equal items are one, reported by the
smallest item_id (null ids last).  Rows with the same doc_id are reported together; the best window wins, of equals the
earliest that was laid.  A repeated row repeats nothing.  Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.functions.text import let
from recordforge.llm.common import free_name, saved, table
from recordforge.llm.registry import query

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
BROADCAST_ROWS = 1_000_000


def shingled(df: DataFrame, text: str, out: str = "hs") -> DataFrame:
    """``df`` with the array ``out`` of shingle hashes, repeats included, in order."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")

    def hashes(w: F.Column) -> F.Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*(w[i + k] for k in range(SHINGLE))))
        whole = F.array(F.xxhash64(F.array_join(w, " "), F.lit("whole")))
        return F.when(F.size(w) >= SHINGLE, runs).when(F.size(w) > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return df.withColumn(out, let(words, hashes))


def simhash(hs: F.Column) -> F.Column:
    """64-bit SimHash: a bit is one if more than half of the hashes have it, each as often as it occurs."""
    ones = lambda b: F.size(F.filter(hs, lambda h: F.getbit(h, b) == 1))
    bit = lambda b: F.when(2 * ones(b) > F.size(hs), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda fp, b: fp.bitwiseOR(bit(b)))


def occurrences(hs: F.Column) -> F.Column:
    """The hashes with later occurrences told apart, so that sets of them have multiset intersections."""
    seen = lambda x, i: F.size(F.filter(F.slice(hs, F.lit(1), i), lambda y: y == x))
    told = F.transform(hs, lambda x, i: F.when(seen(x, i) == 0, x).otherwise(F.xxhash64(x, seen(x, i))))
    return F.when(F.size(F.array_distinct(hs)) == F.size(hs), hs).otherwise(told)


def _block(fp: F.Column, k: int) -> F.Column:
    return F.shiftrightunsigned(fp, 8 * k).bitwiseAND(F.lit(255)).cast("int")


#: Masks of up to two flipped bits of a block.
FLIPS = [0, *(1 << i for i in range(8)), *(1 << i | 1 << j for i in range(8) for j in range(i))]


def item_table(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, hs, n, fp, tagged): distinct items that have a shingle."""
    items = shingled(benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")), "text")
    items = items.where(F.col("text").rlike(r"[\p{L}\p{N}]"))
    items = items.groupBy("hs").agg(F.min("item_id").alias("item_id")).withColumn("n", F.size("hs"))
    return items.select("item_id", "hs", "n", simhash(F.col("hs")).alias("fp"), occurrences(F.col("hs")).alias("tagged"))


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc, tag, start, n, win): item-sized windows of (doc, tag, hs) aligned with a shingle that an item of that size has."""
    index = items.select("n", F.posexplode_outer("hs").alias("off", "h")).distinct()
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("off"), F.size("hs") - F.col("n")))
    window = F.slice("hs", F.col("start") + 1, F.col("n"))
    if index.count() <= BROADCAST_ROWS:
        rows = docs.select("doc", "tag", "hs", F.posexplode_outer("hs").alias("pos", "h")).join(F.broadcast(index), "h")
        return rows.withColumn("start", start).groupBy("doc", "tag", "start", "n").agg(F.first(window).alias("win"))
    size = F.size("hs").alias("size")
    rows = docs.select("doc", "tag", size, F.posexplode_outer("hs").alias("pos", "h")).join(index, "h")
    starts = rows.withColumn("start", F.greatest(F.lit(0), F.least(F.col("pos") - F.col("off"), F.col("size") - F.col("n"))))
    starts = starts.groupBy("tag").agg(F.collect_set(F.struct("start", "n")).alias("at"))
    return docs.join(starts, "tag").select("doc", "tag", "hs", F.inline("at")).select("doc", "tag", "start", "n", window.alias("win")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, tag, item_id, similarity, start, distance): of each document and item the best window that reaches ``similarity``.

    ``tag`` is a hash of the text; ``start`` counts shingles from 0; ``distance`` is that of the fingerprints.
    """
    items = saved(item_table(benchmark))
    hashed = shingled(docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(text)).alias("tag"), F.col(text).alias("text")), "text").drop("text")
    found = saved(windows(hashed, items))
    marked = found.withColumn("fp", simhash(F.col("win"))).withColumn("tagged", occurrences(F.col("win")))
    keys = F.array(*(F.struct(F.lit(k).alias("block"), _block(F.col("fp"), k).alias("value")) for k in range(BLOCKS)))
    probes = F.explode(F.array(*(F.lit(m) for m in FLIPS)))
    near = items.select("item_id", "n", "fp", "tagged", F.inline(keys)).select(
        F.col("item_id"), F.col("n"), F.col("fp").alias("item_fp"), F.col("tagged").alias("item_tagged"), "block", "value", probes.alias("flip")
    )
    near = near.select("item_id", "n", "item_fp", "item_tagged", "block", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    pairs = marked.select("doc", "tag", "start", "n", "fp", "tagged", F.inline(keys)).join(near, ["n", "block", "value"])
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    pairs = pairs.withColumn("distance", apart).where(F.col("distance") <= RADIUS)
    both = F.size(F.array_intersect("tagged", "item_tagged"))
    alike = both / (F.size("tagged") + F.size("item_tagged") - both)
    pairs = pairs.withColumn("similarity", alike).where(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "distance"))
    pairs = pairs.groupBy("doc", "tag", "item_id").agg(best.alias("best"))
    return pairs.select(
        F.col("doc").alias("doc_id"), "tag", "item_id", "best.similarity", (-F.col("best.before")).alias("start"), F.col("best.distance").cast("int").alias("distance")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; the columns they came with."""
    mark = free_name(docs, "tag")
    bad = leaks(docs, benchmark, doc_id, text).select(F.col("tag").alias(mark)).distinct()
    return docs.withColumn(mark, F.xxhash64(F.col(text))).join(bad, mark, "left_anti").select(*docs.columns)


@query(
    "op5_decontamination",
    r"""with doc_words as (select doc_id, hash(text) as tag, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents),
item_words as (select item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from benchmark),
ds as (select doc_id, case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
  when len(w) > 0 then ['whole ' || list_aggregate(w, 'string_agg', ' ')] else [] end as hs from doc_words),
i0 as (select item_id, case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' '))
  when len(w) > 0 then ['whole ' || list_aggregate(w, 'string_agg', ' ')] else [] end as hs from item_words),
its as (select min(item_id) as item_id, hs, len(hs) as n from i0 where len(hs) > 0 group by hs),
idx as (select distinct n, unnest(hs) as h, generate_subscripts(hs, 1) - 1 as off from its),
dx as (select doc_id, hs, unnest(hs) as h, generate_subscripts(hs, 1) - 1 as pos from ds),
win as (select distinct doc_id, n, greatest(0, least(pos - off, len(hs) - n)) as start, hs from dx join idx using (h)),
pairs as (select doc_id, item_id, start, list_slice(win.hs, start + 1, start + win.n) as a, its.hs as b from win join its using (n)),
told as (select doc_id, item_id, start,
  list_transform(range(1, len(a) + 1), lambda i: a[i] || '#' || len(list_filter(a[1:i], lambda y: y = a[i]))) as a,
  list_transform(range(1, len(b) + 1), lambda i: b[i] || '#' || len(list_filter(b[1:i], lambda y: y = b[i]))) as b from pairs where list_has_any(a, b)),
sim as (select doc_id, item_id, start, len(list_intersect(a, b))::double / (len(a) + len(b) - len(list_intersect(a, b))) as similarity from told)
select doc_id, item_id, max(similarity) as similarity, arg_min(start, [-similarity, start])::int as start from sim where similarity >= 0.8 group by doc_id, item_id""",
)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item it holds, with similarity and place."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start")
