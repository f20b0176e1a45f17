"""Exact top-k inner products with multi-resolution segment statistics.

A vector is cut into 1, 4 and 16 segments.  With segment means m and deviations s, the part of two vectors in a segment of
length l is at least sqrt(l * ((m - m')^2 + (s - s')^2)) apart, so the squared distance has a lower bound, and with
|q|^2 + |c|^2 - d^2 = 2 qc the inner product an upper bound: the sum of l * (m m' + s s').  A candidate whose bound, coarse to fine,
stays below the k-th best score found so far can't be among the k best; exact scores are computed for the survivors only.

Layout: queries are dealt into groups of about ``GROUP``, candidates into shards of about ``SHARD`` rows; task (group, shard)
holds its group and streams its shard past it in blocks, keeping k scores for each query, and the k best of all shards are
merged at the end.  What moves is queries times shards plus rows times groups, never a pair; a common vector is only a tie.

Results: components x become floor(256 x).  Vectors that are null, or hold null or non-finite components, take no part;
vectors of different lengths are not compared.  Ties go to the smaller id.  Rows with a null id are no queries and no
candidates.  If a query's id is on several rows, the smallest vector counts as the query; each candidate row counts by itself,
those with the query's own id never.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordforge.llm.common import table
from recordforge.llm.registry import query

GROUP = 8_192
SHARD = 16_384
STREAM = 2_048
SEGMENTS = (1, 4, 16)
#: A product of k components up to this size stays exact in a double.
EXACT = 2.0**53
#: Score of a place that is still free; its negative is a number, too.
NOTHING = -(2**63 - 1)


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Rows (sqrt(l) mean, sqrt(l) deviation) of each segment: the inner product of two such rows bounds that of the vectors."""
    n, width = vectors.shape
    edges = np.linspace(0, width, min(segments, max(width, 1)) + 1).astype(int)
    out = []
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        part = vectors[:, i:j].astype(np.float64)
        root = math.sqrt(max(j - i, 1))
        out += [part.mean(axis=1) * root, part.std(axis=1) * root] if j > i else [np.zeros(n), np.zeros(n)]
    return np.stack(out, axis=1) if out else np.zeros((n, 2))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; whole numbers in doubles while they stay exact there, else int64."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Best:
    """The k best (score, id) so far of a group of queries of one vector length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [segment_statistics(vectors, s) for s in SEGMENTS]
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.score = np.full((len(ids), k), NOTHING)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        rows, cols = np.arange(len(self.ids)), np.arange(len(ids))
        least = self.score[:, -1].astype(np.float64)
        if (self.score[:, -1] > NOTHING).any():
            # Rounding of the bounds is far below this part of the product of the norms.
            slack = 1 + 1e-9 * self.norms.max() * np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=0))
            for level, segments in zip(self.levels, SEGMENTS, strict=True):
                alive = level[rows] @ segment_statistics(vectors[cols], segments).T + slack >= least[rows, None]
                rows, cols = rows[alive.any(axis=1)], cols[alive.any(axis=0)]
                if not len(rows) or not len(cols):
                    return
        exact = scores(self.vectors[rows], vectors[cols])
        own = self.ids[rows][:, None] == ids[cols][None, :]
        exact[own] = NOTHING
        if exact.shape[1] > self.k:
            # Of each row all that reach its k-th best; ties beyond k are settled by id below.
            kth = np.partition(exact, exact.shape[1] - self.k, axis=1)[:, -self.k]
        else:
            kth = exact.min(axis=1)
        at, to = np.nonzero((exact >= np.maximum(kth, self.score[rows, -1])[:, None]) & ~own)
        query = np.concatenate((rows[at], np.repeat(rows, self.k)))
        score = np.concatenate((exact[at, to], self.score[rows].ravel()))
        found = np.concatenate((ids[cols[to]], self.found[rows].ravel()))
        order = np.lexsort((found, -score, query))
        query, score, found = query[order], score[order], found[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        self.score[query[keep], rank[keep]] = score[keep]
        self.found[query[keep], rank[keep]] = found[keep]

    def rows(self) -> pa.RecordBatch:
        at, rank = np.nonzero(self.score > NOTHING)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[at]), pa.array(self.found[at, rank]), pa.array(self.score[at, rank])], names=["query_id", "vec_id", "score"]
        )


def _matrix(column: pa.ListArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.int64)


def _search(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (group, shard, candidate, dim, id, vector), sorted: of each task's group and length first queries, then candidates."""
    task, best = None, None
    ids: list[np.ndarray] = []
    vectors: list[np.ndarray] = []

    def close() -> Iterator[pa.RecordBatch]:
        if best is not None:
            yield best.rows()

    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            group, shard, dim, candidate = keys[:, i].tolist()
            if (group, shard, dim) != task:
                yield from close()
                task, best, ids, vectors = (group, shard, dim), None, [], []
            for a in range(i, j, STREAM):
                part = batch.slice(a, min(STREAM, j - a))
                if not candidate:
                    ids.append(part.column(4).to_numpy())
                    vectors.append(_matrix(part.column(5)).reshape(part.num_rows, dim))
                    continue
                if best is None:
                    if not ids:
                        continue
                    best = Best(np.concatenate(ids), np.concatenate(vectors), k)
                best.offer(part.column(4).to_numpy(), _matrix(part.column(5)).reshape(part.num_rows, dim))
    yield from close()


def whole_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, vector array<bigint>, dim): usable rows, components as floor(256 x)."""
    x = F.col(embedding).cast("array<double>")
    usable = F.col(vec_id).isNotNull() & x.isNotNull() & F.forall(x, lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return df.where(usable).select(F.col(vec_id).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * 256).cast("long")).alias("vector"), F.size(x).alias("dim"))


def top_k(df: DataFrame, is_query: F.Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` rows of ``df`` with the highest inner products for each row that ``is_query``: query_id, rank, vec_id, score."""
    rows = whole_vectors(df, vec_id, embedding)
    queries = whole_vectors(df.where(is_query), vec_id, embedding).groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    counts = df.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    groups, shards = max(1, -(-counts["q"] // GROUP)), max(1, -(-counts["n"] // SHARD))
    deal = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"), deal(shards).alias("shard"), "dim", F.lit(0).alias("candidate"), "id", "vector")
    right = rows.select(deal(groups).alias("group"), F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "dim", F.lit(1).alias("candidate"), "id", "vector")
    tasks = left.unionByName(right).repartition(groups * shards, "group", "shard").sortWithinPartitions("group", "shard", "dim", "candidate")
    found = tasks.mapInArrow(partial(_search, k=k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query(
    "op10_top_k",
    """with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
q as (select * from v where vec_id % 50 = 0),
s as (select q.vec_id as query_id, v.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * v.v[i]))::bigint as score
  from q join v on q.vec_id <> v.vec_id and len(q.v) = len(v.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5""",
)
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every row whose id is divisible by 50, against all rows."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
