"""Hard negatives by segment summaries: rows of another label that score almost as high as a positive of the anchor.

Every vector is stored with the mean and the deviation of each of 16 segments; those of 4 segments and of one follow by pooling.
Over a segment of length l the product of two vectors lies within l * (m m' - s s') and l * (m m' + s s'), so sums over the segments
bound the score from both sides.  A pair whose bounds, coarse to fine, miss every range of scores that its anchor still asks for is
dropped; the others get their exact score.  An anchor asks for ranges: first one of all scores within its own label, for its
``positives`` best rows; then, for each positive found, the scores from ``least`` to ``most`` hundredths of the positive's
among the other labels.  A range closes from below as soon as as many rows are found as are wanted; in each block of candidates
the pairs of highest bounds are scored first, so that it closes early.

Layout: anchors are dealt into groups of about ``GROUP``, rows into shards of about ``SHARD``; task (group, shard) holds its group and
streams its shard past it in blocks.  What moves is anchors times shards plus rows times groups, never a pair.  Labels don't
decide where a row goes, so a label that holds most rows is no hot group.

Results: components x become floor(256 x).  Rows with a null id, label or vector, or with a null or non-finite component, take no part;
vectors of different lengths are not compared.  Higher scores come first, ties by the smaller id.  Each row counts by itself, also
repeated ones (a repeated positive is mined once for each of its rows); a row with the anchor's own id never does.  If an anchor's
id is on several rows, the smallest (label, vector) is the anchor.  An empty table gives no rows.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordforge.llm.common import table
from recordforge.llm.registry import query
from recordforge.llm.topk import EXACT

GROUP = 8_192
SHARD = 16_384
#: Anchors and candidates compared at a time.
SIDE = 1_024
#: Segments stored, and how many of them are pooled at each level.
SEGMENTS = 16
LEVELS = (16, 4, 1)
#: Pairs are gathered one by one below this share of their rectangle; above it the whole rectangle is multiplied.
DENSE = 0.1
LOWEST = np.iinfo(np.int64).min // 4
HIGHEST = np.iinfo(np.int64).max // 4


def segment_lengths(width: int) -> np.ndarray:
    return np.diff(np.linspace(0, width, SEGMENTS + 1).astype(np.int64))


def summaries(vectors: np.ndarray) -> np.ndarray:
    """(mean, deviation) of the segments of each vector, segment after segment; zeros for segments without a component."""
    n, width = vectors.shape
    ends = np.cumsum(segment_lengths(width))
    out = np.zeros((n, SEGMENTS, 2))
    for k, (i, j) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        if j > i:
            part = vectors[:, i:j].astype(np.float64)
            out[:, k, 0], out[:, k, 1] = part.mean(axis=1), part.std(axis=1)
    return out.reshape(n, 2 * SEGMENTS)


def pooled(stored: np.ndarray, width: int, together: int) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(l) * mean and sqrt(l) * deviation of segments of ``together`` stored ones each."""
    lengths = segment_lengths(width).astype(np.float64).reshape(-1, together)
    mean, deviation = (stored.reshape(len(stored), SEGMENTS // together, together, 2)[..., k] for k in range(2))
    total = lengths.sum(axis=1)
    if together == 1:
        root = np.sqrt(total)
        return mean[..., 0] * root, deviation[..., 0] * root
    some = np.maximum(total, 1.0)
    m = (mean * lengths).sum(axis=-1) / some
    square = ((mean**2 + deviation**2) * lengths).sum(axis=-1)
    return m * np.sqrt(total), np.sqrt(np.maximum(square - total * m**2, 0.0))


class Side:
    """Ids, labels, vectors and segment summaries of some rows of one vector length."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, stored: np.ndarray):
        self.ids, self.labels, self.vectors, self.width = ids, labels, vectors.astype(np.float64), vectors.shape[1]
        self.whole = vectors
        self.levels = [pooled(stored, self.width, t) for t in LEVELS]
        self.norm = float(np.sqrt((self.vectors**2).sum(axis=1).max(initial=0.0)))
        self.most = float(np.abs(self.vectors).max(initial=0.0))

    def __len__(self) -> int:
        return len(self.ids)


def _products(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (rows, cols)."""
    if not len(rows):
        return np.zeros(0, dtype=a.dtype)
    some_rows, at = np.unique(rows, return_inverse=True)
    some_cols, to = np.unique(cols, return_inverse=True)
    if len(rows) > DENSE * len(some_rows) * len(some_cols):
        return (a[some_rows] @ b[some_cols].T)[at, to]
    out = np.empty(len(rows), dtype=a.dtype)
    for i in range(0, len(rows), 65_536):
        out[i : i + 65_536] = np.einsum("ij,ij->i", a[rows[i : i + 65_536]], b[cols[i : i + 65_536]])
    return out


def exact_scores(a: Side, b: Side, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs; in doubles while they are exact there."""
    if a.most * b.most * max(a.width, 1) < EXACT:
        return _products(a.vectors, b.vectors, rows, cols).astype(np.int64)
    return _products(a.whole, b.whole, rows, cols)


class Wanted:
    """Up to ``k`` best rows of each range (low, high) of scores of each anchor."""

    def __init__(self, anchors: Side, low: np.ndarray, high: np.ndarray, same: bool, k: int):
        self.anchors, self.low, self.high, self.same, self.k = anchors, low, high, same, k
        self.score = np.full((*low.shape, k), LOWEST)
        self.found = np.full((*low.shape, k), np.iinfo(np.int64).max)
        self.computed = 0

    def offer(self, rows: Side) -> None:
        for i in range(0, len(self.anchors), SIDE):
            for j in range(0, len(rows), SIDE):
                self._block(rows, np.arange(i, min(i + SIDE, len(self.anchors))), np.arange(j, min(j + SIDE, len(rows))))

    def _floor(self) -> np.ndarray:
        """The least score that a row needs for each range."""
        return np.maximum(self.low, self.score[..., -1])

    def _block(self, rows: Side, a: np.ndarray, c: np.ndarray) -> None:
        anchors = self.anchors
        slack = 1e-6 + 1e-7 * anchors.norm * rows.norm
        floor = self._floor()
        open_ = self.low <= self.high
        least = np.where(open_, floor, HIGHEST).min(axis=1)[a].astype(np.float64)
        most = np.where(open_, self.high, LOWEST).max(axis=1)[a].astype(np.float64)
        same = anchors.labels[a][:, None] == rows.labels[c][None, :]
        alive = (same if self.same else ~same) & (anchors.ids[a][:, None] != rows.ids[c][None, :])
        mean, spread = (x[a] @ y[c].T for x, y in zip(anchors.levels[0], rows.levels[0], strict=True))
        alive &= (mean + spread + slack >= least[:, None]) & (mean - spread - slack <= most[:, None])
        at, to = np.nonzero(alive)
        at, to = a[at], c[to]
        upper = np.zeros(0)
        for level in range(1, len(LEVELS)):
            mean, spread = (_products(x, y, at, to) for x, y in zip(anchors.levels[level], rows.levels[level], strict=True))
            upper = mean + spread + slack
            alive = self._asked(floor, at, upper, mean - spread - slack)
            at, to, upper = at[alive], to[alive], upper[alive]
        # The pairs of highest bounds first: what they reach drops others.
        order = np.lexsort((-upper, at))
        at, to, upper = at[order], to[order], upper[order]
        first = np.arange(len(at)) - np.searchsorted(at, at) < self.k
        self._take(rows, at[first], to[first])
        at, to, upper = at[~first], to[~first], upper[~first]
        alive = self._asked(self._floor(), at, upper, None)
        self._take(rows, at[alive], to[alive])

    def _asked(self, floor: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray | None) -> np.ndarray:
        """Which pairs may still lie in a range of their anchor."""
        out = np.zeros(len(at), dtype=bool)
        for w in range(floor.shape[1]):
            some = (self.low[at, w] <= self.high[at, w]) & (upper >= floor[at, w])
            out |= some if lower is None else some & (lower <= self.high[at, w])
        return out

    def _take(self, rows: Side, at: np.ndarray, to: np.ndarray) -> None:
        self.computed += len(at)
        exact = exact_scores(self.anchors, rows, at, to)
        floor, ranges = self._floor(), self.low.shape[1]
        for w in range(ranges):
            fits = (exact >= floor[at, w]) & (exact <= self.high[at, w])
            if not fits.any():
                continue
            touched, place = np.unique(at[fits], return_inverse=True)
            anchor = np.concatenate((place, np.repeat(np.arange(len(touched)), self.k)))
            score = np.concatenate((exact[fits], self.score[touched, w].ravel()))
            found = np.concatenate((rows.ids[to[fits]], self.found[touched, w].ravel()))
            order = np.lexsort((found, -score, anchor))
            anchor, score, found = anchor[order], score[order], found[order]
            rank = np.arange(len(anchor)) - np.searchsorted(anchor, anchor)
            keep = rank < self.k
            self.score[touched[anchor[keep]], w, rank[keep]] = score[keep]
            self.found[touched[anchor[keep]], w, rank[keep]] = found[keep]

    def rows(self) -> pa.RecordBatch:
        at, w, rank = np.nonzero(self.score > LOWEST)
        names = ["anchor_id", "place", "row_id", "score"]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.anchors.ids[at], w, self.found[at, w, rank], self.score[at, w, rank])], names=names)


def _flat(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _store(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, dim, vector) with the summaries of their segments."""
    for batch in batches:
        stored = np.zeros((batch.num_rows, 2 * SEGMENTS))
        widths = batch.column(2).to_numpy()
        for width in np.unique(widths).tolist():
            at = np.flatnonzero(widths == width)
            stored[at] = summaries(_flat(batch.column(3).take(pa.array(at)), width))
        offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * 2 * SEGMENTS)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(stored.ravel()))], names=[*batch.schema.names, "segments"])


def _mine(batches: Iterable[pa.RecordBatch], same: bool, ranges: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows (group, shard, dim, candidate, id, label, vector, segments, low, high), sorted by the first four."""
    task, wanted = None, None
    held: list[tuple] = []
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
        cuts = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()
        for i, j in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            group, shard, dim, candidate = keys[:, i].tolist()
            if (group, shard, dim) != task:
                if wanted is not None:
                    yield wanted.rows()
                task, wanted, held = (group, shard, dim), None, []
            part = batch.slice(i, j - i)
            side = (part.column(4).to_numpy(), part.column(5).to_numpy(), _flat(part.column(6), dim), _flat(part.column(7), 2 * SEGMENTS))
            if not candidate:
                held.append((*side, _flat(part.column(8), ranges), _flat(part.column(9), ranges)))
                continue
            if wanted is None:
                if not held:
                    continue
                whole = [np.concatenate(x) for x in zip(*held, strict=True)]
                wanted, held = Wanted(Side(*whole[:4]), whole[4], whole[5], same, k), []
            wanted.offer(Side(*side))
    if wanted is not None:
        yield wanted.rows()


def stored_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, dim, vector array<bigint>, segments array<double>) of the usable rows."""
    x = F.col(embedding).cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    rows = df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & finite).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.size(x).alias("dim"), F.transform(x, lambda v: F.floor(v * 256).cast("long")).alias("vector")
    )
    return rows.mapInArrow(_store, "id long, label long, dim int, vector array<long>, segments array<double>")


def _best(anchors: DataFrame, rows: DataFrame, groups: int, shards: int, same: bool, ranges: int, k: int) -> DataFrame:
    """(anchor_id, place, row_id, score, rank): the ``k`` best rows of each range of each anchor."""
    deal = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    side = ("dim", "candidate", "id", "label", "vector", "segments", "low", "high")
    empty = F.array().cast("array<long>")
    left = anchors.withColumn("candidate", F.lit(0)).select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"), deal(shards).alias("shard"), *side)
    right = rows.withColumns({"candidate": F.lit(1), "low": empty, "high": empty}).select(deal(groups).alias("group"), F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), *side)
    tasks = left.unionByName(right).repartition(groups * shards, "group", "shard").sortWithinPartitions("group", "shard", "dim", "candidate")
    found = tasks.mapInArrow(partial(_mine, same=same, ranges=ranges, k=k), "anchor_id long, place long, row_id long, score long")
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame, is_anchor: F.Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Of each positive the ``negatives`` best rows of another label than the anchor's whose score is at least ``least`` and at most
    ``most`` hundredths of the positive's.
    """
    rows = stored_vectors(df, vec_id, embedding, label)
    usable = stored_vectors(df.where(is_anchor), vec_id, embedding, label)
    anchors = usable.groupBy("id").agg(F.min(F.struct("label", "vector", "dim", "segments")).alias("a")).select("id", "a.*")
    counts = df.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("q")).first()
    groups, shards = max(1, -(-counts["q"] // GROUP)), max(1, -(-counts["n"] // SHARD))

    anything = anchors.withColumns({"low": F.array(F.lit(LOWEST + 1)), "high": F.array(F.lit(HIGHEST))})
    found = _best(anything, rows, groups, shards, True, 1, positives)
    # At most ``positives`` rows of an anchor meet here.
    asked = found.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score")))).alias("p"))
    # Hundredths in whole numbers, rounded into the range; places without a positive are closed.
    down = lambda x: F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))
    each_place = lambda bound, closed: F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(bound(F.get("p", i)["positive_score"]), F.lit(closed)))
    low, high = each_place(lambda s: -down(-s * least), HIGHEST), each_place(lambda s: down(s * most), LOWEST)
    ranges = anchors.join(asked.select(F.col("anchor_id").alias("id"), low.alias("low"), high.alias("high")), "id")
    mined = _best(ranges, rows, groups, shards, False, positives, negatives)
    each = asked.select("anchor_id", F.posexplode("p").alias("place", "p")).select("anchor_id", "place", "p.positive_id", "p.positive_score")
    return mined.join(each, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


@query(
    "op12_hard_negatives",
    """with v as (select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
   list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, v.vec_id, a.label = v.label as same, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * v.v[i]))::bigint as score
  from v a join v on a.vec_id <> v.vec_id and len(a.v) = len(v.v) where a.vec_id % 100 = 0),
p as (select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from s where same) where place <= 5),
n as (select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
   row_number() over (partition by p.anchor_id, p.place order by s.score desc, s.vec_id)::int as rank
  from p join s on s.anchor_id = p.anchor_id and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5""",
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by 100; the label of rows divisible by 7 is moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
