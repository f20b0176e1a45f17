"""All pairs of texts whose sets of five-word shingles have a similarity (Jaccard) of 0.8 or more, as a graph of links.

Every bound is exact, so no pair is lost and none is added; only classes of equal sets are told apart by a 64-bit hash.

* Two sets of similarity 0.8 share a shingle among the first n - ceil(0.8 n) + 1 of each, whatever the order of all shingles is.
  Shingles that a sample of the texts shows often come last, so that a passage on many pages is hardly ever looked up.
* Texts that share such a shingle are compared by size, by the place of the shingle and by a sketch: 512 parities of the
  shingle hashes, whose exclusive-or has at most as many ones as the sets differ in.
* What is left is compared by the sets themselves.

Skew: equal sets collapse to one class first.  Rows are sorted by (shingle, class) and dealt by range, so that a hot
shingle is many tasks.  First each shingle links its texts to one of them, another for each shingle; only texts that those links have not
joined are compared with one another, in tiles of at most ``TILE`` rows where a shingle has more.  So a group of near copies
is as many rows as it has shingles, not all of its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest, xxh64_intdigest

from recordforge.llm.common import partitions, saved
from recordforge.llm.components import components

SEED = 42
SHINGLE = 5
TILE = 512
#: Pairs of two tiles compared by their sketches, and links given out, at a time.
PAIRS = 65_536
#: One text in ``SAMPLE`` is sampled for frequent shingles, those seen ``OFTEN`` times count, ``HOT`` of them at most. They only order the shingles.
SAMPLE, OFTEN, HOT = 8, 4, 200_000
BROADCAST_ROWS = 300_000
SKETCH = 512
ROW = np.dtype([("fp", "<i8"), ("root", "<i8"), ("pos", "<i4"), ("n", "<i4"), ("sketch", "<u8", (SKETCH // 64,))])


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each run of ``shingle`` words joined by one space, of all words where there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    digests = b"".join([xxh64_digest(joined[i:j], SEED) for i, j in zip(starts, ends[k - 1 :].tolist(), strict=True)])
    return np.frombuffer(digests, dtype=">u8").astype(np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingle_hashes(text, SHINGLE))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the hashes in each of ``SKETCH`` classes, as 64-bit words."""
    return np.packbits((np.bincount((shingles % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1).astype(np.uint8)).view(np.uint64)


def prefix(shingles: np.ndarray, hot: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The first shingles in the order of (level, hash), as many as a set of similarity 0.8 can't miss altogether."""
    n = len(shingles)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)
        shingles = shingles[np.lexsort((shingles, np.where(hot[at] == shingles, level[at], 0)))]
    return shingles[: n - (4 * n + 4) // 5 + 1 if n else 0]


def frequent(df: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a sample of the texts, sorted, and the levels (binary logarithms) of their counts."""

    @F.pandas_udf("array<long>")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingle_set(t).view(np.int64) for t in batch], dtype=object)

    some = df.where(F.pmod(F.xxhash64(F.col(text)), F.lit(SAMPLE)) == 0)
    counts = some.select(F.explode(sets(F.col(text))).alias("h")).groupBy("h").count().where(F.col("count") >= OFTEN)
    counts = saved(counts.select("h", F.floor(F.log2("count")).cast("int").alias("level")))
    least, total = None, 0
    for r in sorted(counts.groupBy("level").count().collect(), key=lambda r: -r["level"]):
        total += r["count"]
        if total > HOT:
            break
        least = r["level"]
    rows = [] if least is None else counts.where(F.col("level") >= least).collect()
    hot, level = np.array([r["h"] for r in rows], dtype=np.int64).view(np.uint64), np.array([r["level"] for r in rows], dtype=np.int64)
    order = np.argsort(hot)
    return hot[order], level[order]


def marked(df: DataFrame, fingerprint: Callable[[str | None], bytes], text: str = "text") -> DataFrame:
    """``df`` with fp (hash of the shingle set, zero if it is empty), n (its size), sketch, prefix and print (its ``fingerprint``) instead of ``text``."""
    shared = df.sparkSession.sparkContext.broadcast(frequent(df, text))

    @F.pandas_udf("fp long, n int, sketch array<long>, prefix array<long>, print binary")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch]
            yield pd.DataFrame({
                "fp": np.array([xxh64_intdigest(s.tobytes(), SEED) if len(s) else 0 for s in sets], dtype=np.uint64).view(np.int64),
                "n": np.array([len(s) for s in sets], dtype=np.int32),
                "sketch": pd.Series([sketch(s).view(np.int64) for s in sets], dtype=object),
                "prefix": pd.Series([prefix(s, *shared.value).view(np.int64) for s in sets], dtype=object),
                "print": pd.Series([fingerprint(t) for t in batch], dtype=object),
            })

    return df.withColumn("of_text", of_texts(F.col(text))).select(*[c for c in df.columns if c != text], "of_text.*")


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) if pa.types.is_list(c.type) else c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _by_token(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], bool]]:
    """Columns of whole tokens without repeated (token, fp), and whether these are the first or last token of the partition.

    Rows are sorted by token and fp, the first two columns.
    """
    parts: list[list[np.ndarray]] = []
    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = _columns(batch)
        end = np.searchsorted(columns[0], columns[0][-1])
        if parts and columns[0][-1] == parts[0][0][0]:
            parts.append(columns)
            continue
        parts.append([c[:end] for c in columns])
        done = _distinct(parts)
        parts = [[c[end:] for c in columns]]
        if not len(done[0]):
            # The partition starts with a batch of one token.
            continue
        if first:
            cut = np.searchsorted(done[0], done[0][0], side="right")
            yield [c[:cut] for c in done], True
            done, first = [c[cut:] for c in done], False
        yield done, False
    if parts:
        yield _distinct(parts), True


def _distinct(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    return [c[new] for c in columns]


def _batch(names: str, columns: Iterable[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (token, fp, pos, n) without the tokens of one class; those that may go on in another partition stay."""
    for columns, edge in _by_token(batches):
        token = columns[0]
        again = token[1:] == token[:-1]
        keep = np.full(len(token), edge)
        keep[1:] |= again
        keep[:-1] |= again
        yield _batch("token fp pos n", [c[keep] for c in columns])


def _possible(n, i, m, j) -> np.ndarray:
    """Whether sets of n and m shingles that have none in common before places i and j can reach the similarity."""
    n, m = n.astype(np.int64), m.astype(np.int64)
    return 9 * np.minimum(n - i, m - j) >= 4 * (n + m)


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, fp, pos, n) -> (a, b): of each token one class, picked by hash, with the others."""
    for batch in batches:
        token, fp, pos, n = _columns(batch)
        mixed = (fp ^ token).view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.lexsort((mixed ^ (mixed >> np.uint64(29)), token))
        token, fp, pos, n = token[order], fp[order], pos[order], n[order]
        new = np.ones(len(token), dtype=bool)
        new[1:] = token[1:] != token[:-1]
        hub = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.empty(0, dtype=np.int64)
        near = ~new & (fp != fp[hub]) & _possible(n, pos, n[hub], pos[hub])
        a, b = fp[near], fp[hub][near]
        yield _batch("a b", [np.minimum(a, b), np.maximum(a, b)])


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least number of shingles that two sets differ in, by their sketches."""
    return sum(np.bitwise_count(x[..., w] ^ y[..., w]).astype(np.int64) for w in range(x.shape[-1]))


def _within(batches: Iterable[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    """Sorted (token, fp, pos, n, sketch, root) -> (a, b) of tokens with ``tile`` rows or fewer, (token, tile, data) of the others."""
    for (token, fp, pos, n, sketches, root), edge in _by_token(batches):
        if not len(token):
            continue
        starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        sizes = np.diff(np.append(starts, len(token)))
        large = np.repeat((sizes > tile) | edge, sizes)
        left, right = [], []
        small = np.flatnonzero(~large)
        t, r = token[small], root[small]
        for step in range(1, int(sizes.max(initial=0, where=sizes <= tile)) if len(small) else 1):
            k = np.flatnonzero((t[step:] == t[:-step]) & (r[step:] != r[:-step]))
            i, j = small[k], small[k + step]
            k = _possible(n[i], pos[i], n[j], pos[j])
            i, j = i[k], j[k]
            k = 9 * _apart(sketches[i].view(np.uint64), sketches[j].view(np.uint64)) <= n[i].astype(np.int64) + n[j]
            left.append(np.minimum(fp[i], fp[j])[k])
            right.append(np.maximum(fp[i], fp[j])[k])
        a, b = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (left, right))
        nothing = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), nothing, nothing, pa.nulls(len(a), pa.binary())], names=["a", "b", "token", "tile", "data"])
        for s, size in zip(starts[large[starts]].tolist(), sizes[large[starts]].tolist(), strict=True):
            for k in range(s, s + size, tile):
                end = min(k + tile, s + size)
                rows = np.empty(end - k, dtype=ROW)
                for name, c in (("fp", fp), ("root", root), ("pos", pos), ("n", n), ("sketch", sketches.view(np.uint64))):
                    rows[name] = c[k:end]
                nothing = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([nothing, nothing, pa.array([int(token[k])]), pa.array([int(fp[k])]), pa.array([rows.tobytes()], pa.binary())], names=["a", "b", "token", "tile", "data"])


def _tile_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of tiles (x, y) of one token -> (a, b), ``PAIRS`` at a time."""
    for batch in batches:
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []
        held = 0
        for k in range(batch.num_rows):
            x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), dtype=ROW) for c in range(2))
            near = (x["fp"][:, None] != y["fp"]) & (x["root"][:, None] != y["root"]) & _possible(x["n"][:, None], x["pos"][:, None], y["n"], y["pos"])
            rows, cols = np.nonzero(near)
            for first in range(0, len(rows), PAIRS):
                i, j = rows[first : first + PAIRS], cols[first : first + PAIRS]
                alike = 9 * _apart(x["sketch"][i], y["sketch"][j]) <= x["n"][i].astype(np.int64) + y["n"][j]
                a, b = x["fp"][i[alike]], y["fp"][j[alike]]
                left.append(np.minimum(a, b))
                right.append(np.maximum(a, b))
                held += len(a)
                if held >= PAIRS:
                    yield _batch("a b", [np.concatenate(left), np.concatenate(right)])
                    left, right, held = [], [], 0
        if held:
            yield _batch("a b", [np.concatenate(left), np.concatenate(right)])


def _sorted(df: DataFrame) -> DataFrame:
    return df.repartitionByRange(partitions(df), "token", "fp").sortWithinPartitions("token", "fp")


def exact(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of classes whose sets have the similarity."""
    one, two = (classes.select(F.col("fp").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}")) for k in "ab")
    apart = sum((F.bit_count(F.col("s_a")[w].bitwiseXOR(F.col("s_b")[w])) for w in range(SKETCH // 64)), F.lit(0))
    near = saved(pairs.distinct().join(one, "a").join(two, "b").where(9 * apart <= F.col("n_a") + F.col("n_b")).select("a", "b"))
    wanted = near.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    wanted = saved(classes.join(wanted, "fp", "left_semi").select("fp", "first.tag", "first.tag2"))

    @F.pandas_udf("boolean")
    def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for xs, ys in batches:
            yield pd.Series([_alike(shingle_set(x), shingle_set(y)) for x, y in zip(xs, ys, strict=True)], dtype=bool)

    # Texts move, not sets: they are smaller and can be compressed.
    found = texts.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, ["tag", "tag2"])
    found = found.groupBy("fp").agg(F.first("text").alias("text"))
    both = near.join(found.select(F.col("fp").alias("a"), F.col("text").alias("x")), "a").join(found.select(F.col("fp").alias("b"), F.col("text").alias("y")), "b")
    return saved(both.where(alike("x", "y")).select("a", "b"))


def _alike(x: np.ndarray, y: np.ndarray) -> bool:
    return 9 * len(np.intersect1d(x, y, assume_unique=True)) >= 4 * (len(x) + len(y))


def class_roots(light: DataFrame, classes: DataFrame, texts: DataFrame, found_by: DataFrame) -> DataFrame:
    """(node, root) of the classes with a link: the smallest class that links lead to.

    ``light`` has fp, n and prefix of every row, ``classes`` fp, n, sketch and first (tag, tag2), ``texts`` tag, tag2 and text.
    ``found_by`` has pairs (a, b) that another method found; they are checked by their sets like all others.
    """
    rows = light.select("fp", "n", F.posexplode("prefix").alias("pos", "token")).select("token", "fp", "pos", "n")
    shared = saved(_sorted(rows).mapInArrow(_shared, "token long, fp long, pos int, n int"))
    links = exact(found_by.unionByName(shared.mapInArrow(_stars, "a long, b long")), classes, texts)
    roots = saved(components(links))
    rest = shared.join(classes.select("fp", "sketch"), "fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rest = saved(rest.select("token", "fp", "pos", "n", "sketch", F.coalesce("root", "fp").alias("root")))
    tile = TILE
    found = saved(_sorted(rest).mapInArrow(lambda batches: _within(batches, tile), "a long, b long, token long, tile long, data binary"))
    tiles = found.where("data is not null")
    a, b = tiles.alias("a"), tiles.alias("b")
    crossed = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.tile") <= F.col("b.tile"))).select(F.col("a.data").alias("x"), F.col("b.data").alias("y"))
    more = exact(found.where("data is null").select("a", "b").unionByName(crossed.mapInArrow(_tile_pairs, "a long, b long")), classes, texts)
    return roots if more.isEmpty() else components(links.unionByName(more))
