"""SimHash near-duplicates by tiled exact comparison.

``fingerprints`` gives every document the SimHash of its word shingles: ``words`` times 64 bits.  ``linked`` compares the
distinct fingerprints only.  They are dealt by bit blocks, sorted by block value and population count and cut into tiles; a
numpy kernel takes the exclusive-or of two tiles of one block value and counts bits, and tile pairs whose population counts
differ by more than the radius are never joined.  With ``radius`` < ``bands`` disjoint blocks every pair within the radius
agrees on some block (pigeonhole), so the comparison is exact; wider fingerprints with more, partly overlapping blocks lose pairs
near the radius.  ``one_of_each`` checks the links of fingerprints by the shingle sets themselves.

Skew: copies collapse to one fingerprint by partial aggregation before anything is compared; sorting by block, count and
fingerprint deals a hot block over many tasks; and a tile pair emits a spanning forest of its links, at most as many edges
as it has fingerprints, never all pairs of a group.  No tile is larger than ``TILE`` fingerprints.

Nulls: a null text has no words.  Texts without words share fingerprint zero.  Rows with a null doc_id are fingerprinted and
link like others; they cannot be the smallest id.  Repeated rows stay, with equal results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.llm import similar
from recordforge.llm.common import free_name, partitions, saved, small_batches, table
from recordforge.llm.components import components
from recordforge.llm.registry import query
from recordforge.llm.similar import shingle_hashes

TILE = 512
#: Of fingerprints of 256 bits: bits that most pairs of similarity 0.8 differ in at most, and blocks to deal them by. No removal rests on them.
RADIUS, BANDS = 54, 32
#: Bits set in each byte value, most significant bit first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1).astype(np.int64)


def _remix(h: np.ndarray, n: int) -> np.ndarray:
    """The n-th further hash of each hash (a multiply-and-shift finaliser)."""
    x = h + np.uint64((n * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str | None, shingle: int, words: int) -> bytes:
    h = shingle_hashes(text, shingle)
    if not len(h):
        return bytes(8 * words)
    out = []
    for n in range(words):
        octets = (h if n == 0 else _remix(h, n)).astype(">u8").view(np.uint8).reshape(-1, 8)
        if len(h) < 256:
            ones = np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
        else:
            ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ BITS for k in range(8)])
        out.append(np.packbits(2 * ones > len(h)).tobytes())
    return b"".join(out)


def fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, words: int = 1, out: str = "fp") -> DataFrame:
    """``df`` with the binary column ``out``: the SimHash of the whole text, ``words`` times 64 bits.

    A to Z count as lower case, words are what ASCII white space parts, shingles count as often as they occur, and a bit is
    one if more than half of the shingles have it.  No words: zero.
    """

    @F.pandas_udf("binary")
    def of_texts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle, words) for t in batch], dtype=object)

    return df.withColumn(out, of_texts(F.col(text)))


def _band_nibbles(nibbles: int, bands: int) -> list[list[int]]:
    """Of each band the hex digits it takes: disjoint runs; if more bands are wanted, runs of digits with a wider step."""
    if bands * (nibbles // bands) <= nibbles and nibbles // bands >= 3:
        width = nibbles // bands
        return [list(range(i * width, (i + 1) * width)) for i in range(bands)]
    out: list[list[int]] = []
    step = 1
    while len(out) < bands:
        out += [[(i + step * d) % nibbles for d in range(3)] for i in range(0, nibbles, 3 if step == 1 else 5)]
        step = step * 5 + 2
    return out[:bands]


def _tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, pop, fp) -> tiles of at most TILE fingerprints of one block value."""
    block, held = None, []
    done: list[tuple] = []

    def close() -> None:
        if held:
            done.append((block, held[0][0].to_bytes(2, "big") + held[0][1], held[0][0], held[-1][0], len(held), b"".join(x[1] for x in held)))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), *(pa.array(c, pa.int32()) for c in columns[2:5]), pa.array(columns[5], pa.binary())],
            names=["block", "tile", "lo", "hi", "n", "fps"],
        )

    for batch in batches:
        for key, pop, fp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != block or len(held) >= TILE:
                close()
                block, held = key, []
                if len(done) >= 2000:
                    yield flush()
            held.append((pop, fp))
    close()
    if done:
        yield flush()


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between rows and columns of a boolean matrix."""
    rows, cols = near.any(axis=1), near.any(axis=0)
    edges: list[tuple[int, int]] = []
    for first in np.flatnonzero(rows):
        if not rows[first]:
            continue
        rows[first] = False
        stack = [(True, first)]
        while stack:
            is_row, k = stack.pop()
            new = np.flatnonzero(near[k] & cols if is_row else near[:, k] & rows)
            (cols if is_row else rows)[new] = False
            edges += [(k, j) if is_row else (j, k) for j in new]
            stack += [(not is_row, j) for j in new]
    return edges


def _compare(batches: Iterable[pa.RecordBatch], words: int, radius: int) -> Iterator[pa.RecordBatch]:
    """Tile pairs -> links as (a, b): exclusive-or, bit counts, and of the pairs within the radius a spanning forest."""
    size = 8 * words
    for batch in batches:
        left, right = [], []
        for x, y, same in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a = np.frombuffer(x, dtype=np.uint64).reshape(-1, words)
            b = np.frombuffer(y, dtype=np.uint64).reshape(-1, words)
            apart = np.zeros((len(a), len(b)), dtype=np.uint16)
            for w in range(words):
                apart += np.bitwise_count(a[:, w][:, None] ^ b[:, w][None, :])
            near = apart <= radius
            if same:
                np.fill_diagonal(near, False)
            if near.any():
                for i, j in forest(near):
                    left.append(x[i * size : (i + 1) * size])
                    right.append(y[j * size : (j + 1) * size])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])


def linked(fps: DataFrame, words: int = 1, radius: int = 3, bands: int = 4) -> DataFrame:
    """Distinct fingerprints (column fp) -> links (a, b) whose components are those of all pairs within ``radius`` bits."""
    digits = F.hex("fp")
    keys = [
        F.concat(F.lit(f"{i:02d}:"), *(F.substring(digits, d + 1, 1) for d in band) if not _run(band) else (F.substring(digits, band[0] + 1, len(band)),))
        for i, band in enumerate(_band_nibbles(16 * words, bands))
    ]
    ones = sum((F.bit_count(F.conv(F.substring(digits, 1 + 8 * k, 8), 16, 10).cast("long")) for k in range(2 * words)), F.lit(0))
    dealt = fps.select("fp", ones.cast("int").alias("pop")).select(F.explode(F.array(*keys)).alias("block"), "pop", "fp")
    dealt = dealt.repartitionByRange(partitions(fps), "block", "pop", "fp").sortWithinPartitions("block", "pop", "fp")
    tiles = saved(dealt.mapInArrow(_tiles, "block string, tile binary, lo int, hi int, n int, fps binary"))
    a, b = tiles.alias("a"), tiles.alias("b")
    same = F.col("a.tile") == F.col("b.tile")
    pairs = a.join(b, (F.col("a.block") == F.col("b.block")) & (F.col("a.tile") <= F.col("b.tile")) & (F.col("b.lo") - F.col("a.hi") <= radius))
    pairs = pairs.where(~same | (F.col("a.n") > 1)).select(F.col("a.fps").alias("x"), F.col("b.fps").alias("y"), same.alias("same"))
    return pairs.mapInArrow(partial(_compare, words=words, radius=radius), "a binary, b binary").distinct()


def _run(band: list[int]) -> bool:
    return band == list(range(band[0], band[0] + len(band)))


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1, radius: int = 3, bands: int = 4
) -> DataFrame:
    """(doc_id, fingerprint binary, component_id) of every row: the smallest doc_id reachable over links, its own included."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    light = saved(fingerprints(rows, "text", shingle, words).select("doc_id", "fp"))
    roots = roots_of(light.select(F.col("doc_id").alias("id"), "fp"), words, radius, bands)
    return light.join(roots, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each group of near-duplicates: that with the smallest id, a null id last.

    Near-duplicates are texts whose sets of five-word shingles have a similarity of 0.8 or more, and texts that such pairs
    connect; texts without words are one group.  All pairs are found and each is compared by its sets (module ``similar``), so every row
    that goes has a partner of that similarity and no two that stay have it.
    SimHash links come first (``print_pairs``); no radius tells 0.8 from 0.7, so their sets are checked, and what the radius leaves out is
    found by shared shingles.
    Texts are hashed where they lie; they move once, to meet the ids that stay, and those of candidate pairs to be compared.
    """
    names = {n: free_name(df, n) for n in ("tag", "tag2")}
    tags = {names["tag"]: F.xxhash64(F.col(doc_id), F.col(text)), names["tag2"]: F.xxhash64(F.lit(1), F.col(text))}
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *(c.alias(n) for n, c in zip(("tag", "tag2"), tags.values(), strict=True)))
    with small_batches(df.sparkSession):
        light = saved(similar.marked(rows, partial(fingerprint, shingle=3, words=1)))
    # Copies collapse to their first row before they are dealt by class.
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "tag", "tag2")).alias("first")
    classes = saved(light.groupBy("fp").agg(first, F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("print").alias("print")))
    with small_batches(df.sparkSession):
        roots = similar.class_roots(light, classes, rows.drop("id"), print_pairs(classes)).withColumnRenamed("node", "fp")
    kept = classes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    stay = kept.select("first.tag", "first.tag2")
    stay = saved(light.join(stay, ["tag", "tag2"], "left_semi").groupBy("tag", "tag2").agg(F.count("*").alias("copies")))
    keys = stay.select(F.col("tag").alias(names["tag"]), F.col("tag2").alias(names["tag2"]), "copies")
    on = list(names.values())
    tagged = df.withColumns(tags)
    kept = tagged.join(keys.where("copies = 1").drop("copies"), on, "left_semi")
    if not stay.where("copies > 1").isEmpty():
        # Rows repeated with id and text: one of them.
        again = tagged.join(keys.where("copies > 1").drop("copies"), on, "left_semi").dropDuplicates(on)
        kept = kept.unionByName(again)
    return kept.select(*df.columns)


def print_pairs(classes: DataFrame) -> DataFrame:
    """(a, b) of classes (fp, print) by their SimHash: those of one fingerprint with the first of them, and firsts whose fingerprints link."""
    firsts = saved(classes.groupBy(F.col("print").alias("fp")).agg(F.min("fp").alias("node")))
    same = classes.select("print", F.col("fp").alias("b")).join(firsts.select(F.col("fp").alias("print"), F.col("node").alias("a")), "print")
    links = linked(firsts.select("fp"))
    left, right = (firsts.select(F.col("fp").alias(k), F.col("node").alias(f"n_{k}")) for k in "ab")
    near = links.join(left, "a").join(right, "b").select(F.least("n_a", "n_b").alias("a"), F.greatest("n_a", "n_b").alias("b"))
    return same.where("a <> b").select("a", "b").unionByName(near)


def group_roots(light: DataFrame, words: int, radius: int, bands: int) -> DataFrame:
    """(fp, root) of the distinct fingerprints of ``light``: the smallest fingerprint of each component."""
    distinct = saved(light.select("fp").distinct())
    found = components(linked(distinct, words, radius, bands)).withColumnRenamed("node", "fp")
    return distinct.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def roots_of(light: DataFrame, words: int, radius: int, bands: int) -> DataFrame:
    """(id, fp) -> (fp, component_id), one row for each distinct fingerprint."""
    marked = light.groupBy("fp").agg(F.min("id").alias("least")).join(group_roots(light, words, radius, bands), "fp")
    least = marked.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(least, "root").select("fp", "component_id")


@query("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id")
