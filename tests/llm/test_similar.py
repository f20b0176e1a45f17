from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from recordforge.llm import similar, simhash


def _set(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def _alike(x, y):
    return 5 * len(x & y) >= 4 * len(x | y)


def _kept(rows):
    """Smallest id of each component of all pairs of similarity 0.8, by brute force."""
    sets = {d: _set(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for k, d in enumerate(ids):
        for e in ids[k + 1 :]:
            if (sets[d] or sets[e]) and _alike(sets[d], sets[e]) or not sets[d] and not sets[e]:
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return sorted(d for d in ids if find(d) == d)


def _edited(words, positions):
    return [f"x{random.random()}" if i in positions else w for i, w in enumerate(words)]


def _rows():
    random.seed(11)
    rows = []
    passage = [f"p{i}" for i in range(60)]
    for n in range(60):
        base = [f"v{random.randrange(3000)}" for _ in range(random.choice([3, 5, 40, 120, 300]))] + (passage if n % 2 else [])
        rows.append(base)
        for _ in range(3):
            rows.append(_edited(base, set(random.sample(range(len(base)), min(len(base), random.randrange(1, 2 + len(base) // 25))))))
    common = [f"c{i}" for i in range(150)]
    rows += [_edited(common, set(random.sample(range(150), random.randrange(1, 7)))) for _ in range(40)]
    rows += [[], [], common, common]
    random.shuffle(rows)
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def _found(spark, rows):
    return sorted(r["doc_id"] for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_removals_and_kept_pairs_at_the_similarity(spark):
    rows = _rows()
    assert _found(spark, rows) == _kept(rows)


def test_tiles_of_frequent_shingles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(similar, "TILE", 3)
    monkeypatch.setattr(similar, "BROADCAST_ROWS", -1)
    rows = _rows()
    assert _found(spark, rows) == _kept(rows)
    monkeypatch.setattr(similar, "HOT", 0)
    assert _found(spark, rows) == _kept(rows)


def test_batches_of_one_token_and_few_pairs_at_a_time(monkeypatch):
    row = lambda token, fp: (token, fp)
    batches = [[row(1, 1), row(1, 2)], [row(1, 2), row(1, 3)], [row(1, 4), row(2, 1)], [row(3, 1)], [row(3, 2), row(3, 2)], []]
    tables = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(2)], names=["token", "fp"]) for rows in batches]
    for some in (tables, tables[3:], tables[:1], tables[1:3], []):
        found = [(int(t), int(f)) for columns, _ in similar._by_token(some) for t, f in zip(*columns, strict=True)]
        expected = sorted({tuple(r.values()) for table in some for r in table.to_pylist()})
        assert found == expected
    rng = np.random.default_rng(1)
    tiles = []
    for k in range(2):
        rows = np.zeros(40, dtype=similar.ROW)
        rows["fp"] = rows["root"] = np.arange(40) + 100 * k
        rows["n"], rows["sketch"] = 50, rng.integers(0, 1 << 2, (40, 8)).astype(np.uint64)
        tiles.append(rows.tobytes())
    pairs = pa.RecordBatch.from_arrays([pa.array([tiles[0], tiles[0]]), pa.array([tiles[1], tiles[0]])], names=["x", "y"])
    links = lambda: [tuple(r.values()) for b in similar._tile_pairs([pairs]) for r in b.to_pylist()]
    whole = links()
    monkeypatch.setattr(similar, "PAIRS", 7)
    assert sorted(links()) == sorted(whole) and len(whole) > 100


def test_isolated_pairs_just_above_the_similarity_are_found(spark):
    random.seed(12)
    rows = []
    while len(rows) < 3000:
        k = len(rows)
        base = [f"u{k}_{i}" for i in range(200)]
        near = _edited(base, set(random.sample(range(200), random.choice([3, 4, 5, 6]))))
        a, b = _set(" ".join(base)), _set(" ".join(near))
        if 0.80 <= len(a & b) / len(a | b) <= 0.85:
            rows += [(k, " ".join(base)), (k + 1, " ".join(near))]
    assert _found(spark, rows) == list(range(0, 3000, 2))


def test_links_of_fingerprints_are_taken_and_checked(spark, monkeypatch):
    """The pipeline's near-duplicates come through SimHash; a link of fingerprints alone removes nothing."""
    seen = []
    monkeypatch.setattr(simhash, "linked", lambda fps, linked=simhash.linked: seen.append(linked(fps)) or seen[-1])
    words = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:396], "x"])), (3, "a b c d e f"), (4, " ".join(["a b c d e f"] * 3))]
    assert _found(spark, rows) == _kept(rows) == [1, 3, 4]
    assert len(seen) == 1 and seen[0].count() > 0
    # Without the shared shingles the checked links of SimHash are what is left.
    monkeypatch.setattr(similar, "_stars", lambda batches: iter(()))
    monkeypatch.setattr(similar, "_within", lambda batches, tile: iter(()))
    assert _found(spark, rows) == [1, 3, 4]
