from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from recordforge.llm import simhash


def _slow(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(rows):
    prints = [_slow(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted((str(d), f"{p:016x}", str(least.get(find(i)))) for i, ((d, _), p) in enumerate(zip(rows, prints)))


def _texts():
    random.seed(8)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        words = [random.choice(vocabulary) for _ in range(random.choice([1, 2, 3, 30, 400]))]
        rows.append((i * 10, " ".join(words)))
        for c in range(random.choice([0, 0, 1, 6])):
            copy = list(words)
            if len(copy) > 100:
                copy[random.randrange(len(copy))] = "changed"
            rows.append((i * 10 + c + 1, " ".join(copy)))
    rows += [(900, None), (901, ""), (902, " \n\t "), (None, "w1 w2 w3"), (903, "W1  w2\nw3"), (5, "repeated row"), (5, "repeated row"), (904, "x " * 20_000)]
    return rows


def test_components_against_brute_force(spark):
    rows = _texts()
    df = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, fingerprint string")
    found = simhash.near_duplicates(df).collect()
    assert sorted((str(r["doc_id"]), bytes(r["fingerprint"]).hex(), str(r["component_id"])) for r in found) == _components(rows)


def test_small_tiles_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 3)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 6, dtype=np.int64)
    values = {int(b) for b in base} | {int(b) ^ (1 << int(k)) ^ (1 << int(m)) for b in base for k, m in rng.integers(0, 60, (15, 2))}
    prints = sorted(values)
    df = spark.createDataFrame([(v, bytearray(v.to_bytes(8, "big"))) for v in prints], "id long, fp binary")
    roots = {bytes(r["fp"]): r["root"] for r in simhash.group_roots(df, words=1, radius=3, bands=4).collect()}
    for a in prints:
        for b in prints:
            if bin(a ^ b).count("1") <= 3:
                assert roots[a.to_bytes(8, "big")] == roots[b.to_bytes(8, "big")]
    assert len(roots) == len(prints) and len(set(map(bytes, roots.values()))) <= 6


def test_forest_keeps_connections():
    rng = np.random.default_rng(6)
    for _ in range(50):
        near = rng.random((7, 9)) < 0.15
        edges = simhash.forest(near.copy())
        assert len(edges) < 16 and all(near[i, j] for i, j in edges)

        def reach(pairs):
            label = list(range(16))
            for _ in range(16):
                for i, j in pairs:
                    label[i] = label[7 + j] = min(label[i], label[7 + j])
            return label

        assert reach(edges) == reach([(int(i), int(j)) for i, j in zip(*np.nonzero(near))])


def test_one_of_each(spark):
    random.seed(9)
    words = [f"v{i}" for i in range(2000)]
    base = [random.choice(words) for _ in range(400)]
    near = list(base)
    near[200] = "other"
    far = [random.choice(words) for _ in range(400)]
    rows = [(7, " ".join(base), "a"), (3, " ".join(base), "b"), (9, " ".join(near), "c"), (4, " ".join(far), "d"), (4, " ".join(far), "d"), (None, " ".join(far), "e"), (20, None, "f"), (21, "", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag string")
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 20]
    assert simhash.one_of_each(df.limit(0)).count() == 0


def test_most_pairs_at_the_similarity_are_found():
    random.seed(10)
    found = 0
    for n in range(60):
        a = [f"u{n}_{random.randrange(5000)}" for _ in range(300)]
        b = list(a)
        for i in range(10, 300, 54):
            b[i] = "new"
        one, two = (simhash.fingerprint(" ".join(x), 5, 4) for x in (a, b))
        apart = bin(int.from_bytes(one, "big") ^ int.from_bytes(two, "big")).count("1")
        x, y = one.hex(), two.hex()
        same = any(all(x[d] == y[d] for d in band) for band in simhash._band_nibbles(64, simhash.BANDS))
        found += apart <= simhash.RADIUS and same
    assert found >= 57
