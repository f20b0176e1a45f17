from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from recordforge.llm import decontaminate


def _shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words)


def _brute(docs, items):
    distinct = {}
    for i, t in items:
        s = tuple(_shingles(t))
        if s:
            distinct[s] = min(distinct.get(s, i), i) if i is not None else distinct.get(s)
    out = {}
    for d, t in docs:
        s = _shingles(t)
        for item, i in distinct.items():
            n = len(item)
            for start in range(max(1, len(s) - n + 1)):
                a, b = Counter(s[start : start + n]), Counter(item)
                similarity = sum((a & b).values()) / max(sum((a | b).values()), 1)
                if similarity >= 0.8 and (d, i) not in out or similarity > out.get((d, i), (1,))[0]:
                    out[d, i] = (similarity, start)
    return {(str(d), i, round(s, 9)) for (d, i), (s, start) in out.items()}


def _data():
    random.seed(5)
    words = [f"w{i}" for i in range(400)]
    say = lambda n: [random.choice(words) for _ in range(n)]
    items = [(i, " ".join(say(random.choice([30, 31, 45])))) for i in range(12)]
    items += [(20, items[0][1]), (21, None), (22, ""), (23, "too short"), (24, "again and again and again and again and again and again and again")]
    docs = []
    for i in range(60):
        text = say(random.choice([0, 3, 50, 120]))
        if i % 3 == 0:
            leak = items[i % 12][1].split()
            if i % 2:
                leak[-2] = "changed"
            text = text[: len(text) // 2] + leak + text[len(text) // 2 :]
        docs.append((i, " ".join(text)))
    docs += [(100, None), (101, ""), (102, "Too SHORT!"), (103, items[0][1].upper()), (0, docs[0][1]), (104, "x y " * 20_000), (None, items[3][1]), (105, items[16][1])]
    docs.append((106, " ".join(items[1][1].split()[3:])))
    return docs, items


def test_against_brute_force(spark, monkeypatch):
    docs, items = _data()
    df = spark.createDataFrame([(d, t, "z") for d, t in docs], "doc_id long, text string, tag string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = _brute(docs, items)
    for most in (decontaminate.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", most)
        found = decontaminate.leaks(df, bench)
        rows = found.collect()
        assert {(str(r["doc_id"]), r["item_id"], round(r["similarity"], 9)) for r in rows} == expected and len(rows) == len(expected)
        for r in rows:
            # The place given has that similarity.
            own = [_shingles(t) for d, t in docs if d == r["doc_id"]][0]
            item = _shingles(next(t for i, t in items if i == r["item_id"]))
            a, b = Counter(own[r["start"] : r["start"] + len(item)]), Counter(item)
            assert abs(sum((a & b).values()) / sum((a | b).values()) - r["similarity"]) < 1e-9
    kept = decontaminate.without_leaks(df, bench)
    assert kept.columns == df.columns
    bad = {d for d, _, _ in expected}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in docs if str(d) not in bad)


def test_simhash_and_occurrences(spark):
    values = [3, 5, 5, -7]
    row = spark.createDataFrame([(values,)], "hs array<bigint>").select(decontaminate.simhash(F.col("hs")).alias("fp")).first()
    expected = sum(1 << b for b in range(64) if 2 * sum((v >> b) & 1 for v in values) > 4)
    assert row["fp"] & (2**64 - 1) == expected


def test_blocks_cover_the_radius():
    # Two fingerprints within the radius share a block up to two flipped bits.
    assert decontaminate.RADIUS // decontaminate.BLOCKS <= 2 and len(set(decontaminate.FLIPS)) == 1 + 8 + 28


def test_empty_tables(spark):
    docs, items = _data()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.leaks(df.limit(0), bench).count() == 0
    assert decontaminate.leaks(df, bench.limit(0)).count() == 0
