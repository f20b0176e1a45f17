"""Spatial operators against brute force on small random pages."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from recordforge.functions.scan import ordered_scan, steps
from recordforge.operators import geometry as G
from recordforge.operators import words as W

SCHEMA = "doc_id string, page_no int, word_ix long, text string, confidence double, x1 double, y1 double, x2 double, y2 double"


def pages(seed, n=120, docs=3, spread=300, texts="ab"):
    rng = random.Random(seed)
    rows = []
    for d in range(docs):
        for i in range(n):
            x, y = rng.randrange(spread), rng.randrange(spread)
            rows.append((f"d{d}", 1, i, rng.choice(texts), rng.random(), float(x), float(y), float(x + rng.randint(5, 60)), float(y + rng.randint(6, 24))))
    return rows


def iou(a, b):
    w, h = min(a[7], b[7]) - max(a[5], b[5]), min(a[8], b[8]) - max(a[6], b[6])
    if w <= 0 or h <= 0:
        return 0.0
    area = lambda r: max(1.0, (r[7] - r[5]) * (r[8] - r[6]))
    return w * h / (area(a) + area(b) - w * h)


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_duplicates(spark, seed):
    rows = pages(seed, spread=90)
    rows += [(d, p, i + 1000, t.upper() + " ", c, *box) for d, p, i, t, c, *box in rows[:60]]
    expected = set()
    for doc in {r[0] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[0] == doc), key=lambda r: r[2]):
            if not any(k[3].strip().upper() == r[3].strip().upper() and iou(k, r) >= 0.5 for k in kept):
                kept.append(r)
        expected |= {(r[0], r[2]) for r in kept}
    got = W.dedupe_words(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["doc_id"], r["word_ix"]) for r in got} == expected


@pytest.mark.parametrize("unit", [False, True])
def test_reading_order_fold(spark, unit):
    scale = 1 / 3000 if unit else 1.0
    rows = [(*r[:5], *(c * scale for c in r[5:])) for r in pages(7, n=150, spread=260)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = (W.group_lines_unit if unit else W.group_lines_px)(df, ["doc_id"]).collect()
    for doc in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == doc]
        cy = lambda r: (r[6] + r[8]) / 2.0
        mean = sum(max(1.0, r[8] - r[6]) for r in mine) / len(mine)
        tol = 0.008 if unit else max(10.0, mean * 0.75)
        lines = []
        for r in sorted(mine, key=(lambda r: (cy(r), r[5], r[2])) if unit else (lambda r: (r[6], r[5], r[2]))):
            if lines and abs(cy(r) - sum(map(cy, lines[-1])) / len(lines[-1])) <= tol:
                lines[-1].append(r)
            else:
                lines.append([r])
        by_line = {}
        for g in got:
            if g["doc_id"] == doc:
                by_line.setdefault((g["segment"], g["part"]), set()).add(g["word_ix"])
        assert [by_line[k] for k in sorted(by_line)] == [{r[2] for r in line} for line in lines]


def test_assignment_over_tiles(spark):
    words = pages(3, n=80, spread=1500)
    cells = [("d0", 1, i, f"c{i}", x * 97.0, y * 83.0, x * 97.0 + 300, y * 83.0 + 290) for i, (x, y) in enumerate((a, b) for a in range(8) for b in range(8))]
    got = W.assign_words(
        spark.createDataFrame(words, SCHEMA), spark.createDataFrame(cells, "doc_id string, page_no int, record_ix int, cell string, x1 double, y1 double, x2 double, y2 double")
    ).collect()
    expected = set()
    for w in (w for w in words if w[0] == "d0"):
        for c in cells:
            cx, cy = (w[5] + w[7]) / 2, (w[6] + w[8]) / 2
            iw, ih = min(w[7], c[6]) - max(w[5], c[4]), min(w[8], c[7]) - max(w[6], c[5])
            part = iw * ih / max(1.0, (w[7] - w[5]) * (w[8] - w[6])) if iw > 0 and ih > 0 else 0
            if (c[4] <= cx <= c[6] and c[5] <= cy <= c[7]) or part >= 0.45:
                expected.add((c[2], w[2]))
    assert len(got) == len(expected) and {(r["record_ix"], r["word_ix"]) for r in got} == expected


def _greedy(rows, threshold):
    kept = []
    for r in rows:
        if not any(iou(k, r) >= threshold for k in kept):
            kept.append(r)
    return [r[2] for r in kept]


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.9])
def test_kept_boxes_by_place_equal_all_kept_boxes(threshold):
    rng = random.Random(11)
    rows = []
    for i in range(700):
        size = rng.choice([0.3, 1.0, 7.0, 60.0, 900.0])
        x, y = rng.uniform(-80, 80), rng.uniform(-80, 80)
        rows.append(("d", 1, i, "a", 1.0, x, y, x + size * rng.uniform(0.5, 1.5), y + size * rng.uniform(0.2, 1.0)))
    rows += [("d", 1, 800, "a", 1.0, 5.0, 5.0, 5.0, 9.0), ("d", 1, 801, "a", 1.0, 5.0, 5.0, 4.0, 9.0), ("d", 1, 802, "a", 1.0, 0.0, 0.0, float("inf"), 9.0)]
    kept = W.KeptBoxes(threshold)
    assert [r[2] for r in rows if kept.add(*r[5:])] == _greedy(rows, threshold)


def test_one_island_of_many_words(spark):
    """Near copies of one word all over one place of a page: no pairs, no page in one frame."""
    n = 100_000
    df = spark.range(n).selectExpr(
        "'d' as doc_id", "1 as page_no", "id as word_ix", "'same' as text", "1.0D as confidence",
        "(id * 37 % 101) / 50.0D as x1", "(id * 53 % 97) / 50.0D as y1", "40 + (id * 37 % 101) / 50.0D as x2", "12 + (id * 53 % 97) / 50.0D as y2",
    )
    got = sorted(r["word_ix"] for r in W.dedupe_words(df.coalesce(2)).collect())
    rows = [("d", 1, i, "same", 1.0, (x := i * 37 % 101 / 50), (y := i * 53 % 97 / 50), 40 + x, 12 + y) for i in range(2000)]
    # The first word overlaps all others enough.
    assert got == _greedy(rows, 0.5) == [0]
    stairs = df.selectExpr("doc_id", "page_no", "word_ix", "text", "confidence", "word_ix * 10.0D as x1", "word_ix * 3.0D as y1", "word_ix * 10.0D + 40 as x2", "word_ix * 3.0D + 12 as y2")
    rows = [("d", 1, i, "same", 1.0, i * 10.0, i * 3.0, i * 10.0 + 40, i * 3.0 + 12) for i in range(400)]
    got = sorted(r["word_ix"] for r in W.dedupe_words(stairs).collect())
    assert got[:50] == _greedy(rows, 0.5)[:50] and len(got) > n / 3


def test_touching_lines_of_a_long_page_stream(spark):
    n = 60_000
    df = spark.range(n).selectExpr(
        "'d' as doc_id", "1 as page_no", "id as word_ix", "'w' as text", "1.0D as confidence", "id % 7 * 50.0D as x1", "id * 0.9D as y1", "id % 7 * 50.0D + 40 as x2", "id * 0.9D + 12 as y2"
    )
    line, total, count, expected = 0, 0.0, 0, []
    for i in range(n):
        y = i * 0.9 + 6
        if count and abs(y - total / count) > 10.0:
            line, total, count = line + 1, 0.0, 0
        total, count = total + y, count + 1
        expected.append(line)
    got = W.group_lines_px(df, ["doc_id"]).select("word_ix", "segment", "part").orderBy("word_ix").collect()
    assert [r["part"] for r in got] == expected and len({r["segment"] for r in got}) == 1


def test_boxes_of_any_size_are_a_handful_of_rows(spark):
    words = pages(4, n=60, docs=1, spread=3000) + [("d0", 1, 900, "wild", 1.0, -1e12, -1e12, 1e12, 1e12), ("d0", 1, 901, "long", 1.0, 0.0, 10.0, 9e6, 30.0)]
    cells = [("d0", 1, 0, "page", 0.0, 0.0, 3000.0, 4000.0), ("d0", 1, 1, "wild", -1e15, -1e15, 1e15, 1e15), ("d0", 1, 2, "row", 0.0, 500.0, 250_000.0, 900.0), ("d0", 1, 3, "small", 100.0, 100.0, 400.0, 900.0)]
    schema = "doc_id string, page_no int, record_ix int, cell string, x1 double, y1 double, x2 double, y2 double"
    left, right = spark.createDataFrame(words, SCHEMA), spark.createDataFrame(cells, schema)
    assert W._tiled(right, "right", "left").where("cell in ('page', 'wild', 'row')").count() < 250
    assert W._tiled(left, "left", "right").where("word_ix >= 900").count() < 12
    expected = set()
    for w in words:
        for c in cells:
            cx, cy = (w[5] + w[7]) / 2, (w[6] + w[8]) / 2
            iw, ih = min(w[7], c[6]) - max(w[5], c[4]), min(w[8], c[7]) - max(w[6], c[5])
            part = iw * ih / max(1.0, (w[7] - w[5]) * (w[8] - w[6])) if iw > 0 and ih > 0 else 0
            if (c[4] <= cx <= c[6] and c[5] <= cy <= c[7]) or part >= 0.45:
                expected.add((c[2], w[2]))
    got = [(r["record_ix"], r["word_ix"]) for r in W.assign_words(left, right).collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_transform_without_words(spark):
    sheets = spark.createDataFrame([("a", 1, 0), ("b", 1, 3)], "doc_id string, page_no int, n_words int")
    words = spark.createDataFrame([("b", 1, 0, "FORM", 1.0, 0.11, 0.21, 0.2, 0.22), ("b", 1, 1, "end", 1.0, 0.11, 0.81, 0.2, 0.82)], SCHEMA)
    marks = [W.Anchor(1, "Form", 0.1, 0.2), W.Anchor(1, "END", 0.1, 0.8)]
    got = {r["doc_id"]: r for r in W.estimate_transform(sheets, W.match_phrases(words, marks)).collect()}
    assert not got["a"]["safe"] and got["a"]["diagnostics"] == ["no words for page"]
    assert got["b"]["safe"] and abs(got["b"]["dx"] - 0.01) < 1e-9 and abs(got["b"]["sy"] - 1.0) < 1e-9


def test_ordered_scan_equals_plain_scan(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.8 else rng.choice(["x", None]), i, rng.randrange(50)) for i in rng.sample(range(5000), 700)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    got = ordered_scan(
        df, ["k"], ["o"], [steps("o", 37)], index="ix", size="n", lag={"p": F.col("v")}, lead={"q": F.col("v")}, total={"t": F.col("v")},
        peak={"m": F.col("v")}, peak_before={"b": F.col("v")}, runs=("run", F.col("p").isNull() | (F.col("v") < F.col("p"))),
    ).collect()
    assert len(got) == len(rows)
    for key in ("hot", "x", None):
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        found = sorted((r for r in got if r["k"] == key), key=lambda r: r["o"])
        run = 0
        for i, (r, g) in enumerate(zip(mine, found)):
            before = [x[2] for x in mine[:i]]
            run += not before or r[2] < before[-1]
            assert (g["ix"], g["n"], g["t"], g["m"], g["run"]) == (i + 1, len(mine), sum(before) + r[2], max([*before, r[2]]), run)
            assert (g["p"], g["b"]) == ((before[-1], max(before)) if before else (None, None))
            assert g["q"] == (mine[i + 1][2] if i + 1 < len(mine) else None)


def test_global_index(spark):
    rng = random.Random(6)
    rows = [(i if i % 50 else None, rng.randrange(9)) for i in rng.sample(range(-40_000_000, 40_000_000), 3000)]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "o long, v int")
    for chunk in ([steps("o", 3)], [steps("o", 1000)], [steps("o", 1e9)], [F.col("o").cast("string").isNotNull()]):
        got = {r["o"]: r["ix"] for r in ordered_scan(df, [], ["o"], chunk, index="ix").collect()}
        expected = sorted((r[0] for r in rows), key=lambda o: (o is not None, o or 0))
        assert got == {o: i + 1 for i, o in enumerate(expected)}
    assert ordered_scan(df.limit(0), [], ["o"], [steps("o", 3)], index="ix").count() == 0


def test_global_index_over_a_million_chunks(spark):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") * 7).alias("o"))
    numbered = ordered_scan(df, [], ["o"], [steps("o", 7)], index="ix")
    found = numbered.agg(F.count("*").alias("n"), F.count_if(F.col("ix") != F.col("o") / 7 + 1).alias("wrong")).first()
    assert (found["n"], found["wrong"]) == (n, 0)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all(line.count("[") >= 3 and not line.rstrip().endswith("[], []") for line in windows)
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString().split("Window")[0]


def test_record_starts_and_boxes(spark):
    markers = spark.createDataFrame([("p", 5, 100, 40, 25), ("p", 5, 300, 40, 25), ("p", 5, 310, 90, 25)], "page string, x int, y int, width int, height int")
    merged = G.merge_close(markers, ["page"], 80)
    assert sorted(r["y"] for r in merged.collect()) == [100, 310]
    lines = spark.createDataFrame([("p", 90), ("p", 305), ("p", 420)], "page string, y int")
    tables = spark.createDataFrame([("p", 0, 50, 1000, 550), ("q", 0, 10, 900, 500)], "page string, left int, top int, right int, bottom int")
    starts = G.record_starts(merged, lines, tables, ["page"], 100)
    assert [r["start"] for r in starts.orderBy("record_ix").collect()] == [90, 305]
    boxes = {(r["page"], r["top"], r["bottom"]) for r in G.record_boxes(starts, tables, ["page"], 100).collect()}
    assert boxes == {("p", 90, 305), ("p", 305, 550), ("q", 10, 500)}


def test_starts_chosen_together_equal_trying_all(spark):
    import itertools

    rng = random.Random(12)
    markers, lines, tables, expected = [], [], [], set()
    least, most, gap = 80, 150, 40
    for page in range(40):
        n, top = rng.randint(1, 6), rng.randint(0, 90)
        ys = sorted(rng.sample(range(60, 900), n))
        bottom = ys[-1] + rng.randint(20, 300)
        covered = {y: rng.randrange(1000) for y in rng.sample(range(0, 950), 14)} | ({top: 500} if page % 3 == 0 else {})
        markers += [(page, y) for y in ys]
        lines += [(page, y, c) for y, c in covered.items()]
        tables.append((page, 0, top, 500, bottom))
        choices = []
        for i, y in enumerate(ys):
            near = sorted(c for c in covered if c < y and y - c <= 140)[-5:]
            choices.append(sorted(set(near or [max(top, y - 20)] + ([top] if i == 0 else []))))
        tall = (bottom - top) / n
        allowed, best = max(most * 1.5, tall * 1.25), None
        for starts in itertools.product(*choices):
            ends = [*starts[1:], bottom]
            if any(s >= y for s, y in zip(starts, ys)) or any(b <= a + gap for a, b in zip(starts, starts[1:])) or any(e <= s for s, e in zip(starts, ends)):
                continue
            cost = 0.0
            for y, s, e in zip(ys, starts, ends):
                cost += abs(y - s - 20) * 2 + abs(e - s - tall) * 2 + (250 + (least - (e - s)) * 4 if e - s < least * 0.75 else 0) + (120 + (e - s - allowed) * 2.5 if e - s > allowed else 0)
                cost += 25 if s not in covered else -covered[s] / 120
            if best is None or cost < best[0] - 1e-6:
                best = (cost, starts)
        if n > 1 and best is not None:
            expected |= {(page, i + 1, s) for i, s in enumerate(best[1])}
    frames = (
        spark.createDataFrame(markers, "page int, y int"), spark.createDataFrame(lines, "page int, y int, coverage int"),
        spark.createDataFrame(tables, "page int, left int, top int, right int, bottom int"),
    )
    plain = {(r["page"], r["record_ix"]): r["start"] for r in G.record_starts(*frames, ["page"], least).collect()}
    got = {(r["page"], r["record_ix"]): r["start"] for r in G.optimised_starts(*frames, ["page"], least, most).collect()}
    chosen = {(p, i): s for p, i, s in expected}
    assert len(chosen) > 60 and got == {k: chosen.get(k, s) for k, s in plain.items()}
    few = G.optimised_starts(*frames, ["page"], least, most, most=1).collect()
    assert {(r["page"], r["record_ix"]): r["start"] for r in few} == plain


def test_phrases_of_shuffled_words_are_those_of_the_stream(spark):
    """Every word was a row of a shuffle and of a window."""
    import random

    rng = random.Random(3)
    texts = ["of", "the", "a-of", "the.of", "", "--", None, "der", "x", "strasse", "of the", "straße"]
    words = [(doc, 1 + doc % 2, n, rng.choice(texts), rng.choice([None, float("nan"), *range(12)]) if doc == 5 else float(n // 40), float(rng.randrange(9))) for doc in range(6) for n in range(500)]
    words += [(9, 1, n, ("of", "-", "the")[n], 5.0 * n, 0.0) for n in range(3)] + [(None, 1, 1, "Der", 0.0, 0.0)]
    words = [(d, p, n, t, None if y is None else float(y), x) for d, p, n, t, y, x in words]
    marks = [W.Anchor(1, "of the of", 0.1, 0.1), W.Anchor(1, "of the", 0.1, 0.2), W.Anchor(1, "DER", 0.1, 0.3), W.Anchor(2, "of of strasse the", 0.1, 0.4), W.Anchor(1, "--", 0.1, 0.5), W.Anchor(2, "of the", 0.1, 0.6)]
    want = {}
    rank = lambda v: (v is not None, v != v, 0.0 if v is None or v != v else v)
    for doc, page in {(w[0], w[1]) for w in words}:
        stream = []
        for w in sorted((w for w in words if w[:2] == (doc, page)), key=lambda w: (rank(w[4]), rank(w[5]), w[2])):
            stream += [(t, w) for t in "".join(c if c.isascii() and c.isalnum() else " " for c in (w[3] or "").upper()).split()]
        for number, mark in enumerate(marks):
            tokens = mark.phrase.upper().replace("-", " ").split()
            for at in range(len(stream)) if tokens and mark.page_no == page else ():
                if [t for t, _ in stream[at : at + len(tokens)]] == tokens:
                    want[doc, page, number] = (str(stream[at][1][5]), str(stream[at][1][4]))
                    break
    rng.shuffle(words)
    df = spark.createDataFrame(words, "doc_id long, page_no int, word_ix long, text string, y1 double, x1 double").repartition(5)
    for chunk in (0.5, 3.0, 1000.0):
        found = W.match_phrases(df, marks, chunk=chunk)
        assert {(r["doc_id"], r["page_no"], r["anchor_ix"]): (str(r["observed_x"]), str(r["observed_y"])) for r in found.collect()} == want
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    assert len(want) > 12


def test_line_runs_are_the_lines_and_deal_words_once(spark):
    """Words travelled with all their columns, shaken ones in a row each, and once more for the numbers of their lines."""
    from recordforge.functions.pack import packed

    rows = [(k % 3 if k % 7 else None, k, f"w{k}", 50.0 * (k % 20), 8.0 * (k // 30) + k % 3 + 3 * (k % 2), 0.0, 8.0 * (k // 30) + k % 3 + 12) for k in range(600)]
    words = spark.createDataFrame([(*r[:5], r[3] + 40, r[6]) for r in rows], "doc_id int, word_ix long, text string, x1 double, y1 double, x2 double, y2 double")
    for runs, lines, args in ((W.line_runs_px, W.group_lines_px, ()), (W.line_runs_unit, W.group_lines_unit, (6.0,)), (W.line_runs_gap, W.group_lines_gap, (1.0,))):
        got = runs(words, ["doc_id"], *args)
        assert got.columns == ["doc_id", "segment", "part", "word_ix"]
        found = sorted((r["doc_id"] or -1, w, r["segment"], r["part"]) for r in got.collect() for w in r["word_ix"])
        assert found == sorted((r["doc_id"] or -1, r["word_ix"], r["segment"], r["part"]) for r in lines(words, ["doc_id"], *args).collect())
        assert len(found) == 600 and len({f[2:] for f in found}) > 3
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        packs = [line for line in plan.splitlines() if "MapInArrow" in line and "__band" in line]
        # Both sides pack the same columns, so that they share the exchange, and none packs the text.
        assert packs and all("text" not in line and all(f"{c}#" in line for c in ("word_ix", "x1", "y1", "y2")) for line in packs)
    apart = spark.createDataFrame([(k % 2, k) for k in range(10)], "a int, b int").coalesce(1)
    assert sorted((r["a"], r["b"]) for r in packed(apart, ["a"], gather=True).collect()) == [(0, [0, 2, 4, 6, 8]), (1, [1, 3, 5, 7, 9])]
    assert packed(apart, ["a"]).count() == 10
