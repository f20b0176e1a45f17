from __future__ import annotations

from recordforge.llm import lines

from .tools_check import compare

BOILER = "Please accept the terms of this site"
BORDER = "This line is on nine sites only"


def _rows():
    rows = []
    for i in range(30):
        own = [f"Story {i} begins with words of its own and goes on for a while", f"and story {i} ends with other words that nobody else has"]
        text = [own[0], f"  {BOILER}\t"] + ([BORDER] if i < 9 else []) + ["The", own[1], BOILER]
        rows.append((i, "\n".join(text), f"site{i % 12 if i >= 9 else i}", "z"))
    copies = "\n".join([BOILER, "A copied page about the same old thing as ever", "whose lines are on every site there is"])
    rows += [(100 + i, copies, f"site{i}", "z") for i in range(12)]
    rows += [(200, None, "site1", "z"), (201, "", "site1", "z"), (202, f"Only here are these words to be read\n{BOILER}\nand these others", None, "z"), (None, f"Null id but with enough words of its own\n{BOILER}", "site3", "z")]
    return rows + [rows[0]]


def _brute(rows, sites=10):
    page = lambda text: tuple(x.strip() for x in text.split("\n"))
    where = {}
    for _, text, site, _ in rows:
        if text is not None and site is not None:
            where.setdefault(page(text), set()).add(site)
    copied = {p: min(s) for p, s in where.items() if len(s) > 1}
    seen, own = {}, {}
    for _, text, site, _ in rows:
        for line in (text or "").split("\n"):
            if len(line.split()) >= 3 and site is not None:
                seen.setdefault(line.strip(), set()).add(site)
                if copied.get(page(text), site) == site:
                    own.setdefault(line.strip(), set()).add(site)
    out = []
    for doc, text, site, tag in rows:
        if text:
            spread = own if page(text) in copied else seen
            kept = [x for x in text.split("\n") if len(x.split()) < 3 or len(seen.get(x.strip(), ())) < sites or len(spread.get(x.strip(), ())) < sites]
            text = "\n".join(kept)
        out.append((doc, text, site, tag))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, flagged string")
    found = lines.dedup_lines(df)
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect()), key=str) == _brute(rows)
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert BOILER not in texts[3] and BORDER in texts[3] and "The" in texts[3].split("\n")
    assert texts[105] == "A copied page about the same old thing as ever\nwhose lines are on every site there is"


def test_exact_counts_settle_what_sketches_cannot(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, flagged string")
    monkeypatch.setattr(lines, "LG_K", 4)
    monkeypatch.setattr(lines, "BAND", 0.9)
    assert sorted(map(tuple, lines.dedup_lines(df).collect()), key=str) == _brute(rows)


def test_the_way_without_broadcasts_gives_the_same(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, flagged string")
    monkeypatch.setattr(lines, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, lines.dedup_lines(df).collect()), key=str) == _brute(rows)


def test_long_lines_and_empty_table(spark):
    df = spark.createDataFrame([(1, "word " * 100_000, "a")], "doc_id long, text string, source string")
    assert lines.dedup_lines(df).first()["text"] == "word " * 100_000
    assert lines.dedup_lines(df.limit(0), details=True).count() == 0


def test_flagged_lines_go_whatever_their_share(spark):
    rows = [*_rows(), (300, f"{BOILER}\n{BOILER}\nShort page", "site2", "z"), (301, f"{BOILER}\n{BOILER}", "site2", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, flagged string")
    found = lines.dedup_lines(df, details=True).collect()
    texts = {r["doc_id"]: r["text"] for r in found}
    assert texts[300] == "Short page" and texts[301] == ""
    assert {(r["n_lines"], r["n_removed"]) for r in found if r["doc_id"] in (300, 301, 200)} == {(3, 2), (2, 2), (0, 0)}
    assert sorted((tuple(r)[:4] for r in found), key=str) == _brute(rows)


def test_query_against_sql(spark, sf_dir, tmp_path):
    import duckdb

    own = str(tmp_path / "own")
    rows = [r[:3] for r in _rows()] + [(300, f"{BOILER}\n{BOILER}", "site2")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{own}/documents.parquet")
    for folder, pattern in ((sf_dir, ""), (own, "/*.parquet")):
        duck = duckdb.connect()
        duck.execute(f"create view documents as select * from '{folder}/documents.parquet{pattern}'")
        compare(spark, duck, "op8_line_dedup", folder)


def test_the_pipeline_keeps_no_boilerplate_in_short_pages(spark):
    import corpus_pipeline

    rows = [*_rows(), (300, f"{BOILER}\n{BOILER}\nShort page", "site2", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tag string")
    texts = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, df, "").collect()}
    assert texts[300] == "Short page"
