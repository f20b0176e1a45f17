"""Results that were cut or lost rows before."""

from __future__ import annotations

from recordforge.operators import words as W
from recordforge.operators.validate import TYPED_FIELDS
from recordforge.queries import validate as queries

SCHEMA = "page_no int, word_ix long, text string, x1 double, y1 double, x2 double, y2 double"


def test_strict_query_lists_every_failed_field(spark, sf_dir):
    rows = queries.v2_validate_strict(spark, sf_dir).collect()
    assert all(len((r["failed"] or "").split(",")) == max(1, r["n_failed"]) for r in rows)
    assert 6 < max(r["n_failed"] for r in rows) <= len(TYPED_FIELDS)


def test_duplicates_of_repeated_and_keyless_words(spark):
    rows = [(None, 1, "a", 0.0, 0.0, 10.0, 10.0), (None, 2, "a", 1.0, 0.0, 11.0, 10.0), (None, 3, "a", 50.0, 0.0, 60.0, 10.0)]
    rows += [(1, 1, "a", 0.0, 0.0, 10.0, 10.0)] * 3 + [(1, 2, "a", 0.0, None, 10.0, None), (1, None, "b", 0.0, 0.0, 10.0, 10.0), (1, 4, None, 0.0, 0.0, 10.0, 10.0)]
    kept = W.dedupe_words(spark.createDataFrame(rows, SCHEMA), ["page_no"]).collect()
    assert sorted((r["page_no"] or 0, r["word_ix"] or 0, r["text"] or "") for r in kept) == [(0, 1, "a"), (0, 3, "a"), (1, 0, "b"), (1, 1, "a"), (1, 2, "a"), (1, 4, "")]


def test_lines_keep_words_of_pages_without_a_key(spark):
    rows = [(None, k, "t", 10.0 * k, 20.0 * (k // 3), 10.0 * k + 8, 20.0 * (k // 3) + 12) for k in range(9)] + [(1, 1, "t", 0.0, 0.0, 8.0, 12.0)]
    for lines in (W.group_lines_px, W.group_lines_unit):
        got = lines(spark.createDataFrame(rows, SCHEMA), ["page_no"]).collect()
        assert len(got) == 10 and len({(r["page_no"], r["segment"], r["part"]) for r in got}) == 4


def test_line_table_of_words_that_lie_apart(spark):
    rows = [(k % 2, k, chr(97 + k) if k != 4 else " ", 10.0 * (9 - k), 0.0, 10.0 * (9 - k) + 8, 12.0, 0.5 if k % 4 else None) for k in range(9)]
    words = spark.createDataFrame(rows, SCHEMA + ", confidence double").withColumnRenamed("page_no", "ln")
    got = {r["ln"]: r for r in W.line_table(words, [], ["ln"]).collect()}
    assert (got[0]["text"], got[1]["text"]) == ("i g c a", "h f d b")
    assert (got[0]["word_count"], got[0]["confidence"], got[0]["x1"], got[0]["x2"]) == (2, 0.5, 10.0, 98.0)


def test_exploded_rows_are_not_broadcast(spark):
    from recordforge.plans import typed

    raw = spark.range(20).selectExpr("id as doc_id", "explode(array('bil', 'saksi_1')) as field", "'1/1990' as raw_text", "0.9D as confidence")
    sheets = spark.range(20).selectExpr("id as doc_id", "1 as page_no", "15 as n_words", "cast(null as string) as error")
    found = typed.results_of_fields(raw, sheets, expected_pages=1)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_strict_rows_of_a_document_that_lie_apart(spark):
    """The rows of a scan were sorted for an aggregate; those of a document may lie apart, repeat or be null."""
    from pyspark.sql import functions as F

    from recordforge.operators import validate as V

    texts = [f for f in ("bil", "nama_suami", "ic_lama_suami", "ic_baru_suami", "nama_isteri", "ic_lama_isteri", "ic_baru_isteri", "mas_kahwin", "tarikh_nikah", *TYPED_FIELDS[8:14])]
    records = spark.range(3).select("id", *[F.lit("1/1990").alias(f) for f in texts], F.lit(30).alias("umur_suami"), F.lit(30).alias("umur_isteri"))
    raw = [(0, "bil", "a", 0.2), (1, "bil", None, 0.9), (0, "saksi_1", "BANGSA", 0.9), (0, "bil", "b", 0.7), (1, "bil", "c", None), (0, "bil", "b", 0.6)]
    out = V.validate_strict(records, spark.createDataFrame(raw, "id long, field string, raw_text string, confidence double"), ["id"], 0.5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "max(CASE" not in plan
    got = {r["id"]: {d["field"]: (d["confidence"], d["issues"]) for d in r["diagnostics"]} for r in out.collect()}
    assert got[0]["bil"] == (0.7, []) and got[0]["saksi_1"] == (0.9, ["contamination: BANGSA"])
    assert got[1]["bil"] == (0.0, ["confidence below threshold: 0.000"]) and got[2]["bil"] == (0.0, ["missing field"])


def test_second_readings_of_repeated_and_missing_fields(spark, monkeypatch):
    """Every document was assembled and checked three times, and its rows per field met in seven joins."""
    from recordforge.operators import extract
    from recordforge.plans import typed

    schema = "doc_id long, field string, raw_text string, confidence double"
    raw = [(1, "bil", "NO", 0.9), (1, "bil", "MAYBE", 0.2), (1, "nama_suami", "ALI", 0.3), (1, "other", "x", 0.9), (2, "bil", "1/1990", 0.9), (4, "bil", None, None)]
    again = [(1, "bil", "7/1991", 0.9), (1, "nama_suami", "ALI BIN ABU", 0.1), (1, "saksi_1", "SITI", 0.9), (2, "bil", "8/1991", 1.0), (3, "bil", "9/1991", 0.9), (4, "bil", "5/1990", None)]
    sheets = spark.range(1, 5).selectExpr("id as doc_id", "1 as page_no", "15 as n_words", "cast(null as string) as error")
    built = []
    monkeypatch.setattr(extract, "assemble_typed", lambda *a: built.append(a))
    found = typed.results_of_fields(spark.createDataFrame(raw, schema), sheets, expected_pages=1, retries=spark.createDataFrame(again, schema), max_retry=15)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not built and plan.count("Join ") == 2
    got = {r["doc_id"]: r for r in found.collect()}
    assert (got[1]["bil"], got[1]["nama_suami"], got[1]["saksi_1"], got[1]["retry_count"]) == ("7/1991", "ALI", "SITI", 3)
    assert (got[2]["bil"], got[2]["retry_count"], len(got[2]["failed_fields"])) == ("1/1990", 0, 14)
    assert (got[3]["status"], got[3]["retry_count"], got[3]["failed_fields"], got[3]["diagnostics"]) == ("FAILED", 0, [], None)
    # A second reading without a confidence is not better than none.
    assert (got[4]["bil"], got[4]["retry_count"], got[4]["diagnostics"][0]["valid"]) == (None, 0, False)
