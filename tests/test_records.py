"""Decisions, merging, validation, store, review and export on small hand-made tables."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from recordforge.operators import candidates as C
from recordforge.operators import export as X
from recordforge.operators import reconcile as M
from recordforge.operators import review as R
from recordforge.operators import store as D
from recordforge.operators import training as T
from recordforge.operators import validate as V
from recordforge.functions.scan import steps
from recordforge.plans import ledger


def decide(spark, fields, retries, facts, settings=C.RefineSettings(), metric="levenshtein"):
    f = spark.createDataFrame(fields, "rec int, field string, value string")
    r = spark.createDataFrame(retries, "rec int, field string, attempt int, variant string, text string, confidence double")
    x = spark.createDataFrame(facts, "rec int, field string, has_crop boolean, retry_count int, retry_errors int")
    cands = C.refine_candidates(f, r, ["rec"], settings)
    return {d["field"]: d for d in C.decide(f, cands, ["rec"], x, settings, metric).collect()}


@pytest.mark.parametrize("metric", ["levenshtein", "gestalt"])
def test_decisions(spark, metric):
    fields = [(1, "tarikh_nikah", "30-02-1990"), (1, "nama_suami", "ABU BIN ALI"), (1, "ic_lama_suami", "X9"), (1, "ic_baru_suami", "9Z"), (1, "nama_wali", None), (1, "saksi_1", "A 1")]
    retries = [
        (1, "tarikh_nikah", 1, "gray", "28-02-1990", 0.9), (1, "tarikh_nikah", 4, "late", "01-01-1990", 0.99),
        (1, "ic_lama_suami", 1, "gray", "X9", 0.1),
    ]
    facts = [(1, f, f != "ic_baru_suami", 3, 3 if f == "saksi_1" else 0) for _, f, _ in fields]
    got = decide(spark, fields, retries, facts, metric=metric)
    assert got["nama_suami"]["reason"] == "accepted_without_retry" and not got["nama_suami"]["requires_review"]
    assert (got["tarikh_nikah"]["reason"], got["tarikh_nikah"]["selected_value"]) == ("accepted_after_retry", "28-02-1990")
    assert got["tarikh_nikah"]["candidate_source"] == "retry_gray"
    assert got["ic_baru_suami"]["reason"] == "missing_crop" and got["ic_baru_suami"]["selected_value"] == "9Z" and got["ic_baru_suami"]["requires_review"]
    assert got["nama_wali"]["reason"] == "no_valid_candidates" and got["nama_wali"]["requires_review"]
    assert got["saksi_1"]["reason"] == "retry_ocr_failed" and got["saksi_1"]["selected_value"] == "A 1"
    assert got["ic_lama_suami"]["selected_value"] == "X9" and got["ic_lama_suami"]["requires_review"]
    off = decide(spark, fields, retries, facts, C.RefineSettings(enabled=False))
    assert {d["reason"] for d in off.values()} == {"refinement_disabled"}


def test_audit_columns(spark):
    got = spark.createDataFrame([(1,)], "rec int").select(
        *[F.lit("x").alias(c if c != "field_name" else "field") for c in C.AUDIT_COLUMNS]
    )
    assert C.audit_rows(got).columns == list(C.AUDIT_COLUMNS)


@pytest.mark.parametrize(
    "text,expected",
    [
        ('```json\n{"k": 1, "note": "a"}\n```', (1, "a")),
        ('Sure: {"k": 2, "note": "b"} thanks', (2, "b")),
        ('{"k": 3, "note": "two\nlines"}', (3, "two\nlines")),
        ('{"k": 4, "note": "cu', (4, "cu")),
        ('{"k": 5, "note":', (5, None)),
        ('{"k": 6, "list": [1, 2,], "note": "c",}', (6, "c")),
        ('{"a": {"x": 1,}, "k": 7, "note": "d"}', (7, "d")),
        ('{"note": "x, }", "b": [1,], "k": 8}', (8, "x, }")),
        ('{"a": [1,2,], "b": {"c": [3,],}, "k": 9}', (9, None)),
        ('{"k": 10, "note": "e", "list": [1, {"z": "y', (10, "e")),
        ("nothing here", None),
    ],
)
def test_response_repair(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "rec int, payload string")
    row = M.parse_responses(df, "payload", "k bigint, note string", ["rec"]).first()
    if expected is None:
        assert row["response"] is None and row["parse_error"] == "invalid JSON" and row["payload"] == text
    else:
        assert (row["response"]["k"], row["response"]["note"]) == expected and row["parse_error"] is None


def test_responses_lose_nothing(spark):
    long = "no object " * 500
    df = spark.createDataFrame([(1, long), (2, '{"k": "abc", "note": "n"}'), (3, '{"k": 1}'), (4, None), (5, '{"k": 5, "note": "c')], "rec int, payload string")
    rows = {r["rec"]: r for r in M.parse_responses(df, "payload", "k bigint, note string", ["rec"]).collect()}
    assert rows[1]["payload"] == long and rows[1]["parse_error"] == "invalid JSON"
    assert rows[2]["parse_error"] == "type mismatch" and (rows[2]["response"]["k"], rows[2]["response"]["note"]) == (None, "n")
    assert rows[3]["payload"] is None and not rows[3]["repaired"] and rows[4]["parse_error"] == "invalid JSON"
    assert rows[5]["repaired"] and rows[5]["parse_error"] is None


def test_repair_is_linear():
    started = time.time()
    M.repair_json('{"a": bad, ' + '"b": 1, ' * 40_000)
    M.repair_json('{"a": [1' + ",],[1" * 40_000)
    M.repair_json("{" * 40_000)
    assert time.time() - started < 20


def test_uncorroborated_critical_field_forces_review(spark):
    left = spark.createDataFrame([(1, None, "x")], "rec int, tarikh_nikah string, remarks string")
    right = spark.createDataFrame([(1, "01-01-1990", "X.", {"tarikh_nikah": 0.99, "remarks": 0.9}, 0.9)], "rec int, tarikh_nikah string, remarks string, field_confidence map<string,double>, confidence double")
    row = M.reconcile(left, right, ["rec"], ["tarikh_nikah", "remarks"], ["tarikh_nikah"]).first()
    assert (row["tarikh_nikah"], row["remarks"], row["must_review"]) == ("01-01-1990", "x", True)
    assert row["review_reason"] == ["tarikh_nikah: filled by model with no parser corroboration; review required"]
    checked = spark.createDataFrame([(1, "OK", [])], "rec int, status_review string, review_reason array<string>")
    merged = M.reconcile(left, right, ["rec"], ["tarikh_nikah", "remarks"], ["tarikh_nikah"])
    assert M.keep_merge_reasons(checked, merged, ["rec"]).first()["status_review"] == "REVIEW"


GOOD = dict(
    rec=1, nama_suami="AAA BIN BBB", nama_isteri="CCC", ic_lama_suami="A123456", ic_baru_suami=None, ic_lama_isteri=None, ic_baru_isteri="900101101234", umur_suami=25,
    umur_isteri=23, mas_kahwin="RM 80.00", mas_kahwin_raw="RM 80", tarikh_nikah="01-02-1990", tarikh_keluar=None, tarikh_keluar_raw=None, nama_pendaftar="P",
    alamat_pendaftar="Q", nama_wali="W", hubungan_wali="BAPA", saksi_1="S", saksi_2="T",
)
GOOD_DDL = ", ".join(f"{k} {'int' if k in ('rec', 'umur_suami', 'umur_isteri') else 'string'}" for k in GOOD)


def test_records_are_refined_before_validation(spark):
    row = GOOD | {"nama_suami": "AAA B1N BBB", "ic_lama_suami": "X9", "tarikh_nikah": None, "tarikh_keluar": "01-02-1990"}
    records = spark.createDataFrame([tuple(row.values())], GOOD_DDL)
    crops = spark.createDataFrame([(1, "suami_isteri", 3, 0), (1, "tarikh_nikah", 0, 1)], "rec int, cell string, retry_count int, retry_errors int")
    retries = spark.createDataFrame(
        [(1, "ic_lama_suami", a, f"v{a}", "A1234567", 0.95) for a in (1, 2, 3)], "rec int, field string, attempt int, variant string, text string, confidence double"
    )
    refined, decisions = ledger.refine_records(records, ["rec"], crops, retries)
    found = refined.first()
    reasons = {d["field"]: d["reason"] for d in decisions.collect()}
    assert found["ic_lama_suami"] == "A1234567" and reasons["ic_lama_suami"] == "accepted_after_retry"
    # No crop, no decision; an unreadable date stays and asks for review.
    assert "nama_wali" not in reasons and found["nama_wali"] == "W" and found["tarikh_keluar"] == "01-02-1990"
    assert found["tarikh_nikah"] is None and found["refinement_requires_review"]
    assert refined.count() == 1 and set(records.columns) < set(refined.columns)
    settings = V.ValidationSettings(use_refinement_flag=True)
    cells = spark.createDataFrame([(1, "bil", "x", 0.9)], "rec int, cell string, text string, avg_conf double")
    assert "refinement needs review" in V.validate_records(refined, cells, ["rec"], settings).first()["review_reason"]


def test_unknown_confidence_is_not_silence(spark):
    records = spark.createDataFrame([tuple(GOOD.values())], GOOD_DDL)
    for text, conf, status, reason in (("x", None, "REVIEW", True), ("x", 0.9, "OK", False), (" ", None, "FAILED_OCR", True)):
        cells = spark.createDataFrame([(1, "bil", text, conf)], "rec int, cell string, text string, avg_conf double")
        row = V.validate_records(records, cells, ["rec"]).first()
        assert row["status_review"] == status and bool(row["review_reason"]) == reason


@pytest.mark.parametrize(
    "change,text,status,confidence,reason",
    [
        ({}, "x", "OK", 1.0, None),
        ({"nama_isteri": None}, "x", "REVIEW", 0.8, "missing wife name"),
        ({"ic_lama_suami": "1111111"}, "x", "REVIEW", 0.85, "suspicious husband IC (implausible digits)"),
        ({"mas_kahwin_raw": "80"}, "x", "REVIEW", 1.0, "mas kahwin missing RM prefix"),
        ({}, " ", "FAILED_OCR", 0.0, "OCR returned empty text"),
    ],
)
def test_validation(spark, change, text, status, confidence, reason):
    records = spark.createDataFrame([tuple((GOOD | change).values())], GOOD_DDL)
    cells = spark.createDataFrame([(1, "bil", text, 0.9)], "rec int, cell string, text string, avg_conf double")
    row = V.validate_records(records, cells, ["rec"]).first()
    assert (row["status_review"], row["confidence"]) == (status, confidence)
    assert row["review_reason"] == ([] if reason is None else [reason])


def test_upsert_twice_is_once_and_keeps_created(spark):
    ddl = "k int, v string, created_at string, updated_at string"
    target = spark.createDataFrame([(1, "a", "t0", "t0"), (2, "b", "t0", "t0")], ddl)
    source = spark.createDataFrame([(2, "c", "t1", "t1", 1), (2, "d", "t1", "t2", 2), (3, "e", "t1", "t1", 1)], ddl + ", seq int")
    once = D.upsert(target, source, ["k"], ["seq"])
    twice = D.upsert(once, source, ["k"], ["seq"])
    rows = sorted(tuple(r) for r in once.collect())
    assert rows == [(1, "a", "t0", "t0"), (2, "d", "t0", "t2"), (3, "e", "t1", "t1")]
    assert sorted(tuple(r) for r in twice.collect()) == rows


def test_counters_over_insert_retry_and_change(spark):
    events = [(7, 0, "OK"), (7, 1, "OK"), (7, 2, "REVIEW")]
    for n, expected in ((1, (1, 0)), (2, (1, 0)), (3, (0, 1))):
        df = spark.createDataFrame([(*e, 1) for e in events[:n]], "k int, o int, status string, b int")
        row = D.status_transitions(df, ["k"], ["o"], ["b"], [steps("o", 1)]).first()
        assert (row["ok_records"], row["review_records"]) == expected


def test_overlay_replaces_whole_record(spark):
    base = spark.createDataFrame([(1, "a", "b"), (2, "a", "b")], "rec int, x string, y string")
    bare = spark.createDataFrame([(1, None, "z")], "rec int, x string, y string")
    rows = {r["rec"]: r for r in R.overlay(base, bare, ["rec"]).collect()}
    assert (rows[1]["x"], rows[1]["y"], rows[1]["verified"], rows[1]["corrected"]) == (None, "z", False, True)
    assert (rows[2]["x"], rows[2]["verified"]) == ("a", False)


def test_edits_reject_bad_integers(spark):
    base = spark.createDataFrame([(1, 3)], "rec int, size int")
    with pytest.raises(Exception, match="invalid integer value"):
        R.apply_edits(base, spark.createDataFrame([(1, "x3")], "rec int, size string"), ["rec"], ["size"]).collect()


def test_column_configuration():
    visible, hidden = X.resolve_columns([" Bil ", "Bil", "Status"])
    assert visible == ["Bil", "Status"] and len(hidden) == 42
    assert len(X.resolve_columns()[0]) == 43 and len(X.resolve_columns(include_raw=False)[0]) == 23
    for bad in (["Nope"], [], "Bil"):
        with pytest.raises(ValueError):
            X.resolve_columns(bad)


def test_split_is_stable_and_keeps_records_together(spark):
    df = spark.range(2000).select(F.lit("f").alias("file"), (F.col("id") % 500).alias("rec"), "id")
    a = {(r["id"]): r["dataset_split"] for r in T.hash_split(df, ["file", "rec"], 0.3).collect()}
    b = {(r["id"]): r["dataset_split"] for r in T.hash_split(df.repartition(7), ["file", "rec"], 0.3).collect()}
    assert a == b and len({(i % 500, s) for i, s in a.items()}) == 500
    assert {r[0] for r in T.hash_split(df, ["rec"], 0).select("dataset_split").distinct().collect()} == {"train"}


def test_typed_rows_order_and_latest(spark):
    rows = [("b.pdf", "1/1990", dt.datetime(2024, 1, 1)), ("A.pdf", "2/1990", dt.datetime(2024, 1, 1)), ("b.pdf", "3/1990", dt.datetime(2024, 1, 2))]
    out = X.typed_rows(spark.createDataFrame(rows, "source_file string, bil string, processed_at timestamp")).collect()
    assert [(r["Source File"], r["Bil"]) for r in out] == [("A.pdf", "2/1990"), ("b.pdf", "3/1990")] and len(out[0]) == 24
