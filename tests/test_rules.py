"""Golden cases of the text and field rules (all values are invented)."""

from __future__ import annotations

import difflib
import random

import pytest
from pyspark.sql import functions as F

from recordforge.functions import fields as X
from recordforge.functions import text as T
from recordforge.operators import extract as E
from recordforge.operators import normalize as N


def apply(spark, rule, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", rule(F.col("t")).alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["i"])]


@pytest.mark.parametrize(
    "rule,cases",
    [
        (T.normalise_text, {"a  b1n c\rhj. x ": "A BIN C\nHJ X", "éb1n": "ÉB1N", "kg.x mohd.": "KG.X MOHD", None: ""}),
        (T.clean_name, {"abu 12 tahun": "ABU", "ali b.": "ALI B.", "ali kassim.": "ALI KASSIM", "--": "--", "123": None}),
        (T.repair_ids, {"A 1O345": "A 10345", "r/f 11B395": "R/F 118395", "12O4-56/S8": "1204-56/S8"}),
        (X.ledger_serial, {"460/94": "460/94", "46O|94": "460/94", "4601": "460", "x 12": "12", "none": None}),
        (X.typed_serial, {"no 7 / 1994 x": "7/1994", "7/94": None}),
        (X.typed_money, {"rm 1,234.5": "RM 1,234.5", "RM 80": "RM 80", "80": None, "RM 12345.67": "RM 12,345.67"}),
        (X.date_value, {"27.894": "27-08-1994", "29.2.1900": None, "29/02/00": "29-02-2000", "1994-08-27": "27-08-1994", "I.2.31": "01-02-1931"}),
        (X.valid_id, {"900101011234": True, "901301011234": False, "A.123456": True, "R/F119395": True, "12": False, None: False}),
        (X.suspicious_id, {"1111111": True, "1111": False, "1111112": False, None: False}),
        (X.valid_date, {"30-02-1990": False, "28-02-1990": True, "": False}),
        (X.suspicious_name, {"": True, "AB 1": True, "AB @ CD": False}),
        (E.ordinal, {"record_007": 7, "-3": -3, "page 3 of 12.": 12, "none": 1}),
        (E.name_value, {" abu b1n kassim. ": "ABU BIN KASSIM", "": None}),
    ],
)
def test_scalar_rules(spark, rule, cases):
    assert apply(spark, rule, list(cases)) == list(cases.values())


def test_ledger_money(spark):
    got = apply(spark, X.ledger_money, ["RM 8O.OO", "80", "8", "12345", "RM 1I0.5O", "RM 5\nabc", "abc"])
    assert [(g["value"], g["needs_review"]) for g in got] == [
        ("RM 80.00", False), ("RM 80.00", True), (None, False), ("RM 123.45", True), ("RM 110.50", False), ("RM 5.00", False), (None, False),
    ]


def test_ledger_ages(spark):
    assert apply(spark, X.ledger_ages, ["25 TAHUN / 73 THN", "14 TAHUN 101 THN", "25 TAHN 25 TAHUN"]) == [[25, 23], [], [25]]


def test_ledger_ids(spark):
    got = apply(spark, X.ledger_ids, ["A 1000001 25 TAHUN", "900101011234", "900101-01-1234 A.123456", "1234567"])
    assert [(g["legacy"], g["modern"]) for g in got] == [("A1000001", None), (None, "900101011234"), ("A123456", "900101011234"), ("1234567", None)]


def test_spouse_cell(spark):
    text = "AAA BIN BBB\nA 1000001 25 TAHUN\n-\nCCC BINTI DDD\n900101011234 23 THN\nRM 8O.OO"
    rows = E.segment_people(spark.createDataFrame([(1, text)], "rec int, text string"), "text", ["rec"]).orderBy("person_no").collect()
    assert [(r["name"], r["id_legacy"], r["id_modern"], r["age"]) for r in rows] == [
        ("AAA BIN BBB", "A1000001", None, 25),
        ("CCC BINTI DDD", None, "900101011234", 23),
    ]


def test_assembled_record_has_no_issues(spark):
    cells = {
        "bil": "460/94", "suami_isteri": "AAA BIN BBB\nA 1000001 25 TAHUN\nCCC BINTI DDD\n900101011234 23 THN\nRM 80.00",
        "pendaftar": "EEE BIN FFF\nPEJABAT MASJIO", "wali": "GGG BIN HHH", "hubungan_wali": "BAPA", "saksi": "1) JJJ\n2) KKK",
        "tarikh_nikah": "27.8.94", "tarikh_keluar": "", "remarks": "diambil oleh",
    }
    df = spark.createDataFrame([(1, k, v, 0.9) for k, v in cells.items()], "rec int, cell string, text string, avg_conf double")
    row = E.assemble_records(df, ["rec"]).first()
    assert row["review_reason"] == [] and row["status_review"] == "OK"
    assert (row["bil"], row["mas_kahwin"], row["tarikh_nikah"], row["saksi_2"], row["hubungan_wali"]) == ("460/94", "RM 80.00", "27-08-1994", "KKK", "BAPA")
    assert row["alamat_pendaftar"] == "PEJABAT MASJID" and row["remarks"] == "Diambil oleh suami"


def test_guardian_forms(spark):
    rows = [("GGG HHH (SAUDARA LELAKI)", ""), ("GGG WALI HAKIN", ""), ("GGG", "saudara cecaki"), ("", "BAPA SULONG")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    got = {r["i"]: (r["guardian"], r["relation"]) for r in E.extract_guardian(df, "a", "b").collect()}
    assert got[0] == ("GGG HHH", "SAUDARA LELAKI") and got[1] == ("GGG", "WALI HAKIM") and got[3] == (None, "SAUDARA LELAKI (ABANG)")
    gestalt = {r["i"]: r["relation"] for r in E.extract_guardian(df, "a", "b", E.gestalt_snap()).collect()}
    assert gestalt[1] == "WALI HAKIM"


def test_numbered_names(spark):
    got = apply(spark, E.numbered_names, ["① AAA ② BBB", "1) AAA\n2) BBB", "AAA\nBBB\nCCC", "AAA", ""])
    assert got == [["AAA", "BBB"], ["AAA", "BBB"], ["AAA", "BBB CCC"], ["AAA"], []]


def test_vocabulary_metrics(spark):
    df = spark.createDataFrame([("BAPA KANDUNC",), ("ZZZ",)], "v string")
    for metric in ("levenshtein", "gestalt"):
        got = {r["v"]: r["snapped"] for r in N.snap_vocabulary(df, "v", metric=metric).collect()}
        assert got == {"BAPA KANDUNC": "BAPA KANDUNG", "ZZZ": None}


def test_best_line(spark):
    got = apply(spark, lambda c: N.best_line(c, "nama_suami"), ["Nama: ABU BIN ALI\n12 Kampung Baru", "Umur : 25", None])
    assert got[0] == "ABU BIN ALI" and got[2] is None
    address = apply(spark, lambda c: N.best_line(c, "alamat_pendaftar"), ["ABU\nPEJABAT AGAMA 12\nTARIKH 1.1.90"])
    assert address == ["PEJABAT AGAMA 12"]


def test_matching_blocks_within_bounds_equal_the_library(spark):
    from recordforge.functions import gestalt

    random.seed(10)
    some = ["".join(random.choice("ABCD ") for _ in range(random.randint(0, 9))) for _ in range(60)]
    rows = [(i, random.choice([*some, None]), random.choice([*some, None]), random.choice([0.0, 0.4, 0.8, None])) for i in range(800)]
    df = spark.createDataFrame(rows, "i int, a string, b string, f double")
    found = df.select("i", gestalt.ratio(F.col("a"), F.col("b")).alias("r"), gestalt.ratio_above(F.col("a"), F.col("b"), F.col("f")).alias("above")).collect()
    words = ["ABCD", "ABC", "DAB C", "BB"]
    for r, (_, a, b, f) in zip(sorted(found), rows):
        expected = None if a is None or b is None else difflib.SequenceMatcher(None, a, b).ratio()
        assert r["r"] == expected
        if expected is not None and expected > (-1.0 if f is None else f):
            assert r["above"] == expected
        else:
            assert r["above"] is None or r["above"] == expected
    for cutoff in (0.6, 0.9):
        got = df.select("a", gestalt.closest(F.col("a"), words, cutoff).alias("w")).collect()
        for r in got:
            hits = difflib.get_close_matches(r["a"], words, n=1, cutoff=cutoff) if r["a"] else []
            assert r["w"] == (r["a"] if r["a"] in words else hits[0] if hits else None)


def test_rule_tables(spark):
    from recordforge.functions.rules import Rule, RuleTable

    rules = [Rule(2, "f", "pattern", "a+", "A"), Rule(1, "f", "token", "x1", "aa"), Rule(3, "f", "pattern", "A b", "C"), Rule(5, "f", "phrase", "C d", "late"), Rule(4, "f", "phrase", "C d", "whole"), Rule(0, "g", "token", "d", "z")]
    table = spark.createDataFrame([(r.field, r.kind, r.pattern, r.value, r.place) for r in [*rules, rules[0]]], "field string, kind string, pattern string, value string, place int")
    df = spark.createDataFrame([("x1 b d",), ("x1 b",), ("d",), ("",), (None,)], "t string")
    read = RuleTable.read(table)
    assert [r[0] for r in N.apply_rules(df, read, {"t": "f"}).collect()] == ["whole", "C", "d", "", None]
    assert [r[0] for r in N.apply_rules(df, read, {"t": "none"}).collect()] == [r[0] for r in df.collect()]
    with pytest.raises(ValueError):
        RuleTable([Rule(0, "f", "other", "a", "b")])
    own = RuleTable([Rule(0, "relation", "phrase", "PAK LONG", "ABANG")])
    got = E.extract_guardian(spark.createDataFrame([("pak long", "")], "a string, b string"), "a", "b", rules=own).first()
    assert got["relation"] == "ABANG"
