"""Work that was done several times before."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recordforge.functions import fields as X
from recordforge.functions import text as T
from recordforge.operators.normalize import snap_value


def test_bound_values_are_not_elements_of_transformed_arrays(spark):
    """Spark asks the type of such an array, and of all rules within, for every row."""
    nested = T.let(T.let(F.col("a"), F.upper), lambda v: F.concat(v, v))
    df = spark.createDataFrame([("x",), (None,)], "a string").select(nested.alias("b"))
    assert "transform" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [r["b"] for r in df.collect()] == ["XX", None]


def test_guarded_rules_change_what_the_patterns_change(spark):
    texts = ["a  b", " a\tb ", "a b c", "B1N x", "xB1N", "BINT1 8INTI B1NTI", "HJ. ALI MOHD.X", "\r\n a", "", None, "a b", "bjn.8in"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_replace(F.regexp_replace(F.upper(F.coalesce("t", F.lit(""))), "\\r", "\n"), "[ \\t]+", " ")
    for right, wrong in T.TERM_FIXES.items():
        plain = F.regexp_replace(plain, T.whole_word(wrong), right)
    plain = T.strip(F.regexp_replace(plain, f"{T.NOT_AFTER_WORD}({'|'.join(T.DOTTED_TERMS)})\\.{T.NOT_BEFORE_WORD}", "$1"))
    spaced = F.trim(F.regexp_replace("t", T.SPACE + "+", " "))
    got = df.select(T.normalise_text(F.col("t")).eqNullSafe(plain).alias("n"), T.squeeze(F.col("t")).eqNullSafe(spaced).alias("s")).collect()
    assert all(r["n"] and r["s"] for r in got)
    for table in (T.DIGIT_CONFUSION, T.ID_CONFUSION, T.NUMERIC_CONFUSION):
        assert df.where(~T.swap(F.col("t"), table).eqNullSafe(F.translate("t", *table))).isEmpty()


@pytest.mark.parametrize("cutoff", [0.0, 0.5, 0.72, 1.0])
def test_snaps_by_length_are_the_nearest(spark, cutoff):
    words = ("BAPA KANDUNG", "BAPA", "WALI", "SAUDARA LELAKI")
    texts = ["BAPA", "BAPAK", "BAP", "WALY", "SAUDARA LELAKI X", "SAUDARA", "", None, "Q", "BAPA KANDUN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    best = F.array_max(F.array(*[F.struct(T.similarity(F.col("t"), F.lit(w)).alias("r"), F.lit(w).alias("v")) for w in words]))
    near = F.when(F.col("t") == "", None).when(F.col("t").isin(*words), F.col("t")).otherwise(F.when(best["r"] >= cutoff, best["v"]))
    rows = df.select("t", snap_value(F.col("t"), words, cutoff).alias("got"), near.alias("want")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]


def test_money_line_among_letters(spark):
    rows = [("RM 80\nX1\n12O.5O\nALI",), ("R M 5O",), ("1I0",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(X.ledger_money(F.col("t")).alias("m")).collect()
    assert [(r["m"] or {"value": None})["value"] for r in got] == ["RM 120.50", None, "RM 1.10", None]


def test_refined_records_are_assembled_once(spark, sf_dir, monkeypatch):
    """Four branches of the refinement read the records; each assembled them again."""
    from recordforge.plans import ledger
    from recordforge.queries import flows

    kept = []
    monkeypatch.setattr(ledger, "stored", lambda df, store=ledger.stored: kept.append(store(df)) or kept[-1])
    out = flows.flow_ledger_refined(spark, sf_dir)
    assert len(kept) == 2 and "regexp_extract_all" not in kept[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "nama_suami" in kept[0].columns and out.columns[:2] == ["batch_id", "rec"]


def test_ruled_lines_are_dealt_once_for_both_kinds_of_pages(spark):
    from recordforge.queries.geometry import g4_optimised_starts

    plan = g4_optimised_starts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # Pages of few markers read them once, those of many in both branches of a scan, which share their exchange.
    assert plan.count(", e, [k#") == 3


def test_candidates_are_sorted_once_by_field(spark):
    from recordforge.queries.candidates import c9_decide

    decided = c9_decide(spark, "/root/testdata/sf0.001")
    decided.collect()
    plan = decided._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Sort [" not in plan[: plan.index("Window")]


def test_trees_made_by_the_plan_are_made_once(spark, sf_dir):
    """Filters by the size of a tree and of its words made both once more, before documents were spread."""
    from recordforge.queries import scans

    for query, most in ((scans.io6_explode_paragraphs, 1), (scans.io6_explode_annotations, 1)):
        plan = query(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("vertices, array(") == most and plan.count("array_join(") <= 2


def test_pages_without_blocks_or_words(spark):
    from recordforge.sources import annotations

    schema = """k int, pages array<struct<width: int, height: int, blocks: array<struct<paragraphs: array<struct<words:
     array<struct<symbols: array<struct<text: string>>, confidence: double, bounding_box: struct<vertices: array<struct<x: int, y: int>>>>>>>>>>>"""
    word = lambda *symbols, at=3: ([(s,) for s in symbols], 0.5, ([(at, None), (at + 2, 4)],))
    page = lambda *words: (1, 1, [([(list(words),)],)])
    rows = [(1, None), (2, []), (3, [None]), (4, [(1, 1, None)]), (5, [page()]), (6, [page(word(" "), word(None), (None, 0.5, None))])]
    rows += [(7, [None, page(word("a", None, "b"), word("c", at=9), (([("d",)]), None, None))])]
    df = spark.createDataFrame(rows, schema)
    got = annotations.explode_paragraphs(df, ["k"]).collect()
    assert [tuple(r) for r in got] == [(7, 1, 0, "ab c d", 1.0 / 3, 3.0, 0.0, 11.0, 4.0)]
    assert [(r["k"], r["page_ix"], r["word_ix"], r["text"]) for r in annotations.explode_annotations(df, ["k"]).collect()] == [(7, 1, 0, "ab"), (7, 1, 1, "c"), (7, 1, 2, "d")]


def test_failures_are_isolated_from_one_parse(spark, sf_dir):
    """Both sides parsed every response, and once more for the filter."""
    from recordforge.operators import reconcile as M
    from recordforge.queries.incremental import s3_isolate_failures

    assert "from_json" not in s3_isolate_failures(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    texts = ["```json\n{\"k\": 1}\n```", "  ```JSON {\"k\": 2}```  ", "{\"k\": 3}", "see ```{\"k\": 4}``` there", "\n{\"k\": 5}", "```", "", None, "{\"k\": \"x\"}", "[1]"]
    rows = M.parse_responses(spark.createDataFrame(list(enumerate(texts)), "rec int, payload string"), "payload", "k bigint", ["rec"]).orderBy("rec").collect()
    assert [r["response"] and r["response"]["k"] for r in rows] == [1, 2, 3, 4, 5, None, None, None, None, None]
    assert [r["repaired"] for r in rows] == [False, False, False, True, True, False, False, False, True, False]
    assert [r["parse_error"] for r in rows] == [None] * 5 + ["invalid JSON"] * 3 + ["type mismatch", "invalid JSON"]


def test_regions_are_plain_conditions(spark, sf_dir):
    """Every word was compared with a list of regions that does not compile."""
    from recordforge.operators import words as W
    from recordforge.queries.words import w6_words_in_regions

    assert "lambda" not in w6_words_in_regions(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    regions = [W.Region("a", 1, 0.0, 0.0, 0.5, 0.5), W.Region("b", 1, 0.4, 0.4, 0.9, 0.9), W.Region("a", 2, 0.0, 0.0, 1.0, 1.0)]
    words = [(1, 1, 0.45, 0.45), (1, 2, 0.505, 0.2), (2, 3, 0.995, 1.0), (3, 4, 0.1, 0.1), (None, 5, 0.1, 0.1), (1, 6, None, 0.1), (1, 7, float("nan"), 0.1)]
    df = spark.createDataFrame([(p, n, x, y, x, y) for p, n, x, y in words], "page_no int, word_ix int, x1 double, y1 double, x2 double, y2 double")
    got = W.words_in_regions(df, regions)
    assert got.columns == [*df.columns, "field"]
    assert sorted((r["word_ix"], r["field"]) for r in got.collect()) == [(1, "a"), (1, "b"), (2, "a"), (3, "a")]


def test_words_of_regions_are_found_once(spark, sf_dir):
    """Four branches met all words with the regions of their pages again."""
    from recordforge.plans import typed
    from recordforge.queries import flows, words

    for query in (words.w11_fields_from_regions, flows.flow_typed_results):
        assert "__regions" not in query(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert typed.stored is words.stored
