from __future__ import annotations

import os
import re
from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken
from recordforge.llm import bpe, lines, quality, registry
from tests.llm.tools_check import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return con


registry.load_all()


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    compare(spark, duck, name, SF)


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, SF)
    assert good.columns == docs.columns
    scores = {r["doc_id"]: r["predicted"] for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert sorted(r["doc_id"] for r in good.collect()) == sorted(d for d, p in scores.items() if p)
    wrong = sum(scores[d] != q for d, q in labels.items() if d in scores)
    assert wrong <= 0.05 * len(labels)
    cleaned = stages["line_dedup"](spark, good, SF)
    assert cleaned.columns == docs.columns and cleaned.count() == good.count()
    assert {r["n_chars"] == len(r["text"]) for r in cleaned.collect()} == {True}
    alone = stages["near_dedup"](spark, cleaned, SF)
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    kept = {r["doc_id"] for r in alone.collect()}
    shingles = {d: Counter(zip(*(t.lower().split()[k:] for k in range(5)))) for d, t in texts.items()}
    for d in kept:
        for e in kept:
            if d < e and shingles[d] and shingles[e]:
                a, b = set(shingles[d]), set(shingles[e])
                assert len(a & b) < 0.9 * len(a | b)
    for d in set(texts) - kept:
        assert any(_alike(texts[d], texts[e]) >= 0.4 for e in texts if e != d)
    clean = stages["decontamination"](spark, alone, SF)
    items = [" ".join(re.findall(r"[^\W_]+", r["text"].lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {d for d in kept if any(i in " ".join(re.findall(r"[^\W_]+", texts[d].lower())) for i in items)}
    left = {r["doc_id"] for r in clean.collect()}
    assert not left & holds and len(left) >= len(kept) - 1.2 * len(holds) - 1
    coded = stages["byte_bpe"](spark, clean, SF).collect()
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.coder(public_tokenizers.path(bpe.RANKS)).ranks, special_tokens={})
    assert {r["doc_id"]: r["ids"] for r in coded} == {d: encoding.encode_ordinary(texts[d]) for d in left}
    assert all(r["round_trip"] for r in coded)


def _alike(a, b):
    x, y = (set(zip(*(t.lower().split()[k:] for k in range(5)))) or {t} for t in (a, b))
    return len(x & y) / len(x | y)


def test_run_and_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", None, 0), (-2, None, "en", "src1", None), (-2, None, "en", "src1", None)], docs.schema)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs.unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "lang", "source", "n_chars", "ids", "n_tokens", "round_trip"} == set(out.columns)
    assert out.where("not round_trip").count() == 0 and out.count() > 50


def test_columns_of_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = "decoded ids ends n_tokens round_trip tag tag2 fp words hs flagged chars page site x statistics score predicted copies root doc h".split()
    wide = docs.limit(60).selectExpr("*", *(f"'mine' as {n}" for n in names))
    expected = docs.limit(60)
    for name, stage in corpus_pipeline.STAGES:
        wide, expected = stage(spark, wide, SF), stage(spark, expected, SF)
        if name != "byte_bpe":
            assert wide.columns == [*docs.columns, *names]
            assert {tuple(r) for r in wide.select(*names).collect()} == {("mine",) * len(names)}
        assert sorted(r["doc_id"] for r in wide.select("doc_id").collect()) == sorted(r["doc_id"] for r in expected.select("doc_id").collect())
        wide, expected = (spark.createDataFrame(d.collect(), d.schema) for d in (wide, expected))


def test_empty_documents(spark, tmp_path):
    for name in ("labels", "benchmark", "documents"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert lines.MIN_SITES > 1
