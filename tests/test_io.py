"""Readers, writers and restartable runs on temporary folders."""

from __future__ import annotations

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from recordforge.functions.scan import steps
from recordforge.operators import export as X
from recordforge.sources import annotations, files, records
from recordforge.streaming import incremental as S


def test_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("b.PDF", "a.jpg", "c.txt", "sub/d.png"):
        (tmp_path / name).write_text("x")
    names = lambda df: [r["path"].split("/")[-1] for r in df.collect()]
    assert names(files.list_documents(spark, str(tmp_path))) == ["a.jpg", "b.PDF", "d.png"]
    assert names(files.list_documents(spark, str(tmp_path), recursive=False)) == ["a.jpg", "b.PDF"]
    with pytest.raises(FileNotFoundError):
        files.require_documents(files.list_documents(spark, str(tmp_path), [".webp"]))


def test_append_skips_what_is_there(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 1), (None, None)], "x string, y int")
    for mode, expected in (("append", 3), ("append", 4), ("reset", 4)):
        records.write_records(df, out, mode)
        assert spark.read.parquet(out).count() == expected
    with pytest.raises(ValueError):
        records.write_records(df, out, "other")


def test_append_reads_touched_buckets_only(spark, tmp_path):
    out, schema = str(tmp_path / "out"), "x string, y int"
    rows = spark.createDataFrame([(f"r{i}", i) for i in range(200)] + [("r1", 1), (None, None)], schema)
    assert records.append_rows(rows, out, buckets=8) == records.WriteSummary(201, 1, 201)
    assert records.append_rows(rows, out, buckets=8) == records.WriteSummary(1, 201, 202)
    before = {p for p in (tmp_path / "out").glob("bucket=*/*.parquet")}
    assert records.append_rows(spark.createDataFrame([("r7", 7), ("new", 7)], schema), out, buckets=8) == records.WriteSummary(1, 1, 203)
    added = {p for p in (tmp_path / "out").glob("bucket=*/*.parquet")} - before
    assert len({p.parent for p in added}) == 1 and len({p.parent for p in before}) == 8
    plan = records._table(spark, out).where(F.col("bucket").isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    assert records.append_rows(rows.limit(0), str(tmp_path / "empty")) == records.WriteSummary(0, 0, 0)


def test_parts_have_exact_size(spark, tmp_path):
    df = spark.range(23).withColumn("v", F.col("id") * 2)
    records.write_parts(df, str(tmp_path / "parts"), 10, ["id"], [steps("id", 4)], "batch")
    sizes = {}
    for path in glob.glob(str(tmp_path / "parts" / "part=*" / "*.csv")):
        sizes[path.split("part=")[1].split("/")[0]] = [int(line.split(",")[0]) for line in open(path).read().split()[1:]]
    assert sizes == {"batch_001": list(range(10)), "batch_002": list(range(10, 20)), "batch_003": [20, 21, 22]}
    for n, prefix in ((0, "x"), (5, " ")):
        with pytest.raises(ValueError):
            records.write_parts(df, str(tmp_path / "no"), n, ["id"], [steps("id", 4)], prefix)


def test_empty_csv_keeps_its_header(spark, tmp_path):
    out = str(tmp_path / "csv")
    records.write_ordered_csv(spark.createDataFrame([], "a string, b int"), out, ["a"])
    assert [open(p).read() for p in glob.glob(out + "/*.csv")] == ["a,b\n"]
    records.write_ordered_csv(spark.range(5).select("id"), out, ["id"], chunk_rows=2)
    parts = sorted(glob.glob(out + "/*.csv"))
    assert [int(x) for p in parts for x in open(p).read().split()[1:]] == [0, 1, 2, 3, 4]


def test_csv_round_trip(spark, tmp_path):
    out = str(tmp_path / "export")
    row = spark.createDataFrame([("1/90", 25, ["a", "b"], "OK", 0.5)], "bil string, umur_suami int, review_reason array<string>, status_review string, confidence double")
    records.write_records(X.project_columns(row), out, "reset", fmt="csv")
    back = records.read_records(spark, out, "csv").first()
    assert (back["bil"], back["umur_suami"], back["review_reason"], back["status_review"], back["confidence"], back["nama_wali"]) == ("1/90", 25, ["a", "b"], "OK", 0.5, None)


def test_sidecars_and_counters(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "rec int, v string").select("rec", F.struct("v").alias("parsed"))
    records.write_sidecars(df, str(tmp_path / "side"))
    assert spark.read.json(str(tmp_path / "side")).select("parsed.v").count() == 2
    new, offered, kept, written = X.observe_export(df, df.where("rec = 1"))
    kept.write.mode("overwrite").parquet(str(tmp_path / "kept"))
    assert written.get == {"rows": 1}
    counts = X.export_counts(df, df.where("rec = 1"), df).first()
    assert tuple(counts) == (1, 1, 3)


def test_polygons_and_legacy_lines(spark):
    poly = [[[10.0, 5.0], [30.0, 6.0], [29.0, 15.0], [9.0, 14.0]]]
    df = spark.createDataFrame([(1, ["a", "b"], [0.5], poly)], "k int, rec_texts array<string>, rec_scores array<double>, rec_boxes array<array<array<double>>>")
    got = annotations.explode_parallel_arrays(df, ["k"]).orderBy("word_ix").collect()
    assert tuple(got[0])[2:] == ("a", 0.5, 9.0, 5.0, 30.0, 15.0) and tuple(got[1])[2:] == ("b", 0.0, None, None, None, None)
    old = spark.sql("select 1 as k, array(struct(array(array(1.0D, 2.0D), array(3.0D, 4.0D)) as polygon, struct('t' as text, 0.9D as score) as prediction)) as lines")
    assert tuple(annotations.explode_legacy_lines(old, ["k"]).first()) == (1, 0, "t", 0.9, 1.0, 2.0, 3.0, 4.0)
    assert annotations.explode_parallel_arrays(df.withColumn("rec_texts", F.array().cast("array<string>")), ["k"]).count() == 0


ROWS = "k int, v string, created_at string, o int"


def _upsert(spark, tmp_path, sink=None):
    out = str(tmp_path / "out")
    stream = S.newest_rows(S.incremental_files(spark, str(tmp_path / "in"), ROWS), ["k"], ["o"], "created_at")
    return S.run_available(stream, sink or S.table_sink(out, ["k"], 4), str(tmp_path / "ckpt"), mode="update")


def _land(spark, tmp_path, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def _table(spark, tmp_path):
    rows = S.read_table(spark, str(tmp_path / "out"), spark.createDataFrame([], ROWS).schema).collect()
    return sorted(((r["k"], r["v"], r["created_at"], r["o"]) for r in rows), key=str)


def test_newest_row_of_each_key_over_restarts(spark, tmp_path):
    assert _table(spark, tmp_path) == []
    _land(spark, tmp_path, [(1, "a", "t0", 1), (2, "b", "t0", 1), (None, "n", "t0", 1)])
    _upsert(spark, tmp_path)
    # A newer row, a late one, a repeated one, a new key.
    _land(spark, tmp_path, [(2, "c", "t1", 2), (1, "late", "t9", 0), (2, "b", "t0", 1), (3, "d", "t1", 2), (None, "m", "t2", 5)])
    _upsert(spark, tmp_path)
    expected = [(1, "a", "t9", 1), (2, "c", "t0", 2), (3, "d", "t1", 2), (None, "m", "t0", 5)]
    assert _table(spark, tmp_path) == sorted(expected, key=str)
    _upsert(spark, tmp_path)
    assert _table(spark, tmp_path) == sorted(expected, key=str)


def test_a_micro_batch_that_fails_after_its_write_is_repeated(spark, tmp_path):
    sink = S.table_sink(str(tmp_path / "out"), ["k"], 4)
    seen = []

    def dies(batch, number):
        seen.append(number)
        sink(batch, number)
        raise RuntimeError("lost after the write")

    _land(spark, tmp_path, [(k, f"v{k}", "t0", 1) for k in range(20)])
    _upsert(spark, tmp_path)
    _land(spark, tmp_path, [(k, f"w{k}", "t1", 2) for k in range(10, 30)])
    with pytest.raises(Exception, match="lost after the write"):
        _upsert(spark, tmp_path, dies)
    _land(spark, tmp_path, [(0, "x", "t2", 3)])
    _upsert(spark, tmp_path)
    expected = [(k, f"v{k}", "t0", 1) for k in range(1, 10)] + [(k, f"w{k}", "t0" if k < 20 else "t1", 2) for k in range(10, 30)] + [(0, "x", "t0", 3)]
    assert seen == [1] and _table(spark, tmp_path) == sorted(expected, key=str)


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    _land(spark, tmp_path, [(k, f"v{k}", "t0", 1) for k in range(40)])
    _upsert(spark, tmp_path)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "out").glob("bucket=*/*.parquet")}
    before = files()
    _land(spark, tmp_path, [(7, "new", "t1", 2)])
    _upsert(spark, tmp_path)
    after = files()
    assert len(before) >= 3 and len({p.parent for p in before if p not in after}) == 1
    assert len(_table(spark, tmp_path)) == 40


def test_status_counters_with_late_and_repeated_events(spark, tmp_path):
    from recordforge.operators import store

    random.seed(3)
    schema = "rec_key long, event_id long, ts timestamp, batch_id int, status string"
    start = dt.datetime(2024, 1, 1)
    events = [(k % 9, k, start + dt.timedelta(minutes=random.randint(0, 5000)), k % 9 % 3, random.choice(["OK", "REVIEW", "FAILED"])) for k in range(200)]
    for drop in (events[:80], events[60:150], events[140:] + events[:10]):
        spark.createDataFrame(drop, schema).coalesce(2).write.mode("append").parquet(str(tmp_path / "in"))
        stream = S.once(S.incremental_files(spark, str(tmp_path / "in"), schema), ["event_id"], "ts", "10 days")
        S.run_keyed(S.newest_rows(stream, ["rec_key"], ["ts", "event_id"]), str(tmp_path / "out"), ["rec_key"], str(tmp_path / "ckpt"))
    whole = spark.createDataFrame(events, schema)
    expected = store.status_transitions(whole, ["rec_key"], ["ts", "event_id"], ["batch_id"], [F.lit(0)])
    found = S.status_counters(S.read_table(spark, str(tmp_path / "out"), whole.schema), ["batch_id"])
    key = lambda df: sorted((r["batch_id"], r["ok_records"], r["review_records"]) for r in df.collect())
    assert key(found) == key(expected)


def test_events_beyond_the_watermark_are_dropped(spark, tmp_path):
    schema = "id long, ts timestamp"
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    got = []

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = S.once(S.incremental_files(spark, str(tmp_path / "in"), schema), ["id"], "ts", "5 days")
        S.run_available(stream, lambda batch, n: got.extend(r["id"] for r in batch.collect()), str(tmp_path / "ckpt"), mode="update")

    run([(1, day(0)), (1, day(0)), (2, day(30))])
    run([(2, day(30)), (3, day(10)), (4, day(27))])
    assert sorted(got) == [1, 2, 4]


def test_failures_are_isolated(spark):
    df = spark.createDataFrame([(1, None), (2, "boom")], "k int, e string")
    good, bad = S.isolate_failures(df, "e")
    assert [r["k"] for r in good.collect()] == [1] and [r["k"] for r in bad.collect()] == [2]
    assert S.failure_report(df.withColumn("g", F.lit(1)), ["g"], "e").first()["outcome"] == "partial"
