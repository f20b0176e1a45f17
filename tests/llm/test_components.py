"""Components: shuffle files of a finished step go, and rounds end as soon as there are only stars."""

from __future__ import annotations

import glob
import time

from pyspark.sql import functions as F

from recordforge.llm import components as C
from recordforge.llm.common import saved


def _shuffle_files(spark) -> int:
    return len(glob.glob(f"{spark.conf.get('spark.local.dir')}/**/shuffle_*.data", recursive=True))


def test_a_saved_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    kept = saved(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    ends = time.time() + 10
    # Executors delete them on their own time.
    while _shuffle_files(spark) > before and time.time() < ends:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before
    assert kept.agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_rounds_end_at_stars(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(C, "saved", lambda df: tables.append(1) or saved(df))
    star = spark.createDataFrame([(9, 1), (1, 8), (7, 2), (7, 2), (5, 5), (None, 3)], "a long, b long")
    assert {tuple(r) for r in C.components(star).collect()} == {(9, 1), (8, 1), (1, 1), (7, 2), (2, 2)}
    assert len(tables) == 1
    none = star.where("a = 5")
    assert C.components(none).count() == 0
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {tuple(r) for r in C.components(path).collect()} == {(i, 0) for i in range(41)}
