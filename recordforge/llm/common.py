"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there: it survives lost executors.

    The shuffle files behind it go at once; else those of all steps lie on the disks until the driver collects its garbage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with no_shuffles_left(df.sparkSession):
        # A frame takes over the settings it is made under.
        return df.select("*").checkpoint()


def no_shuffles_left(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of the frames made meanwhile go as soon as their job ends."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def small_batches(spark: SparkSession, size: str = "4m", rows: int = 2_000) -> AbstractContextManager[None]:
    """Arrow batches of at most ``size`` and ``rows`` in the jobs run meanwhile: a task holds a batch several times over."""
    return settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": size, "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


@contextmanager
def settings(spark: SparkSession, keys: dict[str, str]) -> Iterator[None]:
    """These settings meanwhile, and those from before again."""
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores appended until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted

