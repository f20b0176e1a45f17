"""Ordered scans over groups of any size.

A window such as ``row_number() over (partition by batch order by row)`` puts a whole
batch into one task.  ``ordered_scan`` splits each group into *chunks*, a coarse monotone
function of the order, so that a group is spread over many tasks:

1. rows are shuffled once by (group, chunk), and window functions run inside it;
2. one small row per (group, chunk) carries its count, last and first row, sums and maxima;
3. these rows are accumulated in chunk order and joined back on (group, chunk), which
   reuses the partitioning of step 1.

The chunk is computed from the row itself (no sampling, no partition ids), so a task that
is run again after a lost executor sees the same chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_GROUP = "__scan_group"
# Chunk numbers in a block of a global scan.
BLOCK = 4096


def steps(column: str | Column, width: float) -> Column:
    """Chunk number of a numeric order column."""
    value = F.col(column) if isinstance(column, str) else column
    return F.floor(value / F.lit(width))


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Sequence[Column],
    *,
    index: str | None = None,
    size: str | None = None,
    lag: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    total: Mapping[str, Column] | None = None,
    peak: Mapping[str, Column] | None = None,
    peak_before: Mapping[str, Column] | None = None,
    runs: tuple[str, Column] | None = None,
) -> DataFrame:
    """Add ordered columns to every row of every group.

    ``index`` 1-based position; ``size`` number of rows in the group; ``lag``/``lead``
    neighbour values; ``total``/``peak`` running sum/max up to this row; ``peak_before``
    running max of the rows before it; ``runs`` = (name, condition) numbers the runs that
    start where the condition holds, and the condition may use the other new columns.

    ``order`` must be total within a group (ascending, nulls first) and ``chunk`` must not
    decrease along it.  Pass narrow tables: all branches then read one shared exchange.
    """
    if not keys and index and not (size or lag or lead or total or peak or peak_before or runs):
        return global_index(df, order, chunk, index)
    lag, lead, total = dict(lag or {}), dict(lead or {}), dict(total or {})
    peak, peak_before = dict(peak or {}), dict(peak_before or {})
    group = F.struct(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)],
        *[c.alias(f"c{i}") for i, c in enumerate(chunk)],
    )
    work = df.withColumn(_GROUP, group)
    inputs: dict[str, Column] = {}
    for kind, columns in (("lag", lag), ("lead", lead), ("total", total), ("peak", peak), ("pb", peak_before)):
        for i, column in enumerate(columns.values()):
            inputs[f"__{kind}{i}"] = column
    if inputs:
        work = work.withColumns(inputs)
    # One exchange for the rows and for the chunk summaries.
    work = work.repartition(F.col(_GROUP))

    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    owner = [F.col(f"{_GROUP}.k{i}") for i in range(len(keys))]
    chunks = Window.partitionBy(*owner).orderBy("__first")
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(_GROUP).orderBy(*[F.col(c) for c in order])
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)

    summaries: list[Column] = []
    carried: list[Column] = []
    local: dict[str, Column] = {}
    result: dict[str, Column] = {}
    if index or size:
        summaries.append(F.count(F.lit(1)).alias("__n"))
    if index:
        carried.append(F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
        local["__rn"] = F.row_number().over(inside)
        result[index] = (F.col("__rn") + F.col("__before")).cast("long")
    if size:
        carried.append(F.sum("__n").over(Window.partitionBy(*owner)).alias("__size"))
        result[size] = F.col("__size")
    for kind, columns, pick, shift in (("lag", lag, F.max_by, F.lag), ("lead", lead, F.min_by, F.lead)):
        for i, name in enumerate(columns):
            boxed = F.struct(F.col(f"__{kind}{i}").alias("v"))
            summaries.append(pick(boxed, place).alias(f"__{kind}_s{i}"))
            carried.append(shift(f"__{kind}_s{i}").over(chunks).alias(f"__{kind}_c{i}"))
            local[f"__{kind}_l{i}"] = shift(boxed).over(inside)
            result[name] = F.coalesce(F.col(f"__{kind}_l{i}"), F.col(f"__{kind}_c{i}"))["v"]
    for i, name in enumerate(total):
        summaries.append(F.sum(f"__total{i}").alias(f"__total_s{i}"))
        carried.append(F.coalesce(F.sum(f"__total_s{i}").over(earlier), F.lit(0)).alias(f"__total_c{i}"))
        local[f"__total_l{i}"] = F.coalesce(F.sum(f"__total{i}").over(upto), F.lit(0))
        result[name] = F.col(f"__total_l{i}") + F.col(f"__total_c{i}")
    for kind, columns, frame in (("peak", peak, upto), ("pb", peak_before, before)):
        for i, name in enumerate(columns):
            summaries.append(F.max(f"__{kind}{i}").alias(f"__{kind}_s{i}"))
            carried.append(F.max(f"__{kind}_s{i}").over(earlier).alias(f"__{kind}_c{i}"))
            local[f"__{kind}_l{i}"] = F.max(f"__{kind}{i}").over(frame)
            result[name] = F.greatest(F.col(f"__{kind}_l{i}"), F.col(f"__{kind}_c{i}"))

    summary = work.groupBy(_GROUP).agg(F.min(place).alias("__first"), *summaries)
    carry = summary.select(_GROUP, *carried)
    rows = (work.withColumns(local) if local else work).join(carry, _GROUP, "left").withColumns(result)
    if runs:
        name, starts = runs
        flagged = rows.withColumn("__start", F.when(starts, 1).otherwise(0))
        counts = flagged.groupBy(_GROUP).agg(F.min(place).alias("__first"), F.sum("__start").alias("__starts"))
        offsets = counts.select(_GROUP, F.coalesce(F.sum("__starts").over(earlier), F.lit(0)).alias("__run_offset"))
        rows = (
            flagged.withColumn("__run", F.sum("__start").over(upto))
            .join(offsets, _GROUP, "left")
            .withColumn(name, F.col("__run") + F.col("__run_offset"))
        )
        result[name] = F.col(name)
    return rows.select(*df.columns, *result)


def global_index(df: DataFrame, order: Sequence[str], chunk: Sequence[Column], index: str) -> DataFrame:
    """1-based position of every row in the whole table.

    Counts of chunks are summed up in blocks of ``BLOCK`` chunk numbers, those of blocks in blocks of blocks, and only the few
    that are left are listed in one row.  So no task holds the summaries of the whole table.
    """
    group = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(chunk)])
    work = df.withColumn(_GROUP, group).repartition(F.col(_GROUP))
    place = F.row_number().over(Window.partitionBy(_GROUP).orderBy(*[F.col(c) for c in order]))
    first = F.col(f"{_GROUP}.c0")
    numeric = isinstance(work.schema[_GROUP].dataType.fields[0].dataType, T.NumericType)
    # Chunks that are no numbers are their own blocks.
    level = lambda size: F.floor(first / F.lit(float(size))) if numeric else first
    counts = work.groupBy(_GROUP).agg(F.count(F.lit(1)).alias("__n")).withColumns({"__block": level(BLOCK), "__super": level(BLOCK**2)})
    before = lambda part, by: F.coalesce(F.sum("__n").over(Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = counts.select(_GROUP, "__block", "__super", before(["__super", "__block"], _GROUP).alias("__inner"))
    blocks = counts.groupBy("__super", "__block").agg(F.sum("__n").alias("__n"))
    middle = blocks.select("__super", "__block", before(["__super"], "__block").alias("__middle"))
    supers = blocks.groupBy("__super").agg(F.sum("__n").alias("__n")).agg(F.array_sort(F.collect_list(F.struct(F.col("__super").isNotNull().alias("known"), "__super", "__n"))).alias("__list"))
    entry = lambda total, x: F.struct(x["__super"].alias("__super"), total.alias("__outer"))
    start = F.struct(F.lit(0).cast("long").alias("total"), F.filter(F.transform("__list", lambda x: entry(x["__n"], x)), lambda x: F.lit(False)).alias("out"))
    summed = F.aggregate("__list", start, lambda acc, x: F.struct((acc["total"] + x["__n"]).alias("total"), F.array_append(acc["out"], entry(acc["total"], x)).alias("out")))
    outer = supers.select(F.inline(summed["out"]))
    same = lambda a, b, *on: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in on]
    carry = inner.alias("i").join(middle.alias("m"), same("i", "m", "__super", "__block")).join(outer.alias("o"), same("i", "o", "__super"))
    carry = carry.select(F.col(f"i.{_GROUP}").alias(_GROUP), (F.col("__inner") + F.col("__middle") + F.col("__outer")).alias("__carried"))
    # The struct of chunk numbers is never null itself, so this is a plain equality.
    return work.withColumn("__place", place).join(carry, _GROUP).withColumn(index, (F.col("__place") + F.col("__carried")).cast("long")).select(*df.columns, index)


def band_segments(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    width: float,
    low: str,
    high: str,
    slack: Column | None = None,
    touch: bool = False,
    keep_slack: str | None = None,
) -> DataFrame:
    """Cut every group into segments that cannot influence each other.

    Rows are first reduced to one small row per ``position`` band of the given width, so the
    windows run over as many rows as a page has occupied bands, not over its rows.  A band
    starts a segment when its smallest ``low`` lies beyond the largest ``high`` of all bands
    before it (by more than ``slack``; with ``touch`` also when they meet).  Adds ``segment``
    and ``segment_low``/``segment_high``, the extent of the segment.  ``slack`` is an aggregate of
    the rows of a band, or a window over such aggregates; ``keep_slack`` adds it under a name.
    """
    banded = df.withColumn("__band", steps(position, width))
    extents = band_extents(banded, keys, low, high, slack, touch, keep_slack)
    return join_null_safe(banded, extents, [*keys, "__band"]).drop("__band")


def band_extents(banded: DataFrame, keys: Sequence[str], low: str, high: str, slack: Column | None = None, touch: bool = False, keep_slack: str | None = None) -> DataFrame:
    """(keys, ``__band``, segment, segment_low, segment_high) of the bands of ``band_segments``."""
    bands = banded.groupBy(*keys, "__band").agg(F.min(low).alias("__low"), F.max(high).alias("__high"), (slack if slack is not None else F.lit(0.0)).alias("__slack"))
    by_band = Window.partitionBy(*keys).orderBy("__band")
    reach = F.max("__high").over(by_band.rowsBetween(Window.unboundedPreceding, -1))
    beyond = F.col("__low") - F.col("__reach")
    apart = beyond >= F.col("__slack") if touch else beyond > F.col("__slack")
    cut = F.when(F.col("__reach").isNull() | apart, 1).otherwise(0)
    numbered = bands.withColumn("__reach", reach).withColumn("segment", F.sum(cut).over(by_band))
    whole = Window.partitionBy(*keys, "segment")
    return numbered.select(
        *keys, "__band", "segment", F.min("__low").over(whole).alias("segment_low"), F.max("__high").over(whole).alias("segment_high"),
        *([F.col("__slack").alias(keep_slack)] if keep_slack else []),
    )


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which null keys meet null keys; the key columns are those of ``left``."""
    named = right.withColumnsRenamed({c: f"__on_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"__on_{c}")) for c in on]
    return left.join(named, same, how).drop(*(f"__on_{c}" for c in on))


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], *, first: bool = False) -> DataFrame:
    """Last (or first) row per key as an aggregate.

    Partial aggregation keeps one row per key and task before the shuffle, so a key that
    holds a large part of the table costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    place = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    pick = F.min_by if first else F.max_by
    row = pick(F.struct(*[F.col(c) for c in rest]), place).alias("__row")
    picked = df.groupBy(*keys).agg(row)
    return picked.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])
