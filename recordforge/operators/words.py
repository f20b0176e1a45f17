"""Operators on word tables: duplicates, word to cell assignment, reading order, template regions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordforge.functions.pack import adjacent_runs, packed, unpacked
from recordforge.functions.phrases import strip_matches, token_runs
from recordforge.functions.scan import band_extents, band_segments, join_null_safe, steps

# Overlap of a word with a cell that assigns it, duplicate overlap, line tolerances.
CELL_OVERLAP = 0.45
DUPLICATE_IOU = 0.5
MIN_LINE_GAP_PX = 10.0
LINE_GAP_OF_HEIGHT = 0.75
LINE_TOLERANCE_UNIT = 0.008
REGION_TOLERANCE = 0.01

# Side of the tiles that split a page in spatial joins, in pixels.
TILE = 256.0
# A box that touches more tiles moves up a level, where tiles are this much larger; on the last level a page is one tile.
MOST_TILES = 64
LEVEL_FACTOR = 32.0
LAST_LEVEL = 2
# What decides the place of a word in its lines, and what the text of a line is made of.
PLACE_COLUMNS = ("word_ix", "x1", "y1", "y2")
LINE_COLUMNS = ("word_ix", "text", "confidence", "x1", "y1", "x2", "y2")


@dataclass(frozen=True)
class Region:
    """One template field region in page units (0 to 1)."""

    field: str
    page_no: int
    x1: float
    y1: float
    x2: float
    y2: float


@dataclass(frozen=True)
class Anchor:
    """Printed phrase and the place where the template expects it."""

    page_no: int
    phrase: str
    x: float
    y: float


# ---------------------------------------------------------------- geometry columns


def _overlap(a: Mapping[str, Column], b: Mapping[str, Column]) -> Column:
    width = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    height = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.when((width > 0) & (height > 0), (width * height).cast("double")).otherwise(F.lit(0.0))


def _area(a: Mapping[str, Column]) -> Column:
    return F.greatest(F.lit(1.0), ((a["x2"] - a["x1"]) * (a["y2"] - a["y1"])).cast("double"))


def _iou(a: Mapping[str, Column], b: Mapping[str, Column]) -> Column:
    shared = _overlap(a, b)
    return shared / (_area(a) + _area(b) - shared)


def _box(prefix: str = "") -> dict[str, Column]:
    return {c: F.col(prefix + c) for c in ("x1", "y1", "x2", "y2")}


def _spread(prefix: str, size: float) -> Column:
    """About how many tiles of a size a box touches."""
    side = lambda axis: F.greatest(F.lit(0.0), (F.col(f"{prefix}{axis}2") - F.col(f"{prefix}{axis}1")).cast("double") / F.lit(size)) + 1.0
    return side("x") * side("y")


def _level(prefix: str, size: float) -> Column:
    """Level of the grid at which a box touches few tiles; on the last one a page is one tile."""
    few = lambda side: _spread(prefix, side) <= F.lit(float(MOST_TILES))
    return F.when(few(size), F.lit(0)).when(few(size * LEVEL_FACTOR), F.lit(1)).otherwise(F.lit(LAST_LEVEL))


def _tiled(df: DataFrame, owner: str, other: str, prefix: str = "", size: float = TILE) -> DataFrame:
    """Rows (grid, tx, ty) of a box for a join of two sides, with the first tile of the box on both axes.

    Of two boxes the one of the higher level, at equal levels that of the side ``left``, owns the tiles in which they meet:
    a box has rows of its own at its level, and rows that look for owners of the other side at the levels above (and, on
    the right side, at its own).  So a box over a whole page is one row, and no box is many.
    """
    level = F.col(f"{prefix}level")
    lowest = level if owner == "right" else level + 1
    above = F.when(lowest <= LAST_LEVEL, F.transform(F.sequence(lowest, F.lit(LAST_LEVEL)), lambda l: F.struct(F.lit(other).alias("owner"), l.alias("level"))))
    own = F.array(F.struct(F.lit(owner).alias("owner"), level.alias("level")))
    rows = df.withColumn(f"{prefix}level", _level(prefix, size)).withColumn("grid", F.explode(F.concat(own, F.coalesce(above, F.expr("array()").cast("array<struct<owner: string, level: int>>")))))
    side = F.when(F.col("grid.level") == 0, F.lit(size)).otherwise(F.lit(size * LEVEL_FACTOR))
    tile = lambda c: F.when(F.col("grid.level") == LAST_LEVEL, F.lit(0).cast("long")).otherwise(F.floor(F.col(prefix + c) / side).cast("long"))
    return (
        rows.withColumns({f"{prefix}first_tx": tile("x1"), f"{prefix}first_ty": tile("y1")})
        .withColumn("tx", F.explode(F.sequence(F.col(f"{prefix}first_tx"), F.greatest(F.col(f"{prefix}first_tx"), tile("x2")))))
        .withColumn("ty", F.explode(F.sequence(F.col(f"{prefix}first_ty"), F.greatest(F.col(f"{prefix}first_ty"), tile("y2")))))
    )


def _meeting(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix_left: str = "", prefix_right: str = "", size: float = TILE) -> DataFrame:
    """Pairs of boxes of both sides that touch a common tile, each pair once."""
    a, b = _tiled(left, "left", "right", prefix_left, size), _tiled(right, "right", "left", prefix_right, size)
    first = (F.col("tx") == F.greatest(f"{prefix_left}first_tx", f"{prefix_right}first_tx")) & (F.col("ty") == F.greatest(f"{prefix_left}first_ty", f"{prefix_right}first_ty"))
    return a.join(b, [*keys, "grid", "tx", "ty"]).where(first)


# ---------------------------------------------------------------- duplicates


def _with_text_key(words: DataFrame) -> DataFrame:
    return words.withColumn("text_key", F.upper(F.trim("text")))


def duplicate_pairs(words: DataFrame, keys: Sequence[str] = ("doc_id", "page_no"), iou: float = DUPLICATE_IOU) -> DataFrame:
    """Pairs (earlier, later) of words with the same text whose boxes overlap by at least ``iou``.

    Exact copies (same text and box) collapse to the first of them: a later copy is paired with that one only, and
    only first copies are compared, so n words in one place give n - 1 pairs.  Boxes meet only inside shared tiles,
    and each pair is emitted in its first shared tile.
    """
    spot = [*keys, "text_key", "x1", "y1", "x2", "y2"]
    placed = _with_text_key(words).where(F.col("x1").isNotNull()).select(*spot, "word_ix")
    slim = placed.groupBy(*spot).agg(F.min("word_ix").alias("word_ix"))
    copies = placed.withColumnRenamed("word_ix", "duplicate_ix").join(slim, spot).where(F.col("duplicate_ix") > F.col("word_ix"))
    copies = copies.withColumn("iou", _iou(_box(), _box())).where(F.col("iou") >= iou).select(*keys, "text_key", "word_ix", "duplicate_ix", "iou")
    left, right = (slim.select(*keys, "text_key", *[F.col(c).alias(p + c) for c in ("word_ix", "x1", "y1", "x2", "y2")]) for p in ("a_", "b_"))
    overlap = _iou(_box("a_"), _box("b_"))
    apart = (
        _meeting(left, right, [*keys, "text_key"], "a_", "b_")
        .where((F.col("a_word_ix") < F.col("b_word_ix")) & (overlap >= iou))
        .select(*keys, "text_key", F.col("a_word_ix").alias("word_ix"), F.col("b_word_ix").alias("duplicate_ix"), overlap.alias("iou"))
    )
    return apart.unionByName(copies)


def dedupe_words(words: DataFrame, keys: Sequence[str] = ("doc_id", "page_no"), iou: float = DUPLICATE_IOU) -> DataFrame:
    """Greedy removal in word order: drop a word when a kept one has its text and overlaps it.

    1. Exact copies (same text and box), repeated rows among them, collapse to the first one by an aggregate.
    2. Words are cut into islands of touching y ranges; words of different islands cannot overlap.
    3. Islands of one word are kept as they are; the others stream in word order past the kept words around them.

    Null keys are keys like others.  A box that lacks a corner, or whose area is so far below the floor of one that it does not
    overlap itself enough, overlaps nothing: its words stay.
    """
    group = [*keys, "text_key"]
    box = ["x1", "y1", "x2", "y2"]
    solid = F.coalesce(_iou(_box(), _box()) >= iou, F.lit(False)) & ~F.greatest(*[F.col(c).isNull() for c in box])
    boxed, loose = _with_text_key(words.where(solid)), words.where(~solid)
    distinct = boxed.groupBy(*group, *box).agg(F.min("word_ix").alias("word_ix"))
    island_key = [*group, "segment"]
    islands = band_segments(distinct, group, "y1", TILE / 16, "y1", "y2", touch=True)
    sizes = islands.groupBy(*island_key).agg(F.count(F.lit(1)).alias("island_size"))
    sized = join_null_safe(islands, sizes, island_key)
    place = [*group, *box, "word_ix"]
    alone = sized.where("island_size = 1").select(*place)
    crowded = sized.where("island_size > 1").select(*island_key, "word_ix", *(F.col(c).cast("double").alias(f"__{c}") for c in box), *box)
    ordered = crowded.repartition(*island_key).sortWithinPartitions(*island_key, "word_ix")
    kept = alone.unionByName(ordered.mapInArrow(partial(_keep_first, group=len(island_key), iou=iou), crowded.schema).select(*place))
    chosen = join_null_safe(boxed, kept, place, "left_semi").dropDuplicates(place)
    return chosen.select(*words.columns).unionByName(loose)


class KeptBoxes:
    """Boxes kept so far in one island, by size and place, so that a new one is compared with those around it only.

    An overlap of at least ``iou`` bounds the ratio of two widths or heights by ``iou`` and the shift of their corners by 1 - ``iou``
    of the larger one, and kept boxes overlap each other less than that: a handful share a place.
    """

    def __init__(self, iou: float):
        if iou <= 0:
            raise ValueError("an overlap of nothing makes no duplicates")
        self.iou = iou
        self.steps = max(1, math.ceil(-math.log2(iou)))
        self.cells: dict[tuple[int, int, int, int], list[tuple[float, float, float, float, float]]] = {}

    @staticmethod
    def _level(length: float) -> int:
        return math.frexp(length)[1]

    def add(self, x1: float, y1: float, x2: float, y2: float) -> bool:
        """Keep the box unless a kept one overlaps it enough; whether it was kept."""
        width, height = x2 - x1, y2 - y1
        if not (width > 0 and height > 0 and math.isfinite(width) and math.isfinite(height)):
            # Overlaps nothing.
            return True
        area, cells = max(1.0, width * height), self.cells
        far_x, far_y = width / self.iou, height / self.iou
        at_x, at_y = self._level(width), self._level(height)
        for lx in range(at_x - self.steps, at_x + self.steps + 1):
            size_x = 2.0**lx
            columns = range(math.floor((x1 - far_x) / size_x), math.floor((x1 + far_x) / size_x) + 1)
            for ly in range(at_y - self.steps, at_y + self.steps + 1):
                size_y = 2.0**ly
                for ty in range(math.floor((y1 - far_y) / size_y), math.floor((y1 + far_y) / size_y) + 1):
                    for tx in columns:
                        for a1, b1, a2, b2, other in cells.get((lx, ly, tx, ty), ()):
                            w, h = min(a2, x2) - max(a1, x1), min(b2, y2) - max(b1, y1)
                            if w > 0 and h > 0 and w * h / (area + other - w * h) >= self.iou:
                                return False
        place = (at_x, at_y, math.floor(x1 / 2.0**at_x), math.floor(y1 / 2.0**at_y))
        cells.setdefault(place, []).append((x1, y1, x2, y2, area))
        return True


def _keep_first(batches: Iterable[pa.RecordBatch], group: int, iou: float) -> Iterator[pa.RecordBatch]:
    """Rows (island key, word_ix, x1, y1, x2, y2) in word order -> those that no kept row before them in their island overlaps."""
    island, kept = None, KeptBoxes(iou)
    for batch in batches:
        keep = []
        for key, *box in zip(zip(*(batch.column(i).to_pylist() for i in range(group)), strict=True), *(batch.column(group + 1 + i).to_pylist() for i in range(4)), strict=True):
            if key != island:
                island, kept = key, KeptBoxes(iou)
            keep.append(kept.add(*box))
        yield batch.filter(pa.array(keep, pa.bool_()))


# ---------------------------------------------------------------- words to cells


def assign_words(
    words: DataFrame,
    cells: DataFrame,
    keys: Sequence[str] = ("doc_id", "page_no"),
    cell_cols: Sequence[str] = ("record_ix", "cell"),
    skip_cells: Sequence[str] = (),
    tile: float = TILE,
) -> DataFrame:
    """Words whose centre lies in a cell, or that lie in it by at least 45 percent of their area.

    The page key is joined together with a tile of a grid of three levels, so that one huge page is spread over
    tasks and a box of any size is a few rows; a pair is emitted only in its first shared tile.
    """
    own = [c for c in words.columns if c not in keys]
    boxes = cells.select(*keys, *cell_cols, *[F.col(c).alias("c_" + c) for c in ("x1", "y1", "x2", "y2")])
    if skip_cells:
        boxes = boxes.where(~F.col("cell").isin(list(skip_cells)))
    centre_x = (F.col("x1") + F.col("x2")) / F.lit(2.0)
    centre_y = (F.col("y1") + F.col("y2")) / F.lit(2.0)
    inside = centre_x.between(F.col("c_x1"), F.col("c_x2")) & centre_y.between(F.col("c_y1"), F.col("c_y2"))
    shared = _overlap(_box(), _box("c_")) / _area(_box())
    return (
        _meeting(words.where(F.col("x1").isNotNull()), boxes, keys, "", "c_", tile)
        .where(inside | (shared >= CELL_OVERLAP))
        .select(*keys, *cell_cols, *own)
    )


# ---------------------------------------------------------------- reading order


Cut = Callable[[DataFrame], DataFrame]


def _no_cut(df: DataFrame) -> DataFrame:
    return df


def group_lines_px(words: DataFrame, keys: Sequence[str], cut: Cut = _no_cut) -> DataFrame:
    """Reading order in pixel units: adds ``segment`` and ``part``; the pair numbers the line.

    ``cut`` may materialise the words (for example ``lambda d: d.checkpoint()``), which are read twice: for the
    bands of their pages, which carry the mean heights, too, and for the lines.

    Words run by (y1, x1); a word joins the last line while its centre is within
    max(10, 0.75 mean height) of the mean centre of that line.
    """
    return _group_lines(cut(words), keys, *_px_rules(keys))


def _px_rules(keys: Sequence[str]) -> tuple:
    corner = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    derived = {"__y1": corner("y1"), "__x1": corner("x1"), "__cy": (corner("y1") + corner("y2")) / F.lit(2.0)}
    height = F.greatest(F.lit(1.0), corner("y2") - corner("y1"))
    # The mean height of a page from its bands: no scan of its own.
    whole = Window.partitionBy(*keys)
    mean = F.sum(F.sum(height)).over(whole) / F.sum(F.count(height)).over(whole)
    tolerance = F.greatest(F.lit(MIN_LINE_GAP_PX), mean * F.lit(LINE_GAP_OF_HEIGHT))
    return derived, ["__y1", "__x1", "word_ix"], MIN_LINE_GAP_PX / 8, tolerance


def text_lines_px(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``line_table`` of the lines of ``group_lines_px``; flat segments stay packed on the way."""
    return _text_lines(words, keys, *_px_rules(keys))


def group_lines_unit(words: DataFrame, keys: Sequence[str], tolerance: float = LINE_TOLERANCE_UNIT, cut: Cut = _no_cut) -> DataFrame:
    """Reading order in page units: words run by (centre y, x1) with a fixed tolerance."""
    return _group_lines(cut(words), keys, *_unit_rules(tolerance))


def _unit_rules(tolerance: float) -> tuple:
    derived = {"__x1": F.col("x1"), "__cy": (F.col("y1") + F.col("y2")) / F.lit(2.0)}
    return derived, ["__cy", "__x1", "word_ix"], tolerance / 8, F.lit(float(tolerance))


def text_lines_unit(words: DataFrame, keys: Sequence[str], tolerance: float = LINE_TOLERANCE_UNIT) -> DataFrame:
    """``line_table`` of the lines of ``group_lines_unit``."""
    return _text_lines(words, keys, *_unit_rules(tolerance))


def _banded(words: DataFrame, keys: Sequence[str], derived: Mapping[str, Column], position: str, band: float, tolerance: Column) -> DataFrame:
    """Packed words of a band with the segment of the band, ``__tol`` and ``__tall``, whether it is taller than that.

    The words of a band travel once, packed; their bands are read apart, as a few numbers each.
    """
    banded = words.withColumns(dict(derived)).withColumn("__band", steps(position, band))
    extents = band_extents(banded, keys, "__cy", "__cy", tolerance, keep_slack="__tol")
    is_tall = F.col("segment_high") - F.col("segment_low") > F.col("__tol")
    extents = extents.select(*keys, "__band", "segment", "__tol", F.coalesce(is_tall, F.lit(False)).alias("__tall"))
    # Words of a line lie in turn in several bands where they are shaken.
    runs = packed(banded.select("__band", *words.columns), [*keys, "__band"], gather=True)
    return join_null_safe(runs, extents, [*keys, "__band"])


def _flat(runs: DataFrame, own: Sequence[str]) -> DataFrame:
    """Packed words of flat segments.

    The condition, of which the first part decides, names all packed columns: so both sides read the same exchange, and words are dealt once.
    """
    return runs.where(~F.col("__tall") | (sum((F.size(c) for c in own), F.lit(0)) < 0))


def _grouped(
    words: DataFrame, keys: Sequence[str], derived: Mapping[str, Column], order: Sequence[str], band: float, tolerance: Column, carry: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Exact fold without folding whole cells: packed words of flat segments, and words of tall ones, with segment and part.

    With ``carry`` words of tall segments are packed by line, too, and both sides have these columns only.

    Words whose centres lie more than the tolerance below every centre before them start a
    line whatever the last line is, so the cell falls into independent segments.  A segment
    no taller than the tolerance is one line and is not looked at.  Taller segments stream in order past a fold that holds one line.
    """
    own = [c for c in words.columns if c not in keys]
    runs = _banded(words, keys, derived, order[0], band, tolerance)
    flat = _flat(runs, own).select(*keys, "segment", F.lit(0).alias("part"), *own)
    segment_key = [*keys, "segment"]
    # Dealt as they are packed; rows are made where they are sorted.
    rows = runs.where("__tall").repartition(*segment_key).select(*segment_key, "__tol", unpacked(own)).withColumns(dict(derived))
    ordered = rows.sortWithinPartitions(*segment_key, *order)
    kept = own if carry is None else list(carry)
    at = rows.columns.index
    fold = partial(_fold_lines, keys=[at(c) for c in segment_key], centre=at("__cy"), tolerance=at("__tol"))
    part = T.StructField("part", T.IntegerType())
    if carry is None:
        out = [*words.columns, "segment"]
        return flat, ordered.mapInArrow(partial(fold, out=[at(c) for c in out]), T.StructType([*(rows.schema[c] for c in out), part]))
    schema = T.StructType([*(rows.schema[c] for c in segment_key), part, *(T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in kept)])
    folded = ordered.mapInArrow(partial(_fold_runs, fold=partial(fold, out=[at(c) for c in (*segment_key, *kept)]), names=schema.names, keys=len(segment_key) + 1), schema)
    return flat.select(*folded.columns), folded


def _group_lines(words: DataFrame, keys: Sequence[str], *rules) -> DataFrame:
    flat, folded = _grouped(words, keys, *rules)
    own = [c for c in words.columns if c not in keys]
    return flat.select(*keys, "segment", "part", unpacked(own)).select(*folded.columns).unionByName(folded)


def _line_runs(words: DataFrame, keys: Sequence[str], carry: Sequence[str], *rules) -> DataFrame:
    needed = dict.fromkeys([*PLACE_COLUMNS, *carry])
    flat, folded = _grouped(words.select(*keys, *needed), keys, *rules, carry=carry)
    return flat.unionByName(folded)


def _text_lines(words: DataFrame, keys: Sequence[str], *rules) -> DataFrame:
    return _lines_of(_line_runs(words, keys, LINE_COLUMNS, *rules), [*keys, "segment", "part"])


def _fold_lines(batches: Iterable[pa.RecordBatch], keys: list[int], centre: int, tolerance: int, out: list[int]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the number of their line in the segment."""
    segment, line, total, count = None, 0, 0.0, 0
    for batch in batches:
        parts = np.zeros(batch.num_rows, dtype=np.int32)
        columns = [batch.column(k).to_pylist() for k in (centre, tolerance, *keys)]
        for row, (y, most, *key) in enumerate(zip(*columns, strict=True)):
            if key != segment:
                segment, line, total, count = key, 0, 0.0, 0
            if count and abs(y - total / count) > most:
                line, total, count = line + 1, 0.0, 0
            total, count = total + y, count + 1
            parts[row] = line
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in out), pa.array(parts)], names=[*(batch.schema.names[k] for k in out), "part"])


def _fold_runs(batches: Iterable[pa.RecordBatch], fold: Callable, names: list[str], keys: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows as packed rows of their lines; ``fold`` puts the number of the line last."""
    for batch in adjacent_runs((b.select([*b.schema.names[: keys - 1], "part", *b.schema.names[keys - 1 : -1]]) for b in fold(batches)), keys):
        yield batch.rename_columns(names)


def line_runs_px(words: DataFrame, keys: Sequence[str], carry: Sequence[str] = ("word_ix",)) -> DataFrame:
    """Lines of ``group_lines_px`` as packed rows (keys, segment, part, an array of each column of ``carry``), of which a line has one or several.

    Columns that are not carried don't travel.
    """
    return _line_runs(words, keys, carry, *_px_rules(keys))


def line_runs_unit(words: DataFrame, keys: Sequence[str], tolerance: float = LINE_TOLERANCE_UNIT, carry: Sequence[str] = ("word_ix",)) -> DataFrame:
    """Lines of ``group_lines_unit`` as ``line_runs_px`` has them."""
    return _line_runs(words, keys, carry, *_unit_rules(tolerance))


def line_runs_gap(words: DataFrame, keys: Sequence[str], tolerance: float, carry: Sequence[str] = ("word_ix",)) -> DataFrame:
    """Lines of ``group_lines_gap`` as ``line_runs_px`` has them."""
    flat, tall = _gap_lines(words.select(*keys, *dict.fromkeys([*PLACE_COLUMNS, *carry])), keys, tolerance)
    owner = [*keys, "segment", "part"]
    return flat.select(*keys, "segment", F.lit(0).alias("part"), *carry).unionByName(packed(tall.select(*owner, *carry), owner))


def group_lines_gap(words: DataFrame, keys: Sequence[str], tolerance: float) -> DataFrame:
    """Set-based lines: a new line starts where the centre moves by more than ``tolerance``.

    Adds ``segment`` and ``part``; windows run only inside segments taller than the tolerance.
    """
    flat, tall = _gap_lines(words, keys, tolerance)
    out = [*words.columns, "segment"]
    own = [c for c in words.columns if c not in keys]
    return flat.select(*keys, "segment", unpacked(own)).select(*out, F.lit(0).alias("part")).unionByName(tall.select(*out, "part"))


def _gap_lines(words: DataFrame, keys: Sequence[str], tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Packed words of flat segments, and words of tall ones with their part, in the order of their lines."""
    derived = {"__cy": (F.col("y1") + F.col("y2")) / F.lit(2.0)}
    own = [c for c in words.columns if c not in keys]
    runs = _banded(words, keys, derived, "y1", tolerance / 8, F.lit(float(tolerance)))
    tall = runs.where("__tall").repartition(*keys, "segment").select(*keys, "segment", "__tol", unpacked(own)).withColumns(derived)
    by_place = Window.partitionBy(*keys, "segment").orderBy("y1", "x1", "word_ix")
    moved = F.when(F.abs(F.col("__cy") - F.lag("__cy").over(by_place)) > F.col("__tol"), 1).otherwise(0)
    tall = tall.withColumn("__moved", moved).withColumn("part", F.sum("__moved").over(by_place).cast("int"))
    return _flat(runs, own), tall


def line_table(words: DataFrame, keys: Sequence[str], line: Sequence[str] = ("segment", "part")) -> DataFrame:
    """One row per line: text, mean confidence and envelope; lines without text are dropped."""
    owner = [*keys, *line]
    return _lines_of(packed(words.select(*owner, *LINE_COLUMNS), owner), owner)


def _lines_of(runs: DataFrame, owner: Sequence[str]) -> DataFrame:
    """``line_table`` from packed words."""
    edge = lambda f, pick, a, b: f(pick(a), pick(b))
    runs = runs.select(
        *owner, F.col("x1").alias("__x"), F.col("y1").alias("__y"), F.col("word_ix").alias("__ix"), F.col("text").alias("__text"),
        F.when(F.size(F.array_compact("confidence")) > 0, F.aggregate(F.array_compact("confidence"), F.lit(0.0), lambda a, c: a + c.cast("double"))).alias("__sum"),
        F.size(F.array_compact("confidence")).cast("long").alias("__n"),
        edge(F.least, F.array_min, "x1", "x2").alias("x1"), edge(F.least, F.array_min, "y1", "y2").alias("y1"),
        edge(F.greatest, F.array_max, "x1", "x2").alias("x2"), edge(F.greatest, F.array_max, "y1", "y2").alias("y2"),
    )
    # Lines are dealt first, so that nothing is sorted or collected where the words lie, and over all partitions: packed rows grow when they are collected.
    runs = _dealt(runs, owner)
    words_of = F.filter(F.flatten(F.collect_list(F.arrays_zip(*(F.col(f"__{a}").alias(n) for a, n in (("x", "x1"), ("y", "y1"), ("ix", "word_ix"), ("text", "text")))))), lambda w: F.length(F.trim(w["text"])) > 0)
    return (
        runs.groupBy(*owner)
        .agg(
            F.array_sort(words_of).alias("__words"),
            F.sum("__sum").alias("confidence_sum"),
            F.sum("__n").alias("word_count"),
            F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"),
        )
        .withColumn("text", F.trim(F.array_join(F.col("__words")["text"], " ")))
        .where(F.col("text") != "")
        .select(*owner, (F.col("confidence_sum") / F.nullif(F.col("word_count"), F.lit(0))).alias("confidence"), "confidence_sum", "word_count", "x1", "y1", "x2", "y2", "text")
    )


def cell_text(words: DataFrame, keys: Sequence[str], line: Sequence[str] = ("segment", "part")) -> DataFrame:
    """Text of each cell; its confidence is the mean of the line means."""
    return text_of_lines(line_table(words, keys, line), keys, line)


def _dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def text_of_lines(lines: DataFrame, keys: Sequence[str], line: Sequence[str] = ("segment", "part")) -> DataFrame:
    """``cell_text`` from the line table."""
    parts = F.array_sort(F.collect_list(F.struct(*line, "text", "confidence", F.array("x1", "y1", "x2", "y2").alias("bbox"))))
    return (
        _dealt(lines, keys)
        .groupBy(*keys)
        .agg(parts.alias("__lines"), F.avg("confidence").alias("avg_conf"))
        .select(
            *keys,
            F.array_join(F.col("__lines.text"), "\n").alias("text"),
            "avg_conf",
            F.transform("__lines", lambda l: F.struct(l["text"].alias("text"), l["confidence"].alias("confidence"), l["bbox"].alias("bbox"))).alias("lines"),
        )
    )


# ---------------------------------------------------------------- template regions


def words_in_regions(words: DataFrame, regions: Sequence[Region], tolerance: float = REGION_TOLERANCE) -> DataFrame:
    """Words whose centre lies in an expanded template region: one pass over the words, no join.

    The tests are plain conditions, which compile; the size of the plan is the size of the template.
    """
    centre_x = (F.col("x1") + F.col("x2")) / F.lit(2.0)
    centre_y = (F.col("y1") + F.col("y2")) / F.lit(2.0)

    def hit(region: Region) -> Column:
        return (
            (F.col("page_no") == region.page_no)
            & F.col("__cx").between(max(0.0, region.x1 - tolerance), min(1.0, region.x2 + tolerance))
            & F.col("__cy").between(max(0.0, region.y1 - tolerance), min(1.0, region.y2 + tolerance))
        )

    fields = F.array(*[F.when(hit(r), F.lit(r.field)) for r in regions]).cast("array<string>")
    placed = words.withColumns({"__cx": centre_x, "__cy": centre_y})
    return placed.withColumn("field", F.explode(fields)).where(F.col("field").isNotNull()).drop("__cx", "__cy")


def match_phrases(
    words: DataFrame, anchors: Sequence[Anchor], keys: Sequence[str] = ("doc_id", "page_no"), chunk: float = 1 / 64
) -> DataFrame:
    """First occurrence of each anchor phrase in the token stream of its page.

    ``chunk`` is the height of the strips that a page's tokens are put in order in: the default suits page units, pixels
    want some hundreds.

    Words of a strip travel packed; a task finds the phrases within a strip and counts its tokens.  A phrase over several
    strips is made of their first and last tokens: one that equals the k-th token of a phrase votes for the start
    ``position - k``, and a start with all votes is a match.  So only a few rows of a strip meet those of the others.
    """
    phrases = [[t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in a.phrase.upper()).split() if t] for a in anchors]
    codes = {token: code for code, token in enumerate(dict.fromkeys(t for tokens in phrases for t in tokens))}
    vote = lambda code, number, k, n: F.struct(
        F.lit(code).alias("code"), F.lit(number).alias("anchor_ix"), F.lit(anchors[number].page_no).alias("on_page"), F.lit(k).alias("k"), F.lit(n).alias("n")
    )
    whole = [vote(-1 - number, number, 0, 1) for number, tokens in enumerate(phrases) if tokens]
    parts = [vote(codes[t], number, k, len(tokens)) for number, tokens in enumerate(phrases) if len(tokens) > 1 for k, t in enumerate(tokens)]
    strip = [*keys, "__strip"]
    rows = words.where(F.col("page_no").isin(sorted({a.page_no for a in anchors})))
    rows = rows.select(*keys, steps("y1", chunk).alias("__strip"), "y1", "x1", "word_ix", F.upper("text").alias("__text"))
    numbers, lists = T.ArrayType(T.IntegerType()), [T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in ("y1", "x1", "word_ix")]
    schema = T.StructType([*(rows.schema[c] for c in strip), *lists, *(T.StructField(c, numbers) for c in ("tokens", "word", "place", "code"))])
    runs = rows.mapInArrow(partial(token_runs, keys=len(strip), codes=list(codes), names=schema.names), schema)
    schema = T.StructType([
        *(rows.schema[c] for c in strip), T.StructField("total", T.LongType()), T.StructField("code", numbers),
        T.StructField("at", T.ArrayType(T.LongType())), lists[1], lists[0],
    ])
    coded = [(number, [codes[t] for t in tokens]) for number, tokens in enumerate(phrases) if tokens]
    met = runs.repartition(*strip).sortWithinPartitions(*strip)
    strips = met.mapInArrow(partial(strip_matches, keys=len(strip), phrases=coded, names=schema.names), schema)
    earlier = Window.partitionBy(*keys).orderBy("__strip").rowsBetween(Window.unboundedPreceding, -1)
    stream = strips.withColumn("before", F.coalesce(F.sum("total").over(earlier), F.lit(0))).select(*keys, "before", unpacked(["code", "at", "x1", "y1"]))
    voted = stream.withColumn("vote", F.explode(F.filter(F.array(*whole, *parts), lambda v: v["code"] == F.col("code")))).where(
        F.col("vote.on_page") == F.col("page_no")
    )
    starts = voted.groupBy(
        *keys, F.col("vote.anchor_ix").alias("anchor_ix"), F.col("vote.n").alias("n"), (F.col("before") + F.col("at") - F.col("vote.k")).alias("start")
    ).agg(
        F.count(F.lit(1)).alias("votes"),
        F.max(F.when(F.col("vote.k") == 0, F.struct("x1", "y1"))).alias("place"),
    )
    printed = F.get(F.array(*[F.struct(F.lit(a.phrase).alias("phrase"), F.lit(a.x).alias("x"), F.lit(a.y).alias("y")) for a in anchors]), F.col("anchor_ix"))
    return (
        starts.where(F.col("votes") == F.col("n"))
        .groupBy(*keys, "anchor_ix")
        .agg(F.min_by("place", "start").alias("place"))
        .select(
            *keys, "anchor_ix", printed["phrase"].alias("phrase"), printed["x"].alias("expected_x"), printed["y"].alias("expected_y"),
            F.col("place.x1").alias("observed_x"), F.col("place.y1").alias("observed_y"),
        )
    )


def _median(values: Column) -> Column:
    ordered = F.array_sort(values)
    n = F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / F.lit(2.0)


def estimate_transform(pages: DataFrame, matches: DataFrame, keys: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """Shift and scale of each page from its anchors.

    ``pages`` has the keys and ``n_words``.  The list per page is bounded by the number of
    anchors of the template.
    """
    found = matches.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("anchor_ix", "expected_x", "expected_y", "observed_x", "observed_y"))).alias("found")
    )

    def ratios(found: Column) -> Column:
        pairs = F.transform(
            found,
            lambda a: F.transform(
                F.filter(found, lambda b: (b["anchor_ix"] > a["anchor_ix"]) & (b["expected_y"] != a["expected_y"])),
                lambda b: F.abs(b["observed_y"] - a["observed_y"]) / F.abs(b["expected_y"] - a["expected_y"]),
            ),
        )
        return F.flatten(pairs)

    joined = pages.join(found, list(keys), "left")
    measured = joined.withColumns(
        {
            "__dx": _median(F.transform("found", lambda a: a["observed_x"] - a["expected_x"])),
            "__dy": _median(F.transform("found", lambda a: a["observed_y"] - a["expected_y"])),
            "__ratio": _median(ratios(F.col("found"))),
        }
    )
    clamped = (F.col("__ratio") < 0.98) | (F.col("__ratio") > 1.02)
    sy = F.when(F.col("__ratio").isNull() | clamped, F.lit(1.0)).otherwise(F.col("__ratio"))
    located = F.col("found").isNotNull() & (F.size("found") > 0)
    safe = located & (F.abs("__dx") <= 0.05) & (F.abs("__dy") <= 0.05) & sy.between(0.95, 1.05)
    four = lambda c: F.format_string("%.4f", F.floor(c * 10000 + 0.5) / F.lit(10000.0))
    diagnostics = F.array_compact(
        F.array(
            F.when(F.coalesce(F.col("n_words"), F.lit(0)) == 0, F.lit("no words for page"))
            .when(~located, F.lit("no anchor matches found")),
            F.when(located & clamped, F.concat(F.lit("scale_y clamped from "), four(F.col("__ratio")))),
            F.when(located & ~safe, F.concat(F.lit("unsafe transform dx="), four(F.col("__dx")), F.lit(" dy="), four(F.col("__dy")), F.lit(" scale_x=1.0000 scale_y="), four(sy))),
        )
    )
    return measured.select(
        *keys,
        F.coalesce("__dx", F.lit(0.0)).alias("dx"),
        F.coalesce("__dy", F.lit(0.0)).alias("dy"),
        F.lit(1.0).alias("sx"),
        sy.alias("sy"),
        F.coalesce(safe, F.lit(False)).alias("safe"),
        diagnostics.alias("diagnostics"),
    )


def apply_transform(transforms: DataFrame, regions: Sequence[Region], keys: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """Template regions moved by the transform of each page; unsafe transforms keep only the shift."""
    sx = F.when(F.col("safe"), F.col("sx")).otherwise(F.lit(1.0))
    sy = F.when(F.col("safe"), F.col("sy")).otherwise(F.lit(1.0))
    on_page = F.filter(_region_literals_raw(regions), lambda r: r["page_no"] == F.col("page_no"))
    return transforms.withColumn("r", F.explode(on_page)).select(
        *keys,
        F.col("r.field").alias("field"),
        (F.col("r.x1") * sx + F.col("dx")).alias("x1"),
        (F.col("r.y1") * sy + F.col("dy")).alias("y1"),
        (F.col("r.x2") * sx + F.col("dx")).alias("x2"),
        (F.col("r.y2") * sy + F.col("dy")).alias("y2"),
    )


def _region_literals_raw(regions: Sequence[Region]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(r.field).alias("field"), F.lit(r.page_no).alias("page_no"),
                F.lit(r.x1).alias("x1"), F.lit(r.y1).alias("y1"), F.lit(r.x2).alias("x2"), F.lit(r.y2).alias("y2"),
            )
            for r in regions
        ]
    )


def normalise_boxes(words: DataFrame, pages: DataFrame, keys: Sequence[str] = ("doc_id", "page_no")) -> DataFrame:
    """Pixel boxes to page units; a missing page size falls back to the farthest word, then to one."""
    extent = words.groupBy(*keys).agg(F.max("x2").alias("__mx"), F.max("y2").alias("__my"))
    size = extent.join(pages.select(*keys, "width", "height"), list(keys), "left").select(
        *keys,
        F.coalesce(F.nullif(F.col("width"), F.lit(0)), F.nullif(F.col("__mx"), F.lit(0)), F.lit(1)).cast("double").alias("__w"),
        F.coalesce(F.nullif(F.col("height"), F.lit(0)), F.nullif(F.col("__my"), F.lit(0)), F.lit(1)).cast("double").alias("__h"),
    )
    return (
        words.join(size, list(keys))
        .withColumns({c: F.col(c) / F.col("__w" if c[0] == "x" else "__h") for c in ("x1", "y1", "x2", "y2")})
        .drop("__w", "__h")
    )


def fields_from_regions(
    words: DataFrame,
    transforms: DataFrame,
    regions: Sequence[Region],
    keys: Sequence[str] = ("doc_id", "page_no"),
    tolerance: float = REGION_TOLERANCE,
    cut: Cut = _no_cut,
) -> DataFrame:
    """One row per page and template field with its text, also where no word was found.

    The mean confidence of all words of a field is put together from its lines.
    """
    placed = apply_transform(transforms, regions, keys)
    grown = placed.select(
        *keys, "field",
        F.greatest(F.lit(0.0), F.col("x1") - tolerance).alias("r_x1"), F.greatest(F.lit(0.0), F.col("y1") - tolerance).alias("r_y1"),
        F.least(F.lit(1.0), F.col("x2") + tolerance).alias("r_x2"), F.least(F.lit(1.0), F.col("y2") + tolerance).alias("r_y2"),
    )
    centre_x = (F.col("x1") + F.col("x2")) / F.lit(2.0)
    centre_y = (F.col("y1") + F.col("y2")) / F.lit(2.0)
    # One row per page with its regions, as many as the template has: a word meets them in its own row.
    regions_of = grown.groupBy(*keys).agg(F.collect_list(F.struct("field", "r_x1", "r_y1", "r_x2", "r_y2")).alias("__regions"))
    inside = lambda r: centre_x.between(r["r_x1"], r["r_x2"]) & centre_y.between(r["r_y1"], r["r_y2"])
    # Words of a page meet its regions packed.
    met = packed(words.select(*keys, *LINE_COLUMNS), keys).join(regions_of, list(keys)).select(*keys, "__regions", unpacked(LINE_COLUMNS))
    hits = met.withColumn("field", F.explode(F.transform(F.filter("__regions", inside), lambda r: r["field"])))
    owner = [*keys, "field"]
    lines = text_lines_unit(cut(hits.select(*owner, *LINE_COLUMNS)), owner)
    parts = F.array_sort(F.collect_list(F.struct("segment", "part", "text")))
    mean = F.sum("confidence_sum") / F.sum("word_count")
    fields = lines.groupBy(*owner).agg(F.array_join(parts["text"], "\n").alias("raw_text"), mean.alias("confidence"))
    return placed.join(fields, owner, "left").na.fill({"raw_text": "", "confidence": 0.0})


# ---------------------------------------------------------------- cells and pages

# Cells that may be read again from their own crop.
FALLBACK_CELLS = ("bil", "suami_isteri", "pendaftar", "wali", "hubungan_wali", "saksi", "tarikh_nikah", "tarikh_keluar")
DATE_CELLS = ("tarikh_nikah", "tarikh_keluar")
SERIAL_CELLS = ("bil",)


def choose_cell_source(
    primary: DataFrame,
    fallback: DataFrame,
    keys: Sequence[str] = ("doc_id", "record_ix", "cell"),
    important: Sequence[str] = FALLBACK_CELLS,
    date_cells: Sequence[str] = DATE_CELLS,
    serial_cells: Sequence[str] = SERIAL_CELLS,
) -> DataFrame:
    """Take the second reading of a cell where the first one is weak and the second is better."""
    second = fallback.select(*keys, F.col("text").alias("f_text"), F.col("avg_conf").alias("f_conf"))
    joined = primary.join(second, list(keys), "left")
    text = F.trim(F.coalesce("text", F.lit("")))
    other = F.trim(F.coalesce("f_text", F.lit("")))
    needed = F.col("cell").isin(list(important)) & (
        (text == "")
        | (F.col("avg_conf") < 0.60)
        | (F.col("cell").isin(list(date_cells)) & (F.length(text) < 4))
        | (F.col("cell").isin(list(serial_cells)) & (F.length(text) < 2))
    )
    better = (
        ((other != "") & (text == ""))
        | (F.col("f_conf") >= F.col("avg_conf") + F.lit(0.10))
        | ((F.length(other) > F.length(text) * F.lit(1.5)) & (F.col("f_conf") >= 0.50))
    )
    take = F.coalesce(needed & F.col("f_conf").isNotNull() & better, F.lit(False))
    return joined.select(
        *keys,
        F.when(take, F.col("f_text")).otherwise(F.col("text")).alias("text"),
        F.when(take, F.col("f_conf")).otherwise(F.col("avg_conf")).alias("avg_conf"),
        F.when(take, F.lit("fallback")).otherwise(F.lit("primary")).alias("cell_source"),
    )


def page_completeness(pages: DataFrame, doc: str = "doc_id", expected: int = 2) -> DataFrame:
    """Per document: page count, pages with a result, joined page errors and an overall error.

    ``pages`` has ``page_no``, ``has_ocr`` and ``error``.
    """
    errors = F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.struct("page_no", "error"))))
    grouped = pages.groupBy(doc).agg(
        F.count(F.lit(1)).alias("page_count"),
        F.count_if(F.col("has_ocr")).alias("ocr_pages"),
        F.array_join(errors["error"], "; ").alias("page_errors"),
    )
    problem = (
        F.when(F.col("page_count") != expected, F.format_string("expected exactly %d pages, found %d", F.lit(expected), F.col("page_count")))
        .when(F.col("page_errors") != "", F.col("page_errors"))
        .when(F.col("ocr_pages") < F.col("page_count"), F.lit("missing OCR result"))
    )
    return grouped.withColumn("document_error", problem)
