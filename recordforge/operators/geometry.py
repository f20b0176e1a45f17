"""Page layout on profile, marker and box tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import text as T
from recordforge.functions.scan import ordered_scan, steps

# Fixed values of the layout rules, in pixels or as a share of the page.
RULED_LINE_MIN, RULED_LINE_SHARE = 120, 0.25
MARKER_DENSITY_MIN, MARKER_DENSITY_SHARE = 18, 0.12
MARKER_MIN_LENGTH, MARKER_MIN_WIDTH = 14, 35
START_WINDOW_MIN, START_FALLBACK = 140, 20
EDGE_SNAP_MIN, EDGE_SNAP_SHARE = 24, 0.03
EDGE_GAP_MIN, EDGE_GAP_SHARE = 18, 0.02
CELL_INSET, FIRST_CELL_INSET, CROP_PADDING = 4, 3, 12

# Rows of a page per chunk of an ordered scan, and height of the strips of range joins.
# Choices of a start for each marker, and markers of a page whose starts are chosen together.
START_CHOICES, MOST_OPTIMISED = 5, 8
CHUNK = 1024
STRIP = 256


def ruled_line_threshold(width: int) -> int:
    return max(RULED_LINE_MIN, int(width * RULED_LINE_SHARE))


def marker_threshold(width: int) -> int:
    return max(MARKER_DENSITY_MIN, int(width * MARKER_DENSITY_SHARE))


def _runs(profile: DataFrame, keys: Sequence[str], position: str, value: str, threshold: int | Column) -> DataFrame:
    """Rows at or above the threshold with the number of their island of adjacent positions."""
    limit = F.lit(threshold) if isinstance(threshold, int) else threshold
    above = profile.where(F.col(value) >= limit)
    placed = ordered_scan(above, keys, [position], [steps(position, CHUNK)], index="__ix")
    return placed.withColumn("__island", F.col(position) - F.col("__ix")).drop("__ix")


def threshold_runs(
    profile: DataFrame, keys: Sequence[str], threshold: int | Column, position: str = "y", value: str = "coverage"
) -> DataFrame:
    """Maximal runs of adjacent positions at or above the threshold, placed at their first peak."""
    peak_first = F.struct(-F.col(value), F.col(position))
    return (
        _runs(profile, keys, position, value, threshold)
        .groupBy(*keys, "__island")
        .agg(
            F.min_by(position, peak_first).alias(position),
            F.max(value).alias(value),
            F.min(position).alias("run_start"),
            F.max(position).alias("run_end"),
        )
        .drop("__island")
    )


def marker_runs(
    profile: DataFrame,
    keys: Sequence[str],
    threshold: int | Column,
    min_length: int = MARKER_MIN_LENGTH,
    min_width: int = MARKER_MIN_WIDTH,
) -> DataFrame:
    """Marker boxes: runs of dense rows, without those that are too short or too narrow.

    The profile carries the outermost marked columns of each row as ``x_min`` and ``x_max``.
    """
    boxes = (
        _runs(profile, keys, "y", "coverage", threshold)
        .groupBy(*keys, "__island")
        .agg(F.min("x_min").alias("x"), F.min("y").alias("y"), F.max("x_max").alias("__right"), F.max("y").alias("__bottom"))
        .withColumn("width", F.col("__right") - F.col("x") + 1)
        .withColumn("height", F.col("__bottom") - F.col("y") + 1)
    )
    return boxes.where((F.col("height") >= min_length) & (F.col("width") >= min_width)).select(*keys, "x", "y", "width", "height")


def merge_close(markers: DataFrame, keys: Sequence[str], gap: int) -> DataFrame:
    """Largest marker of each group of markers whose tops follow each other within ``gap``."""
    order = ["y", "x", "width", "height"]
    grouped = ordered_scan(
        markers.select(*keys, *order), keys, order, [steps("y", CHUNK)],
        lag={"__prev": F.col("y")},
        runs=("__group", F.col("__prev").isNull() | (F.col("y") - F.col("__prev") > gap)),
    )
    best = F.max(F.struct((F.col("width") * F.col("height")).alias("area"), "y", "x", "width", "height")).alias("best")
    return grouped.groupBy(*keys, "__group").agg(best).select(*keys, "best.x", "best.y", "best.width", "best.height")


def _spaced(keys: Sequence[str], index: str, value: str | Column, gap: int | Column) -> Column:
    """Closed form of ``v[i] = max(v[i], v[i-1] + gap)``: ``i*gap + max over j<=i of (v[j] - j*gap)``."""
    upto = Window.partitionBy(*keys).orderBy(index).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.col(value) if isinstance(value, str) else value
    gap = F.lit(gap) if isinstance(gap, int) else gap
    return F.max(value - F.col(index) * gap).over(upto) + F.col(index) * gap


def _numbered(markers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Markers of each page with their number and the number of all."""
    placed = ordered_scan(markers.select(*keys, "y"), keys, ["y"], [steps("y", CHUNK)], index="record_ix", size="__count")
    return placed.withColumn("record_ix", F.col("record_ix").cast("int"))


def _in_strips(lines: DataFrame, keys: Sequence[str], window: int) -> DataFrame:
    """Ruled lines dealt once by page and strip; where they have a coverage, one line with the largest for each place."""
    dealt = lines.select(*keys, F.col("y").alias("line_y"), *[c for c in lines.columns if c == "coverage"])
    dealt = dealt.withColumn("__strip", F.floor(F.col("line_y") / F.lit(window))).repartition(*keys, "__strip")
    return dealt.groupBy(*keys, "__strip", "line_y").agg(F.max("coverage").alias("coverage")) if "coverage" in dealt.columns else dealt


def _plain_starts(placed: DataFrame, ruled: DataFrame, tables: DataFrame, keys: Sequence[str], window: int, gap: int) -> DataFrame:
    strip = lambda y: F.floor(F.col(y) / F.lit(window))
    framed = placed.join(tables.select(*keys, "top"), list(keys))
    # The first marker asks for the line at the table's top, too.
    strips = F.array_distinct(F.array_compact(F.array(strip("y"), strip("y") - 1, F.when(F.col("record_ix") == 1, strip("top")))))
    probes = framed.select(*keys, "record_ix", "y", "top", F.explode(strips).alias("__strip"))
    near = (F.col("line_y") < F.col("y")) & (F.col("y") - F.col("line_y") <= window)
    line = F.struct("line_y", *[c for c in ruled.columns if c == "coverage"])
    found = (
        probes.join(ruled, [*keys, "__strip"])
        .where(near | (F.col("line_y") == F.col("top")))
        .groupBy(*keys, "record_ix")
        .agg(F.max(F.when(near, line))["line_y"].alias("line_y"), F.max(F.col("line_y") == F.col("top")).alias("__top_ruled"))
    )
    fallback = F.greatest(F.col("top"), F.col("y") - START_FALLBACK)
    first_on_rule = (F.col("record_ix") == 1) & F.col("line_y").isNull() & F.col("__top_ruled")
    start = (
        F.when(F.col("__count") == 1, fallback)
        .when(first_on_rule, F.col("top"))
        .otherwise(F.coalesce(F.col("line_y"), fallback))
    )
    found = framed.join(found, [*keys, "record_ix"], "left").withColumn("start", start)
    # Closed form of start[i] = max(start[i], start[i-1] + gap), as in _spaced.
    behind = F.col("start") - F.col("record_ix") * gap
    spaced = ordered_scan(found.select(*keys, "record_ix", "start"), keys, ["record_ix"], [steps("record_ix", CHUNK)], peak={"__peak": behind})
    return spaced.select(*keys, "record_ix", (F.col("__peak") + F.col("record_ix") * gap).alias("start"))


def record_starts(
    markers: DataFrame, lines: DataFrame, tables: DataFrame, keys: Sequence[str], min_height: int
) -> DataFrame:
    """Top of each record: the nearest ruled line above its marker, or just above the marker.

    ``tables`` has ``top`` and ``bottom`` per page.  The as-of join looks in the strip of the
    marker and in the one above it, each as high as the search window.  Markers are numbered and
    spaced in chunks of their order, so a page of any length is dealt over tasks.
    """
    window, gap = max(START_WINDOW_MIN, min_height), max(30, min_height // 2)
    ruled = _in_strips(lines.select(*keys, "y"), keys, window)
    return _plain_starts(_numbered(markers, keys), ruled, tables, keys, window, gap)


def optimised_starts(
    markers: DataFrame, lines: DataFrame, tables: DataFrame, keys: Sequence[str], min_height: int, max_height: int, most: int = MOST_OPTIMISED
) -> DataFrame:
    """``record_starts``, with the starts of pages of two to ``most`` markers chosen together.

    A marker may start at one of the ``START_CHOICES`` lowest ruled lines in the window above it, else just above itself.  Of all
    sequences of starts that lie above their markers and far enough apart the cheapest is taken, of equal ones the first in order:
    a min-plus programme from the last marker up keeps for each choice its best continuation.  Pages of up to ``most`` markers
    become one row with the lines of the strips that their markers ask for, a few numbers; those of one marker and those without a valid
    sequence get the starts of ``record_starts`` from it.  Pages with more markers go through ``record_starts``.  ``lines`` has
    ``coverage``, too, and is dealt by strip once for both.
    """
    window, gap = max(START_WINDOW_MIN, min_height), max(30, min_height // 2)
    placed, ruled = _numbered(markers, keys), _in_strips(lines, keys, window)
    above = lambda y: F.greatest(F.col("top"), y - START_FALLBACK)
    strip = lambda y: F.floor(y / F.lit(window))
    pages = placed.where(F.col("__count") <= most).repartition(*keys).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("record_ix", "y"))).alias("__m"))
    pages = pages.join(tables.select(*keys, "top", "bottom"), list(keys))
    strips = F.flatten(F.transform("__m", lambda m: F.array(strip(m["y"]), strip(m["y"]) - 1, strip(above(m["y"])))))
    wanted = pages.select(*keys, F.explode(F.array_distinct(F.concat(strips, F.array(strip(F.col("top")))))).alias("__strip"))
    near = ruled.join(wanted, [*keys, "__strip"], "left_semi").select(*keys, "line_y", "coverage").repartition(*keys)
    near = near.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("line_y", "coverage")), asc=False).alias("__lines"))
    pages = pages.join(near, list(keys), "left").withColumn("__lines", F.coalesce("__lines", F.array().cast(near.schema["__lines"].dataType)))
    choice = lambda start, coverage: F.struct(start.cast("long").alias("start"), coverage.cast("double").alias("coverage"))
    # Lines from below; a start that is no line may still lie on one.
    over = lambda y: F.slice(F.filter("__lines", lambda c: (c["line_y"] < y) & (y - c["line_y"] <= window)), 1, START_CHOICES)
    at = lambda y: F.try_element_at(F.filter("__lines", lambda c: c["line_y"] == y), F.lit(1))
    marker = lambda m: F.struct(m["record_ix"].alias("record_ix"), m["y"].alias("y"), over(m["y"]).alias("near"))
    pages = pages.withColumn("__m", F.transform("__m", marker))

    def choices(m: Column) -> Column:
        alone = choice(above(m["y"]), at(above(m["y"]))["coverage"])
        top = choice(F.col("top"), at(F.col("top"))["coverage"])
        alone = F.when(m["record_ix"] == 1, F.array_distinct(F.array(top, alone))).otherwise(F.array(alone))
        return F.array_sort(F.when(F.size(m["near"]) > 0, F.transform(m["near"], lambda c: choice(c["line_y"], c["coverage"]))).otherwise(alone))

    def first(m: Column) -> Column:
        on_rule = (m["record_ix"] == 1) & (F.size(m["near"]) == 0) & at(F.col("top")).isNotNull()
        line = F.try_element_at(m["near"], F.lit(1))["line_y"]
        return F.when(F.size("__m") == 1, above(m["y"])).when(on_rule, F.col("top")).otherwise(F.coalesce(line, above(m["y"])))

    behind = F.transform("__m", lambda m: first(m) - m["record_ix"] * gap)
    plain = T.let(behind, lambda b: F.transform("__m", lambda m, i: F.array_max(F.slice(b, F.lit(1), i + 1)) + m["record_ix"] * gap))
    programme = F.reverse(F.transform("__m", lambda m: F.struct(m["y"].alias("y"), choices(m).alias("choices"))))
    pages = pages.select(*keys, "top", "bottom", plain.alias("__plain"), F.when(F.size("__m") > 1, programme).otherwise(F.slice(programme, 1, 0)).alias("__m"))
    expected = (F.col("bottom") - F.col("top")) / F.size("__m")
    allowed = F.greatest(F.lit(max_height * 1.5), expected * 1.25)

    def cost(marker: Column, start: Column, coverage: Column, end: Column) -> Column:
        height = (end - start).cast("double")
        return (
            F.abs(marker["y"] - start - START_FALLBACK) * 2.0
            + F.abs(height - expected) * 2.0
            + F.when(height < min_height * 0.75, 250.0 + (F.lit(min_height) - height) * 4.0).otherwise(0.0)
            + F.when(height > allowed, 120.0 + (height - allowed) * 2.5).otherwise(0.0)
            + F.when(coverage.isNull(), F.lit(25.0)).otherwise(-coverage / 120.0)
        )

    way = lambda total, starts: F.struct(F.round(total, 6).alias("cost"), starts.alias("starts"))
    none = F.filter(F.array(way(F.lit(0.0), F.array(F.lit(0).cast("long")))), lambda w: F.lit(False))

    def step(after: Column, marker: Column) -> Column:
        """Best ways from each choice of a marker on, given those of the marker below; below the last there is the table's end."""

        def ways(c: Column) -> Column:
            last = F.array(way(cost(marker, c["start"], c["coverage"], F.col("bottom")), F.array(c["start"])))
            reachable = F.filter(after["ways"], lambda w: w["starts"][0] > c["start"] + gap)
            going = F.transform(reachable, lambda w: way(w["cost"] + cost(marker, c["start"], c["coverage"], w["starts"][0]), F.concat(F.array(c["start"]), w["starts"])))
            return F.array_min(F.when(after["first"], F.when(F.col("bottom") > c["start"], last)).otherwise(going))

        above_marker = F.filter(marker["choices"], lambda c: c["start"] < marker["y"])
        return F.struct(F.lit(False).alias("first"), F.array_compact(F.transform(above_marker, ways)).alias("ways"))

    begin = F.struct(F.lit(True).alias("first"), none.alias("ways"))
    found = pages.select(*keys, "__plain", F.aggregate("__m", begin, step)["ways"].alias("__ways"))
    # A page has a start at least; without "outer" a filter on it would be worked out anew below each of these steps.
    chosen = found.select(*keys, F.array_min("__ways")["starts"].alias("__starts"), F.posexplode_outer("__plain").alias("__place", "start"))
    starts = F.coalesce(F.try_element_at("__starts", F.col("__place") + 1), "start")
    small = chosen.select(*keys, (F.col("__place") + 1).alias("record_ix"), starts.alias("start"))
    large = _plain_starts(placed.where(F.col("__count") > most), ruled, tables, keys, window, gap)
    return small.unionByName(large)


def record_boxes(starts: DataFrame, tables: DataFrame, keys: Sequence[str], min_height: int) -> DataFrame:
    """Records end at the next start or at the table bottom; a page without records is one record."""
    ends = ordered_scan(starts.select(*keys, "record_ix", "start"), keys, ["record_ix"], [steps("record_ix", CHUNK)], lead={"__next": F.col("start")})
    frame = tables.select(*keys, "left", "top", "right", "bottom")
    boxes = (
        ends.join(frame, list(keys))
        .select(*keys, "left", F.col("start").alias("top"), "right", F.coalesce("__next", "bottom").alias("bottom"))
        .where(F.col("bottom") - F.col("top") >= max(30, min_height // 2))
    )
    whole = frame.join(boxes.select(*keys).distinct(), list(keys), "left_anti")
    return boxes.unionByName(whole)


def snap_edges(expected: DataFrame, detected: DataFrame, tables: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snap interior column edges to the nearest detected line, then keep a minimum gap.

    ``expected`` has ``edge_ix`` (from 0) and ``x``; the outer edges stay.  ``detected`` has ``x``.
    """
    frame = tables.select(
        *keys,
        F.greatest(F.lit(EDGE_SNAP_MIN), F.floor((F.col("right") - F.col("left")) * EDGE_SNAP_SHARE).cast("int")).alias("__tol"),
        F.greatest(F.lit(EDGE_GAP_MIN), F.floor((F.col("right") - F.col("left")) * EDGE_GAP_SHARE).cast("int")).alias("__gap"),
    )
    last = expected.groupBy(*keys).agg(F.max("edge_ix").alias("__last"))
    edges = expected.select(*keys, "edge_ix", "x").join(frame, list(keys)).join(last, list(keys))
    strip = F.floor(F.col("x") / F.col("__tol"))
    probes = edges.where((F.col("edge_ix") > 0) & (F.col("edge_ix") < F.col("__last"))).withColumn(
        "__strip", F.explode(F.array(strip - 1, strip, strip + 1))
    )
    lines = detected.select(*keys, F.col("x").alias("line_x")).distinct().join(frame.drop("__gap"), list(keys)).select(
        *keys, "line_x", F.floor(F.col("line_x") / F.col("__tol")).alias("__strip")
    )
    distance = F.abs(F.col("line_x") - F.col("x"))
    nearest = (
        probes.join(lines, [*keys, "__strip"])
        .where(distance <= F.col("__tol"))
        .groupBy(*keys, "edge_ix")
        .agg(F.min_by("line_x", F.struct(distance.alias("d"), F.col("line_x").alias("l"))).alias("line_x"))
    )
    snapped = edges.join(nearest, [*keys, "edge_ix"], "left").withColumn("x", F.coalesce("line_x", "x"))
    # A page has as many edges as the template has columns, so a window per page stays small.
    return snapped.select(*keys, "edge_ix", _spaced(keys, "edge_ix", "x", F.col("__gap")).alias("x"))


def _clamp(df: DataFrame, width: Column, height: Column) -> DataFrame:
    left = F.least(F.greatest(F.col("x1"), F.lit(0)), width - 1)
    top = F.least(F.greatest(F.col("y1"), F.lit(0)), height - 1)
    return df.withColumn("__l", left).withColumn("__t", top).withColumns(
        {
            "x2": F.least(F.greatest(F.col("x2"), F.col("__l") + 1), width),
            "y2": F.least(F.greatest(F.col("y2"), F.col("__t") + 1), height),
            "x1": F.col("__l"),
            "y1": F.col("__t"),
        }
    ).drop("__l", "__t")


def cell_grid(
    records: DataFrame,
    columns: Sequence[tuple[str, int, int]],
    keys: Sequence[str],
    page_width: str = "page_width",
    page_height: str = "page_height",
) -> DataFrame:
    """Cells of each record: every column of the template cut out of the record box.

    The columns are the literal list of the template, so no join is needed.
    """
    literals = F.array(
        *[
            F.struct(F.lit(n).alias("cell"), F.lit(l).alias("l"), F.lit(r).alias("r"), F.lit(FIRST_CELL_INSET if i == 0 else CELL_INSET).alias("pad"))
            for i, (n, l, r) in enumerate(columns)
        ]
    )
    cells = records.withColumn("__c", F.explode(literals))
    width = F.greatest(F.lit(1), F.col("__c.r") - F.col("__c.l"))
    height = F.greatest(F.lit(1), F.col("bottom") - F.col("top"))
    pad_x = F.least(F.col("__c.pad"), F.greatest(F.lit(0), F.floor((width - 1) / 2).cast("int")))
    pad_y = F.least(F.col("__c.pad"), F.greatest(F.lit(0), F.floor((height - 1) / 2).cast("int")))
    boxes = cells.select(
        *keys, F.col("__c.cell").alias("cell"),
        (F.col("__c.l") + pad_x).alias("x1"), (F.col("top") + pad_y).alias("y1"),
        F.greatest(F.col("__c.l") + pad_x + 1, F.col("__c.l") + width - pad_x).alias("x2"),
        F.greatest(F.col("top") + pad_y + 1, F.col("top") + height - pad_y).alias("y2"),
        F.col(page_width), F.col(page_height),
    )
    return _clamp(boxes, F.col(page_width), F.col(page_height)).drop(page_width, page_height)


def assign_markers(records: DataFrame, markers: DataFrame, keys: Sequence[str], record: str = "record_ix") -> DataFrame:
    """First marker whose centre lies in the record; records do not overlap, so each is used once."""
    strips = records.select(*keys, record, "top", "bottom").withColumn(
        "__strip", F.explode(F.sequence(F.floor(F.col("top") / STRIP), F.greatest(F.floor(F.col("top") / STRIP), F.floor(F.col("bottom") / STRIP))))
    )
    centres = markers.select(
        *keys, F.col("x").alias("marker_x"), F.col("y").alias("marker_y"), (F.col("y") + F.floor(F.col("height") / 2)).cast("int").alias("centre")
    ).withColumn("__strip", F.floor(F.col("centre") / STRIP))
    hits = (
        strips.join(centres, [*keys, "__strip"])
        .where((F.col("centre") >= F.col("top")) & (F.col("centre") < F.col("bottom")))
        .groupBy(*keys, record)
        .agg(F.min(F.struct("centre", "marker_y", "marker_x")).alias("m"))
        .select(*keys, record, "m.marker_x", "m.marker_y")
    )
    return records.join(hits, [*keys, record], "left")


def pad_clamp(boxes: DataFrame, padding: int = CROP_PADDING) -> DataFrame:
    """Pad cells outward, but never past the page, the own record row or the own column.

    Bounds come as ``page_width``, ``page_height``, ``row_top``, ``row_bottom``, ``col_left``, ``col_right``.
    """
    return boxes.withColumns(
        {
            "y1": F.greatest(F.lit(0), F.col("y1") - padding, F.col("row_top")),
            "y2": F.least(F.col("page_height"), F.col("y2") + padding, F.col("row_bottom")),
            "x1": F.greatest(F.lit(0), F.col("x1") - padding, F.col("col_left")),
            "x2": F.least(F.col("page_width"), F.col("x2") + padding, F.col("col_right")),
        }
    )


def layout_confidence(records: DataFrame, min_height: int, max_height: int) -> DataFrame:
    """Confidence of a record layout from ``marker_present``, ``cell_count`` and ``record_height``."""
    value = (
        F.lit(1.0)
        - F.when(~F.col("marker_present"), F.lit(0.35)).otherwise(F.lit(0.0))
        - F.when(F.col("cell_count") < 8, F.lit(0.20)).otherwise(F.lit(0.0))
        - F.when(F.col("record_height") < int(min_height * 0.75), F.lit(0.20)).otherwise(F.lit(0.0))
        - F.when(F.col("record_height") > int(max_height * 1.5), F.lit(0.20)).otherwise(F.lit(0.0))
    )
    return records.withColumn("layout_confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def pick_table_box(contours: DataFrame, pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Largest box that covers enough of its page, or else the whole page."""
    area = F.col("width") * F.col("height")
    joined = contours.join(pages.select(*keys, "page_width", "page_height"), list(keys)).where(
        (F.col("width") >= F.col("page_width") * 0.50)
        & (F.col("height") >= F.col("page_height") * 0.35)
        & (area >= F.col("page_width") * F.col("page_height") * 0.15)
    )
    order = F.struct(area.alias("area"), (-F.col("y")).alias("up"), (-F.col("x")).alias("leftmost"))
    best = joined.groupBy(*keys).agg(F.max_by(F.struct("x", "y", "width", "height"), order).alias("b"))
    return pages.join(best, list(keys), "left").select(
        *keys,
        F.coalesce("b.x", F.lit(0)).alias("x"), F.coalesce("b.y", F.lit(0)).alias("y"),
        F.coalesce("b.width", "page_width").alias("width"), F.coalesce("b.height", "page_height").alias("height"),
    )
