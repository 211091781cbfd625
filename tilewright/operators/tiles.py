"""Tile grids: lattices over boxes, order, caps, coarser grids, and counts of raster classes under tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def half_even(x: Column) -> Column:
    """Rounds to the nearest whole number, halves to even."""
    return F.rint(x).cast("long")


def native_size(size: Column, mpp: Column, slide_mpp: Column) -> Column:
    """Level-0 pixels of a tile of ``size`` at ``mpp``; an error where a tile would be enlarged by over 0.01 units."""
    return F.when(mpp >= slide_mpp - 0.01, half_even(size * mpp / slide_mpp)).otherwise(F.raise_error("a tile can't be finer than its slide").cast("long"))


def axis_origins(lo: Column, hi: Column, size: int, step: int, limit: Column | None = None) -> Column:
    """Origins on a lattice of ``step`` whose tiles meet the open interval ``(lo, hi)``; none starts under 0 or ends past ``limit``."""
    first = F.greatest(F.lit(0), (F.floor((lo - size) / step) + 1) * step).cast("long")
    stop = F.ceil(hi).cast("long")
    stop = stop if limit is None else F.least(stop, limit - size + 1)
    return F.when(first < stop, F.sequence(first, stop - 1, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def lattice(boxes: DataFrame, size: int, step: int) -> DataFrame:
    """``(box_id, x, y)`` of all candidate tiles of ``boxes(box_id, x0, y0, x1, y1)``; boxes that are only touched give none."""
    xs = boxes.select("box_id", "y0", "y1", F.explode(axis_origins(F.col("x0"), F.col("x1"), size, step)).alias("x"))
    return xs.select("box_id", "x", F.explode(axis_origins(F.col("y0"), F.col("y1"), size, step)).alias("y"))


def far_edge_origins(length: Column, size: int, step: int) -> Column:
    """Origins that cover ``length`` to its far edge: the lattice, and one flush with the edge."""
    inside = F.when(length > size, F.sequence(F.lit(0).cast("long"), (length - size).cast("long"), F.lit(step).cast("long")))
    return F.when(length <= size, F.array(F.lit(0).cast("long"))).otherwise(F.array_distinct(F.array_append(inside, (length - size).cast("long"))))


def indexed(tiles: DataFrame) -> DataFrame:
    """Adds ``tile_index`` from 0 within a slide, x before y."""
    return tiles.withColumn("tile_index", F.row_number().over(Window.partitionBy("slide_id").orderBy("x", "y")).cast("long") - 1)


def coarser(tiles: DataFrame, native: int) -> DataFrame:
    """Distinct cells of ``native`` pixels that hold a tile's centre; cells that cross the border stay."""
    cell = lambda c: (F.floor((F.col(c) + F.col("size") / 2) / native) * native).cast("long")
    return tiles.select("slide_id", cell("x").alias("x"), cell("y").alias("y")).distinct()


def class_areas(tiles: DataFrame, pixels: DataFrame, size: int, width: int, height: int) -> DataFrame:
    """``(tile_index, raw, overlap_area, tile_area)``: pixels of each raw class under each tile of ``tiles(tile_index, x, y)``.

    Rows of ``pixels(px, py, raw)`` are counted by place and class first, and these counts meet the distinct places of tiles by grid buckets, so
    the join has an equality on both axes and neither many tiles at a place nor many rows of a pixel multiply its pairs. A tile that is
    listed twice counts its pixels twice. Class 0 is background. Areas are clipped to the image. Classes that map to one label stay apart.
    """
    buckets = lambda c: F.explode(F.array(F.expr(f"{c} div {size}"), F.expr(f"{c} div {size}") + 1))
    counts = pixels.where("raw <> 0").groupBy("px", "py", "raw").agg(F.count("*").alias("n"))
    placed = counts.withColumns({"bx": F.expr(f"px div {size}"), "by": F.expr(f"py div {size}")})
    spread = tiles.select("x", "y").distinct().select("x", "y", buckets("x").alias("bx")).select("*", buckets("y").alias("by"))
    under = spread.join(placed, ["bx", "by"]).where(f"px >= x and px < x + {size} and py >= y and py < y + {size}")
    found = under.groupBy("x", "y", "raw").agg(F.sum("n").alias("n"))
    area = (F.least(F.col("x") + size, F.lit(width)) - F.col("x")) * (F.least(F.col("y") + size, F.lit(height)) - F.col("y"))
    held = tiles.groupBy("tile_index", "x", "y").agg(F.count("*").alias("times"))
    return held.join(found, ["x", "y"]).select("tile_index", "raw", (F.col("n") * F.col("times")).alias("overlap_area"), area.cast("long").alias("tile_area"))


def otsu(histogram: DataFrame) -> DataFrame:
    """``(threshold)`` of ``histogram(value, n)`` that maximises the variance between classes; the least of equals."""
    w = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)  # a histogram has 256 rows
    whole = Window.partitionBy()
    run = histogram.select("value", F.sum("n").over(w).alias("w0"), F.sum(F.col("n") * F.col("value")).over(w).alias("s0"), F.sum("n").over(whole).alias("w"), F.sum(F.col("n") * F.col("value")).over(whole).alias("s"))
    between = F.col("w0") * (F.col("w") - F.col("w0")) * F.pow(F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / (F.col("w") - F.col("w0")), 2)
    scored = run.where("w0 < w").withColumn("between", F.round(between, 3))
    return scored.agg(F.max_by("value", F.struct("between", (-F.col("value")).alias("o"))).alias("threshold"))


def pixel_saturation(r: str, g: str, b: str) -> Column:
    """8-bit saturation of a pixel, by the fixed-point division of the usual image library."""
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    share = F.rint(F.lit(float(255 << 12)) / F.when(high > 0, high)).cast("long")
    return F.when(high == 0, F.lit(0).cast("long")).otherwise(F.shiftright((high - low) * share + 2048, 12))


def blank_tiles(pixels: DataFrame) -> DataFrame:
    """``(tile_index, white, black, share_black, share_white)`` from ``(tile_index, r, g, b)``: pale or dark on average, or in a share of the pixels."""
    n = F.count("*")
    dark, pale = F.count_if(F.greatest("r", "g", "b") < 20), F.count_if(F.least("r", "g", "b") > 220)
    return pixels.groupBy("tile_index").agg(
        (F.avg(pixel_saturation("r", "g", "b")) < 5).alias("white"), ((F.avg("r") < 40) & (F.avg("g") < 40) & (F.avg("b") < 40)).alias("black"),
        (dark > 0.05 * n).alias("share_black"), (pale > 0.2 * n).alias("share_white"),
    )


# Classes of the artifact model, and the sets that are taken out.
TISSUE, BLOOD, NECROSIS, PEN, FOLD, HOLE, BACKGROUND = range(1, 8)
ALL_ARTIFACTS = frozenset({BLOOD, NECROSIS, PEN, FOLD, HOLE, BACKGROUND})
FOLDS_AND_PEN = frozenset({PEN, FOLD, HOLE, BACKGROUND})
PEN_ONLY = frozenset({PEN, BACKGROUND})


def excluded_classes(artifacts: bool = False, pen_marks: bool = False, listed: list[int] | None = None) -> frozenset[int]:
    """Classes that are taken out: none unless a flag asks for it, then the listed ones, else all artifacts, else pen marks."""
    if not (artifacts or pen_marks):
        return frozenset()
    return frozenset(map(int, listed)) if listed else ALL_ARTIFACTS if artifacts else PEN_ONLY


def kept_contours(contours: DataFrame, least_area: float) -> DataFrame:
    """``(id, area, holes)`` of outlines ``(id, parent = -1, area)`` whose area without all their holes is over ``least_area`` and not 0."""
    holes = contours.where("parent <> -1").groupBy(F.col("parent").alias("id")).agg(F.sum("area").alias("_a"), F.count("*").alias("holes"))
    own = contours.where("parent = -1").select("id", "area").join(holes, "id", "left")
    net = own.select("id", (F.col("area") - F.coalesce("_a", F.lit(0))).alias("area"), F.coalesce("holes", F.lit(0)).alias("holes"))
    return net.where((F.col("area") != 0) & (F.col("area") > least_area))


def largest_holes(contours: DataFrame, most: int, least_area: float) -> DataFrame:
    """``(id, parent, area)``: of the ``most`` largest holes of each outline those over ``least_area``; ties by id."""
    order = Window.partitionBy("parent").orderBy(F.desc("area"), "id")
    ranked = contours.where("parent <> -1").withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most)
    return ranked.where(F.col("area") > least_area).select("id", "parent", "area")


def chosen_ids(ids: DataFrame, listed: DataFrame, excluded: DataFrame) -> DataFrame:
    """``ids`` that are listed and not excluded; an empty list means all."""
    held = ids if listed.isEmpty() else ids.join(listed, "id", "left_semi")
    return held.join(excluded, "id", "left_anti")


def scaled_points(points: Column, sx: Column, sy: Column) -> Column:
    """Points ``(x, y)`` times two factors, cut to whole pixels towards 0."""
    return F.transform(points, lambda p: F.struct((p["x"] * sx).cast("int").alias("x"), (p["y"] * sy).cast("int").alias("y")))


def square(x: Column, y: Column, size: Column) -> Column:
    """The corners of a tile, one after another."""
    corner = lambda dx, dy: F.struct((x + dx).cast("long").alias("x"), (y + dy).cast("long").alias("y"))
    return F.array(corner(F.lit(0), F.lit(0)), corner(size, F.lit(0)), corner(size, size), corner(F.lit(0), size))


def mosaic_place(number: Column, a_row: int, size: int, downscale: int) -> tuple[Column, Column]:
    """Columns ``x`` and ``y`` of the place of a tile in a mosaic that is filled row by row."""
    small = -(-size // downscale)
    return (number % a_row * small).cast("long").alias("x"), (F.floor(number / a_row) * small).cast("long").alias("y")


def drawn_size(width: Column, height: Column, downsample: Column, largest: Column) -> tuple[Column, Column]:
    """Width and height of a drawing after a downsample over 1 and then a limit on the longer side, cut to whole pixels."""
    cut = lambda x: F.when(downsample > 1, (x / downsample).cast("long")).otherwise(x.cast("long"))
    w, h = cut(width), cut(height)
    factor = F.when((w > largest) | (h > largest), largest / F.greatest(w, h)).otherwise(F.lit(1.0))
    return (w * factor).cast("long"), (h * factor).cast("long")


def derived_sets(sets: DataFrame, tiles: DataFrame, target_px: int) -> tuple[DataFrame, DataFrame]:
    """Coarser tile sets ``(slide_id, ..., derived_*, tiles)`` and their tiles ``(slide_id, x, y)``, of cells that hold a source tile's centre.

    ``sets`` has ``slide_id``, ``patch_size``, ``step_size``, ``target_px``, ``patch_level``, ``mpp``, ``native_mpp`` and further attributes, which stay. A source that
    isn't cut at level 0, has larger tiles, or a resolution that isn't positive is an error. Cells that cross the border stay.
    """
    wrong = F.when(F.col("patch_level") != 0, "the source isn't cut at level 0").when(~(F.col("native_mpp") > 0), "the source has no resolution").when(F.col("target_px") > target_px, "derived tiles can't be smaller than the source's")
    checked = sets.withColumn("_native", F.when(wrong.isNotNull(), F.raise_error(wrong).cast("long")).otherwise(native_size(F.lit(target_px), F.col("mpp"), F.col("native_mpp"))))
    placed = tiles.join(checked.select("slide_id", "patch_size", "_native"), "slide_id")
    cell = lambda c: (F.floor((F.col(c) + F.col("patch_size") / 2) / F.col("_native")) * F.col("_native")).cast("long").alias(c)
    cells = placed.select("slide_id", cell("x"), cell("y")).distinct()
    counts = tiles.groupBy("slide_id").agg(F.count("*").alias("derived_source_tiles")).join(cells.groupBy("slide_id").agg(F.count("*").alias("tiles")), "slide_id")
    told = checked.join(counts, "slide_id", "left").na.fill(0, ["derived_source_tiles", "tiles"])
    told = told.withColumns({"derived_source_patch_size": F.col("patch_size").cast("long"), "derived_source_tile_px": F.col("target_px")})
    new = {"patch_size": F.col("_native"), "step_size": F.col("_native"), "target_px": F.lit(target_px), "patch_level": F.lit(0), "overlap": F.lit(0), "max_tiles": F.lit(None).cast("int")}
    return told.withColumns(new).drop("_native"), cells


def mapped_areas(tiles: DataFrame, pixels: DataFrame, mapping: DataFrame, size: int, width: int, height: int) -> DataFrame:
    """``(tile_index, x, y, raw, annotation, overlap_area, tile_area)``: :func:`class_areas` of the raw classes that ``mapping(raw, label)`` names.

    A tile is its index and place, so indices of several slides don't mix if the caller keeps them apart.
    """
    keyed = tiles.select(F.struct("tile_index", "x", "y").alias("tile_index"), "x", "y")
    areas = class_areas(keyed, pixels.join(F.broadcast(mapping), "raw", "left_semi"), size, width, height)
    named = areas.join(F.broadcast(mapping.withColumnRenamed("label", "annotation")), "raw")  # 255 classes at most
    return named.select("tile_index.tile_index", "tile_index.x", "tile_index.y", "raw", "annotation", "overlap_area", "tile_area")
