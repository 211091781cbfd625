"""Pyramid levels: which one to read, how coarse it is, how large things are there. ``levels`` is ``(slide_id, level, width, height)``, one row a level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Resolution of the tissue model in micrometres a pixel, and how much coarser a level may be.
TARGET_MPP, MOST_UPSCALE = 1.0, 2.25


def with_downsamples(levels: DataFrame) -> DataFrame:
    """Adds ``downsample_x`` and ``downsample_y``: the size of level 0 over the level's own."""
    whole = levels.where("level = 0").select("slide_id", F.col("width").alias("_w"), F.col("height").alias("_h"))
    return levels.join(whole, "slide_id").withColumns({"downsample_x": F.col("_w") / F.col("width"), "downsample_y": F.col("_h") / F.col("height")}).drop("_w", "_h")


def best_levels(levels: DataFrame, wanted: DataFrame, downsample: str = "downsample_x") -> DataFrame:
    """``(slide_id, level)``: the last level that is no coarser than ``wanted(slide_id, downsample)``, else 0."""
    met = wanted.select("slide_id", F.col("downsample").alias("_want")).join(levels, "slide_id", "left")
    return met.groupBy("slide_id").agg(F.coalesce(F.max(F.when(F.col(downsample) <= F.col("_want"), F.col("level"))), F.lit(0)).alias("level"))


def downsample_for(target_magnification: Column, mpp: Column) -> Column:
    """How much a slide of ``10 / mpp`` must be reduced to have the target magnification."""
    return 10.0 / mpp / target_magnification


def tissue_levels(levels: DataFrame, mpp: str = "mpp", downsample: str = "downsample_x") -> DataFrame:
    """``(slide_id, level, level_mpp)`` for the tissue model: the finest level from its resolution to what may be enlarged, else the coarsest finer one, else the nearest by ratio."""
    m = F.col(mpp) * F.col(downsample)
    held = levels.withColumn("_m", m)
    first, last = F.struct("_m", "level"), F.struct((-F.col("_m")).alias("n"), "level")
    picked = held.groupBy("slide_id").agg(
        F.min(F.when((F.col("_m") >= TARGET_MPP) & (F.col("_m") <= TARGET_MPP * MOST_UPSCALE), first)).alias("a"),
        F.min(F.when(F.col("_m") <= TARGET_MPP, last)).alias("b"),
        F.min(F.struct(F.abs(F.ln(F.col("_m") / TARGET_MPP)).alias("d"), F.col("level").alias("level"), F.col("_m").alias("m"))).alias("c"),
    )
    level = F.coalesce("a.level", "b.level", "c.level")
    return picked.select("slide_id", level.cast("int").alias("level"), F.coalesce(F.col("a._m"), -F.col("b.n"), F.col("c.m")).alias("level_mpp"))


def too_coarse(level_mpp: Column, most_upscale: float | None = MOST_UPSCALE) -> Column:
    """Whether a level would have to be enlarged too much; never without a limit."""
    return F.lit(False) if most_upscale is None else level_mpp > TARGET_MPP * most_upscale
