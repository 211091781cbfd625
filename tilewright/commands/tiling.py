"""Commands that make and use tile sets.

A slide is a row of ``slides``: ``slide_id``, ``width``, ``height`` (level 0), ``mpp`` (level 0), ``level_width``, ``level_height`` and ``pixels``, the RGB bytes of the level
that is segmented. A tile is ``(slide_id, tile_set, tile_index, x, y)``, its place in pixels of level 0.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tilewright.functions import slides as fn
from tilewright.operators import annotate as ann
from tilewright.operators import features as feat
from tilewright.operators import rasters, tiles
from tilewright.operators.batches import check_batch, each_slide, slide_status
from tilewright.sources.images import write_png


@dataclass(frozen=True)
class SegConfig:
    patch_size: int = 256
    patch_sizes: list[int] | None = None
    patch_mpps: list[float] | None = None
    step_size: int | None = None
    mpp: float = 0.5
    segment_threshold: int = 20
    median_blur_ksize: int = 7
    morphology_ex_kernel: int = 0
    use_otsu: bool = False
    tissue_area_threshold: float = 100
    hole_area_threshold: float = 16
    max_num_holes: int = 8
    keep_ids: list[int] = field(default_factory=list)
    exclude_ids: list[int] = field(default_factory=list)
    overlap: int = 0
    min_tissue_proportion: float = 0.0
    remove_artifacts: bool = False
    remove_penmarks: bool = False
    artifact_exclude_classes: list[int] | None = None
    seg_model: str = "classic"
    slide_mpp_override: float | None = None
    max_tiles: int | None = None
    max_tiles_strategy: str = "random"
    max_tiles_seed: int = 42
    selection_mode: str = "full_mask"
    max_candidate_tiles: int | None = None

    def specs(self) -> list[tuple[int, float]]:
        """Sizes and resolutions of the tile sets; distinct, one resolution for each size or for all."""
        if self.patch_sizes is None:
            return [(self.patch_size, self.mpp)]
        if not self.patch_sizes:
            raise ValueError("no tile size is given")
        mpps = self.patch_mpps or [self.mpp] * len(self.patch_sizes)
        if len(mpps) != len(self.patch_sizes):
            raise ValueError("there must be a resolution for each tile size")
        found = list(zip(self.patch_sizes, mpps))
        if len({*found}) < len(found):
            raise ValueError("tile sets must be distinct")
        if len(found) > 1 and self.step_size is not None:
            raise ValueError("one step can't serve several tile sizes")
        return found


# The presets.
PRESETS = {
    "default": SegConfig(),
    "biopsy": SegConfig(segment_threshold=15, median_blur_ksize=11, morphology_ex_kernel=2, tissue_area_threshold=1, hole_area_threshold=1, max_num_holes=2),
    "resection": SegConfig(segment_threshold=15, median_blur_ksize=11, morphology_ex_kernel=4, tissue_area_threshold=100, hole_area_threshold=16, max_num_holes=8),
    "tcga": SegConfig(segment_threshold=8, median_blur_ksize=7, morphology_ex_kernel=4, tissue_area_threshold=16, hole_area_threshold=4, max_num_holes=8),
    "stain": SegConfig(min_tissue_proportion=0.75, seg_model="neural", max_tiles=32, selection_mode="bounded_neural", max_candidate_tiles=256),
}


@dataclass(frozen=True)
class Hooks:
    """Pluggable parts: ``segment(rgb, mpp) -> mask``, ``artifacts(rgb, mask, mpp) -> classes`` and ``accepts(rgb, tiles, size) -> list of bool``."""

    segment: Callable | None = None
    artifacts: Callable | None = None
    accepts: Callable | None = None


TILES = StructType([
    StructField("slide_id", StringType()), StructField("tile_set", StringType()), StructField("tile_index", LongType()), StructField("x", LongType()), StructField("y", LongType()),
    StructField("tissue_share", DoubleType()), StructField("patch_size", LongType()), StructField("step_size", LongType()), StructField("target_px", IntegerType()), StructField("mpp", DoubleType()),
    StructField("native_mpp", DoubleType()), StructField("patch_level", IntegerType()),
])


def native_size(size: int, mpp: float, slide_mpp: float) -> int:
    if mpp < slide_mpp - 0.01:
        raise ValueError("a tile can't be finer than its slide")
    return int(round(size * mpp / slide_mpp))


def step_of(cfg: SegConfig, size: int) -> int:
    if cfg.step_size is not None and cfg.overlap:
        raise ValueError("step and overlap can't both be given")
    if not 0 <= cfg.overlap < size:
        raise ValueError("the overlap must be at least 0 and less than the tile")
    return cfg.step_size if cfg.step_size is not None else size - cfg.overlap


def mask_of(rgb: np.ndarray, mpp: float, cfg: SegConfig, hooks: Hooks) -> np.ndarray:
    """The tissue mask of a level: by saturation, or by a pluggable segmenter and then closed; without artifacts if that is asked for."""
    if cfg.seg_model == "neural" and not cfg.use_otsu:  # the older switch comes first
        if hooks.segment is None:
            raise ValueError("the neural segmenter must be given")
        mask = rasters.closing(hooks.segment(rgb, mpp), cfg.morphology_ex_kernel)
    else:
        mask = rasters.tissue_mask(rgb, cfg.segment_threshold, cfg.median_blur_ksize, cfg.morphology_ex_kernel, cfg.use_otsu or cfg.seg_model == "otsu")
    excluded = tiles.excluded_classes(cfg.remove_artifacts, cfg.remove_penmarks, cfg.artifact_exclude_classes)
    if excluded and hooks.artifacts is not None:
        mask, _ = rasters.without_artifacts(mask, hooks.artifacts(rgb, mask, mpp), set(excluded))
    return mask


def tiles_of_slide(row: dict, cfg: SegConfig, hooks: Hooks) -> Iterator[dict]:
    """The tiles of one slide for every spec, each as a single run would give them; the mask is made once."""
    rgb = np.frombuffer(row["pixels"], np.uint8).reshape(int(row["level_height"]), int(row["level_width"]), 3)
    size = int(row["width"]), int(row["height"])
    sx, sy = size[0] / rgb.shape[1], size[1] / rgb.shape[0]
    slide_mpp = cfg.slide_mpp_override if cfg.slide_mpp_override is not None else row["mpp"]
    slide_mpp = fn.DEFAULT_MPP if slide_mpp is None or math.isnan(slide_mpp) else slide_mpp
    bounded = cfg.selection_mode == "bounded_neural"
    found = None if bounded else rasters.borders(mask_of(rgb, slide_mpp * sx, cfg, hooks))
    for target, mpp in cfg.specs():
        native, step = native_size(target, mpp, slide_mpp), native_size(step_of(cfg, target), mpp, slide_mpp)
        if bounded:
            if hooks.accepts is None:
                raise ValueError("a bounded selection needs a judge of tiles")
            asked = rasters.bounded_candidates(rasters.proposal_mask(rgb), size, (sx, sy), native, step, cfg.max_tiles_seed, cfg.max_tiles_strategy)
            chosen = [(x, y, None) for x, y in rasters.bounded_selection(asked, lambda part: hooks.accepts(rgb, part, native), cfg.max_tiles, cfg.max_candidate_tiles)]
        else:
            level_area = int(native**2 / (sx * sy))
            regions = rasters.tissue_borders(found, cfg.tissue_area_threshold * level_area, cfg.hole_area_threshold * level_area, cfg.max_num_holes)
            regions = rasters.chosen([(rasters.scaled(o, sx, sy), [rasters.scaled(h, sx, sy) for h in holes]) for o, holes in regions], cfg.keep_ids, cfg.exclude_ids)
            chosen = list(rasters.tiles_of(regions, native, step, size, cfg.min_tissue_proportion))
            if cfg.max_tiles is not None and len(chosen) > cfg.max_tiles:
                random = cfg.max_tiles_strategy == "random"
                at = np.sort(np.random.default_rng(cfg.max_tiles_seed).choice(len(chosen), size=cfg.max_tiles, replace=False)) if random else range(cfg.max_tiles)
                chosen = [chosen[int(i)] for i in at]
        for i, (x, y, share) in enumerate(chosen):
            yield {
                "slide_id": row["slide_id"], "tile_set": f"{target}px@{mpp:g}", "tile_index": i, "x": x, "y": y, "tissue_share": share, "patch_size": native, "step_size": step,
                "target_px": target, "mpp": mpp, "native_mpp": slide_mpp, "patch_level": 0,
            }


def tessellate(slides: DataFrame, cfg: SegConfig = SegConfig(), hooks: Hooks = Hooks(), continue_on_error: bool = True) -> tuple[DataFrame, DataFrame]:
    """Tiles of all slides, and the status of each slide: ``ok``, ``skipped`` (no tiles) or ``failed`` with its error.

    With ``continue_on_error`` False a failed slide fails the command; else see :func:`check_batch`.
    """
    cfg.specs()  # a wrong configuration fails before any slide is read
    made = each_slide(slides, lambda row: tiles_of_slide(row, cfg, hooks), TILES)
    found = made.where("error is null").drop("error")
    status = slide_status(slides, found, made.where("error is not null").select("slide_id", "error"))
    if not continue_on_error:
        check_batch(status)
    return found, status


def derive_tile_grid(tile_sets: DataFrame, source: DataFrame, patch_size: int = 512) -> tuple[DataFrame, DataFrame]:
    """Coarser tile sets and their tiles in order: see :func:`tiles.derived_sets`."""
    sets, cells = tiles.derived_sets(tile_sets, source, patch_size)
    return sets, tiles.indexed(cells)


@dataclass(frozen=True)
class FilterConfig:
    classifier_threshold: float = 0.75


def filter_tessellate(slides: DataFrame, features_of: Callable[[DataFrame], DataFrame], weights: list[float], bias: float, cfg: SegConfig = SegConfig(), hooks: Hooks = Hooks(), how: FilterConfig = FilterConfig()) -> DataFrame:
    """Tiles whose features a classifier takes: tessellation, features, then the filter; ``features_of`` adds ``embedding`` to tiles."""
    found, _ = tessellate(slides, cfg, hooks)
    return feat.logistic_filter(features_of(found), weights, bias, how.classifier_threshold)


@dataclass(frozen=True)
class PngConfig:
    filter_black_white: bool = True
    white_threshold: float = 15
    black_threshold: float = 50


def export_tiles(images: DataFrame, cfg: PngConfig = PngConfig()) -> DataFrame:
    """``(slide_id, name, png)`` of ``(slide_id, x, y, width, height, pixels)``; white and black tiles are left out, as is one without pixels. The name is the place."""
    kind = images.schema["slide_id"].dataType.simpleString()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for slide, x, y, w, h, raw in zip(pdf["slide_id"], pdf["x"], pdf["y"], pdf["width"], pdf["height"], pdf["pixels"]):
                if raw is None:
                    continue
                rgb = np.frombuffer(raw, np.uint8).reshape(int(h), int(w), 3)
                if not (cfg.filter_black_white and (rasters.is_white(rgb, cfg.white_threshold) or rasters.is_black(rgb, cfg.black_threshold))):
                    rows.append((slide, f"{int(x)}_{int(y)}.png", write_png(rgb)))
            yield pd.DataFrame(rows, columns=["slide_id", "name", "png"])

    return images.select("slide_id", "x", "y", "width", "height", "pixels").mapInPandas(write, f"slide_id {kind}, name string, png binary")


def cache_tiles(images: DataFrame, scores: DataFrame | None = None, limit_to_class: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Tiles that can be read, of the wanted classes if any are named, and ``(slide_id, tile_indices)`` of those kept, in order."""
    held = images.where("pixels is not null")
    if limit_to_class:
        if scores is None:
            raise ValueError("classes can't be told without scores")
        held = held.join(ann.in_classes(scores, limit_to_class), "tile_index", "left_semi")
    return held, held.groupBy("slide_id").agg(F.sort_array(F.collect_list("tile_index")).alias("tile_indices"))  # indices of a slide's tiles


@dataclass(frozen=True)
class ConvertConfig:
    downscale_by: float = 1


def convert(listed: DataFrame, there: DataFrame, cfg: ConvertConfig = ConvertConfig()) -> DataFrame:
    """The tasks of a conversion; no codec is here, so the files themselves aren't written."""
    return fn.conversion_tasks(listed, there, cfg.downscale_by)
