"""Commands that make, filter and aggregate features."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.commands.tiling import Hooks, SegConfig, tessellate
from tilewright.operators import encoders as enc
from tilewright.operators import features as feat
from tilewright.operators import registry
from tilewright.operators import sampling as sm
from tilewright.operators.batches import check_batch, slide_status


@dataclass(frozen=True)
class ExtractFeaturesConfig:
    model_types: tuple[str, ...] = ("clip",)
    batch_size: int = 64
    embedding_precision: str = "float32"
    is_test_run: bool = False
    tile_size_check: str = "warn"


def extract_features(images: DataFrame, cfg: ExtractFeaturesConfig = ExtractFeaturesConfig()) -> DataFrame:
    """Features of decoded tiles by the registered encoders, every tile decoded once; a trial run ends after three batches a task."""
    factories = {name: enc.encoder_factory(name) for name in cfg.model_types}
    return enc.encode_tiles(images, factories, cfg.batch_size, cfg.embedding_precision, 3 if cfg.is_test_run else None)


@dataclass(frozen=True)
class AggregateSlideFeaturesConfig:
    aggregation_method: str = "identity"
    slide_model_type: str | None = None
    embedding_precision: str = "float32"


def aggregate_slide_features(features: DataFrame, cfg: AggregateSlideFeaturesConfig = AggregateSlideFeaturesConfig(), slides: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One vector a slide (or, for ``identity``, the tiles as they are) and the status of each slide; a batch in which no slide has tiles fails."""
    method = registry.resolved_aggregation(cfg.aggregation_method, cfg.slide_model_type)
    known = features.select("slide_id").distinct() if slides is None else slides
    status = slide_status(known, features)
    if method == "identity":
        return features, status
    check_batch(status)
    if method in ("mean", "max"):
        return feat.pooled_vectors(features, method).withColumn("embedding", F.col("embedding").cast("array<float>")), status
    if method != "model" or cfg.slide_model_type is None:
        raise ValueError(f"unknown aggregation {cfg.aggregation_method!r}")
    return enc.encode_slides(features, enc.encoder_factory(cfg.slide_model_type), cfg.embedding_precision), status


@dataclass(frozen=True)
class AggregateSampleFeaturesConfig:
    max_tiles: int | None = None
    subsampling_strategy: str = "random"
    seed: int = 42


def aggregate_sample_features(features: DataFrame, slides: DataFrame, cfg: AggregateSampleFeaturesConfig = AggregateSampleFeaturesConfig()) -> DataFrame:
    """Tiles of the slides of each sample, drawn down to ``max_tiles`` by the numpy generator of the seed.

    ``slides`` is ``(slide_id, sample_id, slide_order)``. A sample whose slides have no tiles gives no rows; if none has any, the command fails. Sizes of slides
    are gathered, a row a slide.
    """
    joined = feat.sample_tiles(features, slides)
    sizes: dict = {}
    for r in features.groupBy("slide_id").agg(F.count("*").alias("n")).join(slides, "slide_id").orderBy("sample_id", "slide_order").collect():
        sizes.setdefault(r["sample_id"], []).append((r["slide_id"], r["n"]))
    if not sizes:
        raise ValueError("no sample has tiles")
    if cfg.subsampling_strategy not in ("random", "proportional", "equal"):
        raise ValueError(f"unknown sampling strategy {cfg.subsampling_strategy!r}")
    large = {s: held for s, held in sizes.items() if cfg.max_tiles is not None and sum(n for _, n in held) > cfg.max_tiles}
    if not large:
        return joined
    spark, kind = features.sparkSession, features.schema["slide_id"].dataType.simpleString()
    picked = None
    for held in large.values():
        drawn = sm.pooled_numpy(spark, [n for _, n in held], cfg.max_tiles, cfg.subsampling_strategy, cfg.seed)
        names = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(held)], f"slide long, slide_id {kind}")
        part = drawn.join(F.broadcast(names), "slide").select("slide_id", "tile_index")
        picked = part if picked is None else picked.union(part)
    whole = joined.where(~F.col("sample_id").isin(*large))
    return joined.join(picked, ["slide_id", "tile_index"], "left_semi").unionByName(whole)


@dataclass(frozen=True)
class FilterFeaturesConfig:
    classifier_threshold: float = 0.75


def filter_features(features: DataFrame, weights: list[float], bias: float, cfg: FilterFeaturesConfig = FilterFeaturesConfig()) -> DataFrame:
    """Rows whose classifier probability is strictly over the threshold."""
    return feat.logistic_filter(features, weights, bias, cfg.classifier_threshold)


def model_patch_sizes(spark: SparkSession) -> DataFrame:
    """Recommended tile size and resolution of every encoder."""
    return registry.encoders(spark).select("code", "px", "mpp")


@dataclass(frozen=True)
class TessellateExtractFeaturesConfig:
    seg_config: SegConfig = SegConfig()
    extract: ExtractFeaturesConfig = ExtractFeaturesConfig()
    aggregate: AggregateSlideFeaturesConfig = AggregateSlideFeaturesConfig()
    max_slide_patches: int | None = None
    save_features: bool = True


def tessellate_extract_features(slides: DataFrame, images_of: Callable[[DataFrame], DataFrame], cfg: TessellateExtractFeaturesConfig = TessellateExtractFeaturesConfig(), hooks: Hooks = Hooks()) -> tuple[DataFrame, DataFrame]:
    """Tiles, their features, and what the slides' features are aggregated to, with the status of each slide.

    ``images_of`` adds ``width``, ``height`` and ``pixels`` to tiles. ``max_slide_patches`` keeps so many tiles of a slide, drawn by the CRC-32 of its name.
    """
    if cfg.aggregate.slide_model_type is not None:
        patch = registry.resolved_patch_encoder(cfg.extract.model_types[0], cfg.aggregate.slide_model_type)
        if patch not in cfg.extract.model_types:
            raise ValueError(f"{cfg.aggregate.slide_model_type} needs features of {patch}")
    found, status = tessellate(slides, cfg.seg_config, hooks)
    if cfg.max_slide_patches is not None:
        found = sm.capped_numpy(found, cfg.max_slide_patches)
    features = extract_features(images_of(found), cfg.extract)
    out, _ = aggregate_slide_features(features, cfg.aggregate, slides.select("slide_id"))
    return (out if cfg.save_features or "n_tiles" in out.columns else out.drop("embedding")), status
