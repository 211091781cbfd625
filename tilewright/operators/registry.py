"""The encoder registry: recommended tiles, widths, which patch encoder a slide encoder needs, and checks against tile sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.slides import general


@dataclass(frozen=True)
class Encoder:
    """``px`` and ``mpp`` of recommended tiles (null: not constrained), ``dim`` of patch features, ``needs``: the patch encoder of a slide encoder."""

    code: str
    kind: str
    dim: int | None
    px: int
    mpp: float | None = None
    needs: str | None = None


# Encoders in the order of their ids.
ENCODERS = [
    Encoder("resnet50", "patch", 1024, 256), Encoder("ctranspath", "patch", 768, 224), Encoder("gigapath", "patch", 1536, 256, 0.5), Encoder("virchow", "patch", 2560, 224, 0.5),
    Encoder("optimus", "patch", 1536, 224, 0.5), Encoder("clip", "patch", 512, 224), Encoder("googlepath", "patch", 384, 224), Encoder("conch1_5", "patch", 768, 512, 0.5),
    Encoder("virchow2", "patch", 2560, 224), Encoder("uni2h", "patch", 1536, 256, 0.5), Encoder("uni", "patch", 1024, 256, 0.5), Encoder("gigapath_slide", "slide", None, 256, 0.5, "gigapath"),
    Encoder("titan_slide", "slide", None, 512, 0.5, "conch1_5"), Encoder("phikon", "patch", 768, 224, 0.5), Encoder("phikon_v2", "patch", 1024, 224, 0.5), Encoder("hoptimus1", "patch", 1536, 224, 0.5),
    Encoder("h0mini", "patch", 768, 224, 0.5), Encoder("midnight12k", "patch", 3072, 224), Encoder("gpfm", "patch", 1024, 512, 0.25), Encoder("hibou_l", "patch", 1024, 224),
    Encoder("prism_slide", "slide", None, 224, 0.5, "virchow"), Encoder("feather_slide", "slide", None, 512, 0.5, "conch1_5"), Encoder("chief_slide", "slide", None, 256, 1.0, "ctranspath"), Encoder("madeleine_slide", "slide", None, 256, 1.0, "conch_v1"),
    Encoder("conch_v1", "patch", 512, 448), Encoder("kaiko_vits8", "patch", 384, 224), Encoder("kaiko_vits16", "patch", 384, 224), Encoder("kaiko_vitb8", "patch", 768, 224),
    Encoder("kaiko_vitb16", "patch", 768, 224), Encoder("kaiko_vitl14", "patch", 1024, 224), Encoder("lunit_vits8", "patch", 384, 224), Encoder("lunit_vits16", "patch", 384, 224),
    Encoder("openmidnight", "patch", 1536, 224), Encoder("genbio_pathfm", "patch", 4608, 224), Encoder("abmil_slide", "slide", None, 256), Encoder("musk", "patch", 1024, 384),
    Encoder("keep", "patch", 768, 256, 0.5),
]
#: Slide encoders that take the features of any patch encoder, which must then be named.
AGNOSTIC = frozenset({"abmil_slide"})
BY_CODE = {e.code: e for e in ENCODERS}


def encoders(spark: SparkSession) -> DataFrame:
    """``(id, code, kind, dim, px, mpp, needs)`` of every registered encoder."""
    rows = [(i + 1, e.code, e.kind, e.dim, e.px, e.mpp, e.needs) for i, e in enumerate(ENCODERS)]
    return spark.createDataFrame(rows, "id int, code string, kind string, dim int, px int, mpp double, needs string")


def tile_size_problem(px: Column, mpp: Column, want_px: Column, want_mpp: Column, tolerance: float = 0.05) -> Column:
    """What is wrong with a tile set for an encoder, else null; sizes must be equal, resolutions within the relative tolerance, nulls aren't compared."""
    size = F.when(px != want_px, F.concat(F.lit("tiles are "), px.cast("string"), F.lit(" px, recommended "), want_px.cast("string"), F.lit(" px")))
    far = F.when(F.abs(mpp - want_mpp) > tolerance * want_mpp, F.concat(F.lit("tiles are at "), general(mpp), F.lit(" µm/px, recommended "), general(want_mpp)))
    both = F.array_join(F.array_compact(F.array(size, far)), "; ")
    return F.when(both != "", both)


def checked_tiles(tile_sets: DataFrame, registry: DataFrame, mode: str = "warn") -> DataFrame:
    """``tile_sets(code, px, mpp, ...)`` with ``problem``; an encoder that isn't registered isn't checked. Mode ``error`` fails on the first problem, ``off`` finds none."""
    if mode not in ("warn", "error", "off"):
        raise ValueError(f"unknown mode {mode!r}")
    wanted = F.broadcast(registry.select("code", F.col("px").alias("_px"), F.col("mpp").alias("_mpp")))  # the registry
    problem = F.lit(None).cast("string") if mode == "off" else tile_size_problem(F.col("px"), F.col("mpp"), F.col("_px"), F.col("_mpp"))
    out = tile_sets.join(wanted, "code", "left").withColumn("problem", problem).drop("_px", "_mpp")
    return out.withColumn("problem", F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem")))) if mode == "error" else out


def required_patch_encoder(slide_encoder: str) -> str:
    if slide_encoder in AGNOSTIC:
        raise ValueError(f"{slide_encoder} works with any patch encoder: name the one its features come from")
    if slide_encoder not in BY_CODE or BY_CODE[slide_encoder].needs is None:
        raise ValueError(f"unknown slide encoder {slide_encoder}")
    return BY_CODE[slide_encoder].needs


def compatible(pairs: DataFrame, registry: DataFrame) -> DataFrame:
    """``pairs(patch, slide, ...)`` with ``compatible``: true for the required or any patch encoder, null for an unknown slide encoder."""
    needs = F.broadcast(registry.where("kind = 'slide'").select(F.col("code").alias("slide"), "needs", F.lit(True).alias("_known")))
    free = F.col("slide").isin(*AGNOSTIC)
    return pairs.join(needs, "slide", "left").withColumn("compatible", F.when(free, F.lit(True)).when(F.col("_known"), F.col("patch") == F.col("needs"))).drop("needs", "_known")


def resolved_aggregation(method: str, slide_encoder: str | None) -> str:
    """``model`` where a slide encoder is given and nothing else was asked for; mean and max don't use it."""
    return "model" if slide_encoder is not None and method == "identity" else method


def resolved_patch_encoder(patch: str | None, slide_encoder: str | None) -> str | None:
    """The patch encoder that a slide encoder is tied to, whatever was given; with an agnostic one that which was given."""
    if slide_encoder is None:
        return patch
    if slide_encoder in AGNOSTIC:
        if patch is None:
            raise ValueError(f"{slide_encoder} works with any patch encoder: name the one its features come from")
        return patch
    return required_patch_encoder(slide_encoder)


def model_groups(models: DataFrame, registry: DataFrame) -> DataFrame:
    """``(px, mpp, models)``: encoders that share a tile set, in order, from ``models(code)``; a slide encoder counts by its patch encoder too."""
    known = models.join(F.broadcast(registry), "code")
    each = known.select("code", "px", "mpp").union(known.where("needs is not null").select(F.col("needs").alias("code"), "px", "mpp")).distinct()
    return each.groupBy("px", "mpp").agg(F.array_join(F.array_sort(F.collect_set("code")), ",").alias("models"))  # codes of the registry


def setting_of(settings: dict[str, str], code: Column, default: str) -> Column:
    """A per-encoder setting, else the default."""
    found = F.coalesce(*[F.when(code == k, F.lit(v)) for k, v in settings.items()]) if settings else F.lit(None).cast("string")
    return F.coalesce(found, F.lit(default))


def device_of(ids: Column, single: Column) -> Column:
    """The first device of a list if it isn't empty, else the single one."""
    return F.coalesce(F.when(F.size(ids) > 0, F.get(ids, F.lit(0))), single)
