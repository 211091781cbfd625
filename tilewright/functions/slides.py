"""Expressions over slide properties, names, paths and levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MPP = 0.5
# Property keys in the order in which they are tried, and units of a TIFF resolution in micrometres.
DIRECT_KEYS = ["tiffslide.mpp-x", "aperio.MPP", "openslide.mpp-x"]
MAGNIFICATION_KEYS = ["aperio.AppMag", "openslide.objective-power", "tiffslide.objective-power"]
TIFF_UNITS = {"INCH": 25400.0, "CENTIMETER": 10000.0, "MILLIMETER": 1000.0, "MICROMETER": 1.0}
# Schemes of remote stores, slide suffixes of two parts, and image suffixes.
REMOTE_SCHEMES = ["az", "azblob", "azfiles", "abfs", "s3", "gs", "http", "https"]
COMPOUND_SUFFIXES = [".ome.tiff", ".ome.tif", ".ome.btf"]
IMAGE_SUFFIXES = ["png", "jpg", "jpeg", "bmp", "tif", "tiff"]


def _resolution(props: Column) -> Column:
    x, unit = props["tiff.XResolution"].try_cast("double"), F.upper(props["tiff.ResolutionUnit"])
    return F.coalesce(*[F.when((unit == u) & (x > 0), F.round(F.lit(s) / x, 4)) for u, s in TIFF_UNITS.items()])


def _from_magnification(props: Column) -> Column:
    mag = F.coalesce(*[props[k].try_cast("double") for k in MAGNIFICATION_KEYS])
    return F.when(mag > 0, 10 / mag)


def mpp_of(props: Column, override: Column | None = None, default: float = DEFAULT_MPP) -> Column:
    """Micrometres per pixel of a property map: a direct key, the TIFF resolution, ``10 / magnification``, else the default.

    The first direct key that is there decides; if it can't be read the default is taken at once. An override that isn't null comes before all;
    one of 0 or less is an error.
    """
    direct = F.coalesce(*[props[k] for k in DIRECT_KEYS])
    chain = F.coalesce(_resolution(props), _from_magnification(props), F.lit(default))
    found = F.when(direct.isNotNull(), F.coalesce(direct.try_cast("double"), F.lit(default))).otherwise(chain)
    if override is None:
        return found
    bad = F.raise_error(F.lit("an overriding resolution must be positive")).cast("double")
    return F.when(override <= 0, bad).when(override.isNotNull(), override.cast("double")).otherwise(found)


def mpp_is_fallback(props: Column, override: Column | None = None) -> Column:
    """Whether neither the override nor the properties gave a resolution."""
    direct = F.coalesce(*[props[k] for k in DIRECT_KEYS])
    read = F.when(direct.isNotNull(), direct.try_cast("double").isNotNull()).otherwise(F.coalesce(_resolution(props), _from_magnification(props)).isNotNull())
    return ~read if override is None else ~(override.isNotNull() | read)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def slide_name(path: Column) -> Column:
    """The stem of a file name: its last suffix goes."""
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def compound_split(path: Column) -> Column:
    """Struct ``(stem, suffix)`` of a file name; a suffix of two parts counts whole, whatever its case, and one is in lower case."""
    name = file_name(path)
    low = F.lower(name)
    suffix = F.coalesce(*[F.when(low.endswith(s), F.lit(s)) for s in COMPOUND_SUFFIXES], F.regexp_extract(low, r".(\.[^.]*)$", 1))
    return F.struct(F.substring(name, F.lit(1), F.length(name) - F.length(suffix)).alias("stem"), suffix.alias("suffix"))


def default_slide_id(path: Column) -> Column:
    """The id of a features file: its name without ``.h5`` and then without ``.features``."""
    return F.regexp_replace(F.regexp_replace(file_name(path), r"\.h5$", ""), r"\.features$", "")


def is_remote(path: Column) -> Column:
    return F.regexp_extract(path, r"^([A-Za-z]+)://", 1).isin(*REMOTE_SCHEMES)


def join_path(base: Column, name: Column) -> Column:
    """``base`` and ``name`` with one slash between them; without a base the name alone."""
    return F.when(F.coalesce(base, F.lit("")) == "", name).otherwise(F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(name, "^/+", "")))


def filled_template(template: Column, patch_size: Column, mpp: Column) -> Column:
    """``{patch_size}`` and ``{mpp}`` of a path template filled in; a resolution has no zeros at its end."""
    return F.replace(F.replace(template, F.lit("{patch_size}"), patch_size.cast("string")), F.lit("{mpp}"), general(mpp))


def finite_or_null(x: Column) -> Column:
    """Null for what JSON can't hold: NaN and infinite numbers."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def step_of(patch: Column, step: Column, overlap: Column) -> Column:
    """The step between tiles: the given one, else the tile's size less the overlap. Both given, or an overlap outside ``[0, patch)``, is an error."""
    wrong = F.when(step.isNotNull() & (F.coalesce(overlap, F.lit(0)) != 0), "step and overlap can't both be given").when((overlap < 0) | (overlap >= patch), "the overlap must be at least 0 and less than the tile")
    return F.when(wrong.isNotNull(), F.raise_error(wrong).cast("long")).otherwise(F.coalesce(step, patch - F.coalesce(overlap, F.lit(0))).cast("long"))


def area_threshold(native: Column, sx: Column, sy: Column, threshold: Column) -> Column:
    """Pixels of a level that ``threshold`` reference tiles cover: whole pixels of one tile, times the threshold."""
    return (F.floor(native.cast("double") * native / (sx * sy)) * threshold).cast("long")


def inference_windows(height: Column, width: Column, scale: Column, window: int = 512) -> Column:
    """Windows that cover an image after it is scaled."""
    along = lambda x: F.ceil(F.greatest(F.lit(1), F.rint(x * scale)) / window)
    return (along(height) * along(width)).cast("long")


def titan_spacing(attribute: Column, target: Column, mpp: Column, native_mpp: Column) -> Column:
    """Level-0 distance of tiles: the stored attribute, else from target pixels and resolutions, halves to even; else an error."""
    computed = F.when(native_mpp > 0, F.rint(target * mpp / native_mpp).cast("long"))
    return F.coalesce(attribute.cast("long"), computed, F.raise_error(F.lit("no spacing can be told")).cast("long"))


def level0_size(patch: Column, downsample: Column) -> Column:
    """Level-0 pixels of a tile that was cut at a level, halves to even."""
    return F.rint(patch * downsample).cast("long")


def survives(pre: Column, post: Column, most_lost: float = 0.9) -> Column:
    """Pixels that count after artifacts were removed: those before if nearly all went, or if there were none."""
    return F.when((pre == 0) | (1 - post / F.when(pre > 0, pre) >= most_lost), pre).otherwise(post)


def project_folder(root: Column, mpp: Column, patch: Column, step: Column) -> Column:
    """The folder of a project for one kind of tiles."""
    return join_path(root, F.concat_ws("_", general(mpp), patch.cast("string"), step.cast("string"), F.lit("None")))


def found_files(slides: DataFrame, files: DataFrame, suffix: str) -> DataFrame:
    """``(slide_id, name, conflict)``: ``<id>.<suffix>`` if it is among ``files(name)``, else ``<id>.h5``, else null; where both are there neither is taken."""
    own = files.select(F.col("name").alias("own"))
    old = files.select(F.col("name").alias("old"))
    met = slides.join(own, F.col("own") == F.concat("slide_id", F.lit(f".{suffix}")), "left").join(old, F.col("old") == F.concat("slide_id", F.lit(".h5")), "left")
    both = F.col("own").isNotNull() & F.col("old").isNotNull() & F.lit(suffix != "h5")
    return met.select("slide_id", F.when(~both, F.coalesce("own", "old")).alias("name"), both.alias("conflict"))


def available_ids(files: DataFrame, suffix: str) -> DataFrame:
    """Distinct ``(slide_id)`` of all ``files(name)`` that end in ``.<suffix>`` or ``.h5``; a name that ends in both gives two ids."""
    of = lambda s: files.where(F.col("name").endswith(f".{s}")).select(F.substring("name", F.lit(1), F.length("name") - len(s) - 1).alias("slide_id"))
    return of(suffix).union(of("h5")).distinct()


# Suffixes of files that can be converted, and of slides that a directory is searched for.
CONVERTIBLE = [
    ".tif", ".tiff", ".ndpi", ".svs", ".lif", ".ims", ".vsi", ".bif", ".btf", ".mrxs", ".scn", ".ome.tiff", ".ome.tif", ".h5", ".hdf", ".hdf5", ".he5",
    ".dicom", ".dcm", ".ome.xml", ".zvi", ".pcoraw", ".jp2", ".qptiff", ".nrrd", ".ome.btf", ".fg7", ".png", ".jpg", ".jpeg", ".czi",
]
SLIDE_SUFFIXES = [".svs", ".ndpi", ".scn", ".tif", ".tiff", ".mrxs", ".vms", ".vmu", ".bif", ".qptiff", ".czi"]


def conversion_tasks(listed: DataFrame, there: DataFrame, downscale: float = 1) -> DataFrame:
    """``(wsi, status, mpp, output_mpp, rows)`` for each file of a list ``(wsi, mpp, place)``: ``missing``, ``unsupported`` or ``convert``.

    Rows without a name or a resolution don't count; of several the first by place gives the resolution, and ``rows`` says how many there are.
    """
    kept = listed.where("wsi is not null and mpp is not null").groupBy("wsi").agg(F.min_by("mpp", "place").alias("mpp"), F.count("*").alias("rows"))
    met = kept.join(there.select("wsi", F.lit(True).alias("_there")).distinct(), "wsi", "left")
    status = F.when(F.col("_there").isNull(), "missing").when(~compound_split(F.col("wsi"))["suffix"].isin(*CONVERTIBLE), "unsupported").otherwise("convert")
    told = met.withColumn("status", status).withColumn("mpp", F.when(F.col("status") == "convert", F.col("mpp")))
    return told.select("wsi", "status", "mpp", (F.col("mpp") / (1 / downscale)).alias("output_mpp"), "rows")


def general(x: Column) -> Column:
    """A positive number with six significant digits at most and no zeros at its end."""
    digits = F.when(x >= 1e5, F.round(x, 0)).when(x >= 1e4, F.round(x, 1)).when(x >= 1e3, F.round(x, 2)).when(x >= 100, F.round(x, 3)).when(x >= 10, F.round(x, 4)).when(x >= 1, F.round(x, 5)).when(x >= 0.1, F.round(x, 6)).when(x >= 0.01, F.round(x, 7)).otherwise(F.round(x, 8))
    return F.regexp_replace(F.regexp_replace(F.format_number(digits, 8), ",", ""), r"\.?0+$", "")
