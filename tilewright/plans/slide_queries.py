"""Queries over slide properties, names, paths and pyramid levels. A slide is a part, a supplier or an event, as the columns need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import slides as fn
from tilewright.operators import levels as lv
from tilewright.plans.catalog import register
from tilewright.plans.tables import table

PROPS = """case event_id % 10 when 0 then map('tiffslide.mpp-x', '0.25', 'aperio.MPP', '9') when 1 then map('aperio.MPP', event_type, 'aperio.AppMag', '40')
  when 2 then map('openslide.mpp-x', '0.499') when 3 then map('tiff.XResolution', string(event_id % 90000 + 1), 'tiff.ResolutionUnit', 'INCH')
  when 4 then map('tiff.XResolution', string(event_id % 40000 + 1), 'tiff.ResolutionUnit', 'centimeter') when 5 then map('tiff.XResolution', string(event_id % 4000 + 1), 'tiff.ResolutionUnit', 'MILLIMETER')
  when 6 then map('tiff.XResolution', string(event_id % 5), 'tiff.ResolutionUnit', 'micrometer') when 7 then map('aperio.AppMag', string(20 * (event_id % 3)))
  when 8 then map('aperio.AppMag', 'bad', 'tiffslide.objective-power', '40') else map('other', 'x') end"""


@register(
    "slide_mpp",
    """select event_id, case when event_id % 37 = 0 then 0.33 else case event_id % 10 when 0 then 0.25 when 1 then 0.5 when 2 then 0.499
  when 3 then round(25400.0::double / (event_id % 90000 + 1), 4) when 4 then round(10000.0::double / (event_id % 40000 + 1), 4) when 5 then round(1000.0::double / (event_id % 4000 + 1), 4)
  when 6 then case event_id % 5 when 0 then 0.5 else round(1.0::double / (event_id % 5), 4) end
  when 7 then case event_id % 3 when 0 then 0.5 when 1 then 0.5 else 0.25 end when 8 then 0.25 else 0.5 end end::double as mpp,
  event_id % 37 <> 0 and (event_id % 10 in (1, 9) or (event_id % 10 = 6 and event_id % 5 = 0) or (event_id % 10 = 7 and event_id % 3 = 0)) as is_fallback from events""",
)
def slide_mpp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slide's resolution by the chain of fallbacks, and whether it fell through to the default."""
    held = table(spark, sf_dir, "events").selectExpr("event_id", f"{PROPS} as props", "if(event_id % 37 = 0, 0.33D, null) as override")
    props, override = F.col("props"), F.col("override")
    return held.select("event_id", fn.mpp_of(props, override).alias("mpp"), fn.mpp_is_fallback(props, override).alias("is_fallback"))


LEVELS_SQL = "levels as (select p_partkey as slide_id, l.level::int as level, 40000 // (1 << (l.level * (1 + p_partkey % 2)))::bigint as width, 30000 // (1 << (l.level * (1 + p_partkey % 2)))::bigint as height, 0.1::double + (p_partkey % 9) * 0.05::double as mpp from part cross join (select unnest(range(0, 5)) as level) l), sized as (select *, 40000 / width as downsample_x, 30000 / height as downsample_y from levels)"


def levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = "int(level * (1 + p_partkey % 2))"
    held = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array(*map(F.lit, range(5)))).alias("level"))
    return held.selectExpr("p_partkey as slide_id", "level", f"bigint(40000 div shiftleft(1, {shift})) as width", f"bigint(30000 div shiftleft(1, {shift})) as height", "0.1D + (p_partkey % 9) * 0.05D as mpp")


@register("level_downsamples", f"with {LEVELS_SQL} select slide_id, level, round(downsample_x, 6) as downsample_x, round(downsample_y, 6) as downsample_y from sized")
def level_downsamples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downsamples of each level from its size."""
    return lv.with_downsamples(levels(spark, sf_dir)).select("slide_id", "level", *[F.round(c, 6).alias(c) for c in ("downsample_x", "downsample_y")])


@register("best_level", f"with {LEVELS_SQL}, w as (select p_partkey as slide_id, p_retailprice / 90.0 as want from part) select slide_id, coalesce(max(level) filter (downsample_x <= want), 0)::int as level from w join sized using (slide_id) group by slide_id")
def best_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last level that is no coarser than wanted, from a table of levels."""
    wanted = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("slide_id"), (F.col("p_retailprice") / 90.0).alias("downsample"))
    return lv.best_levels(lv.with_downsamples(levels(spark, sf_dir)), wanted)


@register("magnification_level", f"with {LEVELS_SQL} select slide_id, coalesce(max(level) filter (downsample_x <= 10.0 / mpp / 5.0), 0)::int as level from sized group by slide_id")
def magnification_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The level to read for a magnification of 5."""
    held = lv.with_downsamples(levels(spark, sf_dir))
    wanted = held.where("level = 0").select("slide_id", lv.downsample_for(F.lit(5.0), F.col("mpp")).alias("downsample"))
    return lv.best_levels(held, wanted)


@register(
    "tissue_level",
    f"with {LEVELS_SQL}, m as (select *, mpp * downsample_x as m from sized) select slide_id, coalesce(arg_min(level, (m, level)) filter (m >= 1.0 and m <= 2.25), arg_max(level, (m, -level)) filter (m <= 1.0), arg_min(level, (abs(ln(m)), level)))::int as level, round(coalesce(min(m) filter (m >= 1.0 and m <= 2.25), max(m) filter (m <= 1.0), arg_min(m, (abs(ln(m)), level))), 6) as level_mpp, coalesce(min(m) filter (m >= 1.0 and m <= 2.25), max(m) filter (m <= 1.0), arg_min(m, (abs(ln(m)), level))) > 2.25 as too_coarse from m group by slide_id",
)
def tissue_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The level for the tissue model, and whether even that is too coarse."""
    found = lv.tissue_levels(lv.with_downsamples(levels(spark, sf_dir)))
    return found.select("slide_id", "level", F.round("level_mpp", 6).alias("level_mpp"), lv.too_coarse(F.col("level_mpp")).alias("too_coarse"))


@register("tile_steps", "select p_partkey, case when p_partkey % 2 = 0 then 100 + p_partkey % 50 else 256 - p_partkey % 5 * 32 end::bigint as step from part")
def tile_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step between tiles from a given step or an overlap."""
    step = F.expr("if(p_partkey % 2 = 0, 100 + p_partkey % 50, null)")
    overlap = F.expr("if(p_partkey % 2 = 0, 0, p_partkey % 5 * 32)")
    return table(spark, sf_dir, "part").select("p_partkey", fn.step_of(F.lit(256), step, overlap).alias("step"))


@register("area_thresholds", "select p_partkey, (floor((200 + p_partkey)::double * (200 + p_partkey) / ((1 + p_partkey % 7) * (1 + p_partkey % 7))) * 16)::bigint as pixels from part")
def area_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tissue thresholds in pixels of a level."""
    native, s = F.col("p_partkey") + 200, (F.col("p_partkey") % 7 + 1).cast("double")
    return table(spark, sf_dir, "part").select("p_partkey", fn.area_threshold(native, s, s, F.lit(16)).alias("pixels"))


@register("inference_windows", "select p_partkey, (ceil(greatest(1, round_even((900 + p_partkey * 7) * (0.1::double + (p_partkey % 9) * 0.05::double), 0)) / 512.0) * ceil(greatest(1, round_even((500 + p_partkey * 3) * (0.1::double + (p_partkey % 9) * 0.05::double), 0)) / 512.0))::bigint as windows from part")
def inference_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of the tissue model over an image at its resolution."""
    mpp = F.lit(0.1) + (F.col("p_partkey") % 9) * 0.05
    return table(spark, sf_dir, "part").select("p_partkey", fn.inference_windows(F.col("p_partkey") * 7 + 900, F.col("p_partkey") * 3 + 500, mpp).alias("windows"))


@register("level0_spacing", "select p_partkey, case when p_partkey % 3 = 0 then 400 + p_partkey else round_even(512 * 0.5::double / (0.2::double + (p_partkey % 7) * 0.04::double), 0) end::bigint as spacing, round_even((200 + p_partkey) * (1 + p_partkey % 5 / 2.0::double), 0)::bigint as level0_size from part")
def level0_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level-0 distance of tiles, stored or computed, and level-0 size of a tile cut at a level."""
    stored = F.expr("if(p_partkey % 3 = 0, 400 + p_partkey, null)")
    spacing = fn.titan_spacing(stored, F.lit(512), F.lit(0.5), F.lit(0.2) + (F.col("p_partkey") % 7) * 0.04)
    return table(spark, sf_dir, "part").select("p_partkey", spacing.alias("spacing"), fn.level0_size(F.col("p_partkey") + 200, 1 + F.col("p_partkey") % 5 / 2.0).alias("level0_size"))


@register("output_paths", "select p_partkey, replace(replace('out/{patch_size}px/{mpp}.h5', '{patch_size}', (224 + p_partkey % 3 * 32)::varchar), '{mpp}', printf('%g', 0.25 + (p_partkey % 8) * 0.125::double)) as path from part")
def output_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placeholders of an output path filled in."""
    return table(spark, sf_dir, "part").select("p_partkey", fn.filled_template(F.lit("out/{patch_size}px/{mpp}.h5"), F.col("p_partkey") % 3 * 32 + 224, F.lit(0.25) + (F.col("p_partkey") % 8) * 0.125).alias("path"))


@register("json_numbers", "select event_id, case when event_id % 3 = 0 then null when event_id % 5 = 0 then null else value end as value from events")
def json_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and infinite numbers become null."""
    odd = F.expr("case when event_id % 3 = 0 then double('NaN') when event_id % 10 = 0 then double('-Infinity') when event_id % 5 = 0 then double('Infinity') else value end")
    return table(spark, sf_dir, "events").select("event_id", fn.finite_or_null(odd).alias("value"))


@register("image_normalise", "select p_partkey, round(((p_partkey % 256) / 255.0::double - [0.485, 0.456, 0.406][(p_partkey % 3 + 1)::int]) / [0.229, 0.224, 0.225][(p_partkey % 3 + 1)::int], 6)::double as value from part")
def image_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel values scaled and normalised by channel."""
    # Means and deviations of the three channels.
    mean, std = F.array(F.lit(0.485), F.lit(0.456), F.lit(0.406)), F.array(F.lit(0.229), F.lit(0.224), F.lit(0.225))
    channel = (F.col("p_partkey") % 3).cast("int")
    return table(spark, sf_dir, "part").select("p_partkey", F.round(((F.col("p_partkey") % 256) / 255.0 - F.get(mean, channel)) / F.get(std, channel), 6).alias("value"))


NAMED_SQL = "named as (select page_id, url, url || ['.svs', '.ome.tiff', '.OME.TIF', '.features.h5', '.h5', ''][(page_id % 6 + 1)::int] as path from pages)"


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    endings = F.array(*map(F.lit, [".svs", ".ome.tiff", ".OME.TIF", ".features.h5", ".h5", ""]))
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat("url", F.get(endings, (F.col("page_id") % 6).cast("int"))).alias("path"))


@register("slide_names", f"with {NAMED_SQL} select page_id, regexp_extract(path, '([^/]+?)(?:\\.[^./]*)?$', 1) as slide_id from named")
def slide_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slide ids from paths."""
    return named(spark, sf_dir).select("page_id", fn.slide_name(F.col("path")).alias("slide_id"))


@register(
    "compound_suffixes",
    f"""with {NAMED_SQL}, n as (select page_id, regexp_extract(path, '([^/]*)$', 1) as name from named),
s as (select page_id, name, case when lower(name) like '%.ome.tiff' then '.ome.tiff' when lower(name) like '%.ome.tif' then '.ome.tif' when lower(name) like '%.ome.btf' then '.ome.btf' else regexp_extract(lower(name), '.(\\.[^.]*)$', 1) end as suffix from n)
select page_id, left(name, length(name) - length(suffix)) as stem, suffix, regexp_replace(regexp_replace(name, '\\.h5$', ''), '\\.features$', '') as slide_id from s""",
)
def compound_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stems and suffixes, of one part or two, and the id of a features file."""
    parts = named(spark, sf_dir).select("page_id", fn.compound_split(F.col("path")).alias("p"), fn.default_slide_id(F.col("path")).alias("slide_id"))
    return parts.select("page_id", "p.stem", "p.suffix", "slide_id")


@register(
    "joined_paths",
    f"with {NAMED_SQL} select page_id, rtrim(url, '/') || '/' || ltrim('/feats/' || page_id || '.h5', '/') as path, regexp_extract(url, '^([A-Za-z]+)://', 1) in ('az', 'azblob', 'azfiles', 'abfs', 's3', 'gs', 'http', 'https') as remote from named where url is not null and url <> ''",
)
def joined_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths below a store, and whether a path is in a remote one."""
    return table(spark, sf_dir, "pages").where("url is not null and url <> ''").select("page_id", fn.join_path(F.col("url"), F.concat(F.lit("/feats/"), F.col("page_id").cast("string"), F.lit(".h5"))).alias("path"), fn.is_remote(F.col("url")).alias("remote"))


@register("project_layout", "select p_partkey, 'project/' || printf('%g', 0.25 * (1 + p_partkey % 4)::double) || '_' || (224 * (1 + p_partkey % 2)) || '_896_None/patches/' || p_partkey || '.h5' as patch_path, 'project/' || printf('%g', 0.25 * (1 + p_partkey % 4)::double) || '_' || (224 * (1 + p_partkey % 2)) || '_896_None/feats/clip/h5/' || p_partkey || '.h5' as features_path from part")
def project_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a project keeps the tiles and features of a slide."""
    folder = fn.project_folder(F.lit("project"), F.lit(0.25) * (1 + F.col("p_partkey") % 4), 224 * (1 + F.col("p_partkey") % 2), F.lit(896))
    file = F.concat(F.col("p_partkey").cast("string"), F.lit(".h5"))
    return table(spark, sf_dir, "part").select("p_partkey", fn.join_path(folder, F.concat(F.lit("patches/"), file)).alias("patch_path"), fn.join_path(folder, F.concat(F.lit("feats/clip/h5/"), file)).alias("features_path"))


FILES_SQL = "files as (select c_custkey || '.features.h5' as name from customer where c_custkey % 3 = 0 union all select c_custkey || '.h5' from customer where c_custkey % 4 = 0)"


@register(
    "feature_lookup",
    f"with {FILES_SQL}, w as (select c_custkey::varchar as slide_id from customer) select slide_id, case when a.name is not null and b.name is not null then null when a.name is not null then a.name else b.name end as name, a.name is not null and b.name is not null as conflict from w left join files a on a.name = slide_id || '.features.h5' left join files b on b.name = slide_id || '.h5'",
)
def feature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features file of each slide, with its own suffix or the old one; both is a conflict."""
    c = table(spark, sf_dir, "customer")
    files = c.where("c_custkey % 3 = 0").selectExpr("concat(c_custkey, '.features.h5') as name").union(c.where("c_custkey % 4 = 0").selectExpr("concat(c_custkey, '.h5') as name"))
    return fn.found_files(c.selectExpr("string(c_custkey) as slide_id"), files, "features.h5")


@register("available_ids", f"with {FILES_SQL} select distinct slide_id from (select left(name, -12) as slide_id from files where name like '%.features.h5' union all select left(name, -3) from files where name like '%.h5')")
def available_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all feature files by either suffix."""
    c = table(spark, sf_dir, "customer")
    files = c.where("c_custkey % 3 = 0").selectExpr("concat(c_custkey, '.features.h5') as name").union(c.where("c_custkey % 4 = 0").selectExpr("concat(c_custkey, '.h5') as name"))
    return fn.available_ids(files, "features.h5")


TASKS_SQL = "listed as (select 's' || o_custkey || ['.svs', '.ome.tif', '.txt'][(o_custkey % 3 + 1)::int] as wsi, case when o_orderkey % 11 = 0 then null else (o_orderkey % 8) / 8.0::double end as mpp, o_orderkey as place from orders), there as (select 's' || c_custkey || ['.svs', '.ome.tif', '.txt'][(c_custkey % 3 + 1)::int] as wsi from customer where c_custkey % 5 <> 0)"


def listed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ending = "element_at(array('.svs', '.ome.tif', '.txt'), int({0} % 3 + 1))"
    o = table(spark, sf_dir, "orders").selectExpr(f"concat('s', o_custkey, {ending.format('o_custkey')}) as wsi", "if(o_orderkey % 11 = 0, null, (o_orderkey % 8) / 8D) as mpp", "o_orderkey as place")
    c = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").selectExpr(f"concat('s', c_custkey, {ending.format('c_custkey')}) as wsi")
    return o, c


@register(
    "conversion_tasks",
    f"with {TASKS_SQL}, k as (select * from listed where mpp is not null), f as (select wsi, arg_min(mpp, place) as mpp, count(*) as rows from k group by wsi) select f.wsi, case when t.wsi is null then 'missing' when f.wsi like '%.txt' then 'unsupported' else 'convert' end as status, case when t.wsi is not null and f.wsi not like '%.txt' then f.mpp end as mpp, case when t.wsi is not null and f.wsi not like '%.txt' then f.mpp / 0.5 end as output_mpp, f.rows from f left join there t on t.wsi = f.wsi",
)
def conversion_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each file of a conversion list: missing, of an unknown kind, or converted at its first resolution."""
    return fn.conversion_tasks(*listed(spark, sf_dir), downscale=2)


@register("model_settings", "select p_partkey, case p_partkey % 4 when 0 then 'bfloat16' when 1 then 'float16' else 'float32' end as precision, case when p_partkey % 3 = 0 then 7 else p_partkey % 4 end::bigint as device from part")
def model_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-model settings over a default, and the first device of a list over a single one."""
    from tilewright.operators import registry as rg

    code = F.concat(F.lit("m"), (F.col("p_partkey") % 4).cast("string"))
    ids = F.expr("if(p_partkey % 3 = 0, array(7L, 8L), cast(array() as array<bigint>))")
    return table(spark, sf_dir, "part").select("p_partkey", rg.setting_of({"m0": "bfloat16", "m1": "float16"}, code, "float32").alias("precision"), rg.device_of(ids, F.col("p_partkey") % 4).alias("device"))
