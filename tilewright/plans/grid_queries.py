"""Queries over tile attributes, pixels, contours and drawings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import tiles as op
from tilewright.plans.catalog import register
from tilewright.plans.tables import table
from tilewright.plans.tile_queries import raster

# The pixels of a supplier's line items, as pale or as dark as its key says.
PIXELS_SQL = """pixels as (select l_suppkey as tile_index, (case l_suppkey % 4 when 0 then 255 - l_partkey % 12 when 1 then l_partkey % 45 else l_partkey % 256 end)::int as r,
  (case l_suppkey % 4 when 0 then 255 - l_partkey % 10 when 1 then l_orderkey % 45 else l_orderkey % 256 end)::int as g, (case l_suppkey % 4 when 0 then 255 - l_partkey % 11 when 1 then l_linenumber else (l_orderkey * 7 + l_linenumber) % 256 end)::int as b from lineitem)"""


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey as tile_index", "int(case l_suppkey % 4 when 0 then 255 - l_partkey % 12 when 1 then l_partkey % 45 else l_partkey % 256 end) as r",
        "int(case l_suppkey % 4 when 0 then 255 - l_partkey % 10 when 1 then l_orderkey % 45 else l_orderkey % 256 end) as g",
        "int(case l_suppkey % 4 when 0 then 255 - l_partkey % 11 when 1 then l_linenumber else (l_orderkey * 7 + l_linenumber) % 256 end) as b",
    )


@register(
    "pixel_saturation",
    f"with {PIXELS_SQL}, m as (select greatest(r, g, b) as hi, least(r, g, b) as lo from pixels) select s > 20 as tissue, count(*) as n, sum(s)::bigint as total from (select case when hi = 0 then 0 else ((hi - lo) * round_even(1044480.0::double / hi, 0)::bigint + 2048) >> 12 end as s from m) group by 1",
)
def pixel_saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8-bit saturation of pixels over a threshold (G5 for a pixel)."""
    s = pixels(spark, sf_dir).select(op.pixel_saturation("r", "g", "b").alias("s"))
    return s.groupBy((F.col("s") > 20).alias("tissue")).agg(F.count("*").alias("n"), F.sum("s").cast("long").alias("total"))


@register(
    "white_and_black_tiles",
    f"""with {PIXELS_SQL}, m as (select *, greatest(r, g, b) as hi, least(r, g, b) as lo from pixels), s as (select *, case when hi = 0 then 0 else ((hi - lo) * round_even(1044480.0::double / hi, 0)::bigint + 2048) >> 12 end as s from m)
select tile_index, avg(s) < 5 as white, avg(r) < 40 and avg(g) < 40 and avg(b) < 40 as black, count(*) filter (hi < 20) > 0.05 * count(*) as share_black, count(*) filter (lo > 220) > 0.2 * count(*) as share_white from s group by tile_index""",
)
def white_and_black_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles that are white or black, on average or by the share of their pixels."""
    return op.blank_tiles(pixels(spark, sf_dir))


@register("proposed_pixels", f"with {PIXELS_SQL} select tile_index, count(*) filter (greatest(r, g, b) < 245 or (case when greatest(r, g, b) = 0 then 0 else ((greatest(r, g, b) - least(r, g, b)) * round_even(1044480.0::double / greatest(r, g, b), 0)::bigint + 2048) >> 12 end) >= 5) as proposed, count(*) as n from pixels group by 1")
def proposed_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels that a thumbnail proposes as tissue (G14 without the closing)."""
    seen = (op.pixel_saturation("r", "g", "b") >= 5) | (F.greatest("r", "g", "b") < 245)
    return pixels(spark, sf_dir).groupBy("tile_index").agg(F.count_if(seen).alias("proposed"), F.count("*").alias("n"))


@register("artifact_free_pixels", "select l_suppkey as slide_id, count(*) filter (l_linenumber not in (2, 3, 4, 5, 6, 7)) as all_artifacts, count(*) filter (l_linenumber not in (4, 7)) as pen_marks, count(*) filter (l_linenumber not in (3)) as listed, case when count(*) filter (l_linenumber not in (2, 3, 4, 5, 6, 7)) <= 0.1 * count(*) then count(*) else count(*) filter (l_linenumber not in (2, 3, 4, 5, 6, 7)) end as survived from lineitem group by 1")
def artifact_free_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels left after artifact classes go, by how the set is chosen, with the fallback to all."""
    from tilewright.functions.slides import survives

    left = lambda **how: F.count_if(~F.col("l_linenumber").isin(*sorted(op.excluded_classes(**how))))
    held = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("slide_id")).agg(left(artifacts=True).alias("all_artifacts"), left(pen_marks=True).alias("pen_marks"), left(artifacts=True, listed=[3]).alias("listed"), F.count("*").alias("_n"))
    return held.withColumn("survived", survives(F.col("_n"), F.col("all_artifacts"))).drop("_n")


CONTOURS_SQL = "contours as (select s_suppkey as id, case when s_suppkey % 4 = 0 then -1 else s_suppkey - s_suppkey % 4 end as parent, case when s_suppkey % 4 = 0 then 150 + (s_suppkey * 37) % 500 else (s_suppkey * 53) % 120 end as area from supplier)"


def contours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "if(s_suppkey % 4 = 0, -1, s_suppkey - s_suppkey % 4) as parent", "if(s_suppkey % 4 = 0, 150 + (s_suppkey * 37) % 500, (s_suppkey * 53) % 120) as area")


@register("contour_filter", f"with {CONTOURS_SQL}, h as (select parent, sum(area) as holes, count(*) as n from contours where parent <> -1 group by 1) select id, (area - coalesce(holes, 0))::bigint as area, coalesce(n, 0) as holes from contours c left join h on h.parent = c.id where c.parent = -1 and area - coalesce(holes, 0) <> 0 and area - coalesce(holes, 0) > 200")
def contour_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines whose area without their holes is over a threshold."""
    return op.kept_contours(contours(spark, sf_dir), 200)


@register("largest_holes", f"with {CONTOURS_SQL}, r as (select *, row_number() over (partition by parent order by area desc, id) as r from contours where parent <> -1) select id, parent, area from r where r <= 2 and area > 50")
def largest_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two largest holes of each outline, if they are large enough."""
    return op.largest_holes(contours(spark, sf_dir), 2, 50)


@register("chosen_contours", "select s_suppkey as id, s_suppkey % 2 = 0 and s_suppkey % 6 <> 0 as kept, s_suppkey % 6 <> 0 as kept_of_all from supplier where s_suppkey % 6 <> 0")
def chosen_contours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contours that are listed without those that are excluded; an empty list means all."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    excluded, listed = s.where("id % 6 = 0"), s.where("id % 2 = 0")
    some, every = op.chosen_ids(s, listed, excluded), op.chosen_ids(s, s.limit(0), excluded)
    return every.join(some.withColumn("_s", F.lit(True)), "id", "left").select("id", F.coalesce("_s", F.lit(False)).alias("kept"), F.lit(True).alias("kept_of_all"))


@register("id_sets", "select coalesce(a.id, b.id) as id, a.id is not null and b.id is not null as both, b.id is null as only_first from (select distinct o_custkey as id from orders where o_orderkey % 2 = 0) a full join (select c_custkey as id from customer where c_custkey % 3 = 0) b on a.id = b.id where a.id is not null")
def id_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection and difference of two sets of ids (U4)."""
    a = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("id"))
    b = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"))
    of = lambda df, both: df.select("id", F.lit(both).alias("both"), F.lit(not both).alias("only_first"))
    return of(a.intersect(b), True).unionByName(of(a.subtract(b), False))


@register("scaled_contours", "select s_suppkey as id, p::int as point, trunc(x * 1.37::double)::int as x, trunc(y * 2.11::double)::int as y from (select s_suppkey, unnest([0, 1, 2, 3]) as p, unnest([s_suppkey * 3 - 40, s_suppkey * 5, s_suppkey * 7, s_suppkey]) as x, unnest([s_suppkey, s_suppkey * 2, s_suppkey - 55, s_suppkey * 4]) as y from supplier)")
def scaled_contours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of contours at another level, cut to whole pixels."""
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "transform(array(array(s_suppkey * 3 - 40, s_suppkey), array(s_suppkey * 5, s_suppkey * 2), array(s_suppkey * 7, s_suppkey - 55), array(s_suppkey, s_suppkey * 4)), p -> named_struct('x', p[0], 'y', p[1])) as points")
    return s.select("id", F.posexplode(op.scaled_points(F.col("points"), F.lit(1.37), F.lit(2.11))).alias("point", "p")).select("id", "point", "p.x", "p.y")


@register("grid_polygons", "select s_suppkey as id, corner::int as corner, s_suppkey * 10 + [0, 224, 224, 0][(corner + 1)::int] as x, s_suppkey * 7 + [0, 0, 224, 224][(corner + 1)::int] as y from supplier cross join (select unnest([0, 1, 2, 3]) as corner)")
def grid_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The square of each tile."""
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as id", "s_suppkey * 10 as x0", "s_suppkey * 7 as y0")
    return s.select("id", F.posexplode(op.square(F.col("x0"), F.col("y0"), F.lit(224))).alias("corner", "p")).select("id", "corner", "p.x", "p.y")


@register("mosaic_places", "select vec_id as tile, (vec_id % 10) * 64 as x, (vec_id // 10) * 64 as y from embeddings")
def mosaic_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each tile of a mosaic is pasted, row by row."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("tile"))
    return e.select("tile", *op.mosaic_place(F.col("tile"), 10, 256, 4))


@register("drawing_sizes", "with d as (select p_partkey, trunc((1000 + p_partkey * 3) / 2.0)::bigint as w, trunc((800 + p_partkey * 5) / 2.0)::bigint as h from part) select p_partkey, case when w > 1024 or h > 1024 then trunc(w * (1024::double / greatest(w, h))) else w end::bigint as width, case when w > 1024 or h > 1024 then trunc(h * (1024::double / greatest(w, h))) else h end::bigint as height from d")
def drawing_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of a drawing after a downsample and a limit on its longer side."""
    w, h = op.drawn_size(F.col("p_partkey") * 3 + 1000, F.col("p_partkey") * 5 + 800, F.lit(2.0), F.lit(1024))
    return table(spark, sf_dir, "part").select("p_partkey", w.alias("width"), h.alias("height"))


TILES_SQL = "tiles as (select distinct l_suppkey as slide_id, l_partkey * 448 as x, l_linenumber::bigint * 448 as y from lineitem)"


@register(
    "derived_tile_sets",
    f"with {TILES_SQL}, g as (select distinct slide_id, floor((x + 224.0) / 1024)::bigint as cx, floor((y + 224.0) / 1024)::bigint as cy from tiles) select slide_id, 1024::bigint as patch_size, 1024::bigint as step_size, 512 as target_px, n as derived_source_tiles, 448::bigint as derived_source_patch_size, count(*) as tiles from g join (select slide_id, count(*) as n from tiles group by 1) using (slide_id) group by slide_id, n",
)
def derived_tile_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of a coarser tile set that is made from a finer one."""
    from tilewright.plans.tile_queries import tiles

    t = tiles(spark, sf_dir)
    sets = t.select("slide_id").distinct().selectExpr("slide_id", "448L as patch_size", "448L as step_size", "224 as target_px", "0 as patch_level", "0.5D as mpp", "0.25D as native_mpp")
    made, _ = op.derived_sets(sets, t, 512)
    return made.select("slide_id", "patch_size", "step_size", "target_px", "derived_source_tiles", "derived_source_patch_size", "tiles")


@register(
    "mapped_class_areas",
    "with pixels as (select event_id % 100 as px, event_id // 100 % 100 as py, (event_id * 7 // 300) % 5 as raw from events), tiles as (select distinct l_suppkey as tile_index, l_partkey % 12 * 9 as x, l_suppkey % 12 * 9 as y from lineitem where l_linenumber = 1), m as (select unnest([1, 2, 3]) as raw, unnest([1, 1, 0]) as label) select tile_index, x, y, raw, label as annotation, count(*) as overlap_area, (least(x + 16, 100) - x) * (least(y + 16, 100) - y) as tile_area from tiles join pixels on px >= x and px < x + 16 and py >= y and py < y + 16 join m using (raw) where raw <> 0 group by tile_index, x, y, raw, label",
)
def mapped_class_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles against an annotation raster whose classes are mapped; classes without a label are left out, those with one label stay apart."""
    t = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").selectExpr("l_suppkey as tile_index", "l_partkey % 12 * 9 as x", "l_suppkey % 12 * 9 as y").distinct()
    mapping = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "raw long, label int")
    return op.mapped_areas(t, raster(spark, sf_dir), mapping, 16, 100, 100)
