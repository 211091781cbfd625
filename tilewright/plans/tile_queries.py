"""Tile-grid queries. ``lineitem`` is a big tile set: slide = supplier, x = part * 448, y = line * 448."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import tiles as op
from tilewright.plans.catalog import register
from tilewright.plans.tables import table

TILES_SQL = "tiles as (select distinct l_suppkey as slide_id, l_partkey * 448 as x, l_linenumber::bigint * 448 as y from lineitem)"


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("slide_id"), (F.col("l_partkey") * 448).alias("x"), (F.col("l_linenumber").cast("long") * 448).alias("y"))
    return t.distinct()


BOXES_SQL = "boxes as (select s_suppkey as box_id, (s_suppkey * 37) % 900 as x0, (s_suppkey * 53) % 700 as y0, (s_suppkey * 37) % 900 + 100 + s_suppkey % 900 as x1, (s_suppkey * 53) % 700 + 1 + s_suppkey % 500 as y1 from supplier)"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as box_id", "(s_suppkey * 37) % 900 as x0", "(s_suppkey * 53) % 700 as y0", "(s_suppkey * 37) % 900 + 100 + s_suppkey % 900 as x1", "(s_suppkey * 53) % 700 + 1 + s_suppkey % 500 as y1"
    )


def _axis(lo: str, hi: str) -> str:
    return f"range(greatest(0, (floor(({lo} - 224) / 200.0) + 1) * 200)::bigint, {hi}::bigint, 200)"


@register("tile_lattice", f"with {BOXES_SQL}, xs as (select *, unnest({_axis('x0', 'x1')}) as x from boxes) select box_id, x, unnest({_axis('y0', 'y1')}) as y from xs")
def tile_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate tiles of each box (G1, G2, G3 and J4 for boxes)."""
    return op.lattice(boxes(spark, sf_dir), 224, 200)


@register("far_edge_origins", f"with {BOXES_SQL} select box_id, unnest(case when x1 <= 224 then [0] else list_distinct(list_append(range(0, x1 - 224 + 1, 200), x1 - 224)) end)::bigint as origin from boxes")
def far_edge_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Origins that reach the far edge."""
    return boxes(spark, sf_dir).select("box_id", F.explode(op.far_edge_origins(F.col("x1"), 224, 200)).alias("origin"))


@register("tile_index", f"with {TILES_SQL} select slide_id, x, y, row_number() over (partition by slide_id order by x, y) - 1 as tile_index from tiles")
def tile_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice order within each slide."""
    return op.indexed(tiles(spark, sf_dir))


@register("first_tiles", f"with {TILES_SQL} select * from (select slide_id, x, y, row_number() over (partition by slide_id order by x, y) - 1 as tile_index from tiles) where tile_index < 32")
def first_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 tiles of each slide."""
    return op.indexed(tiles(spark, sf_dir)).where("tile_index < 32")


@register("tile_batches", f"with {TILES_SQL} select slide_id, (row_number() over (partition by slide_id order by x, y) - 1) // 64 as batch, x, y from tiles")
def tile_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that never mix slides."""
    return op.indexed(tiles(spark, sf_dir)).select("slide_id", F.expr("tile_index div 64").alias("batch"), "x", "y")


@register("derived_grid", f"with {TILES_SQL} select distinct slide_id, (floor((x + 224.0) / 1024) * 1024)::bigint as x, (floor((y + 224.0) / 1024) * 1024)::bigint as y from tiles")
def derived_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarser cells that hold a source tile's centre."""
    return op.coarser(tiles(spark, sf_dir).withColumn("size", F.lit(448)), 1024)


@register("native_size", "select p_partkey, round_even(256 * 0.5 / (0.2 + (p_partkey % 7) * 0.04), 0)::bigint as native from part")
def native_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level-0 size of a tile, halves to even."""
    return table(spark, sf_dir, "part").select("p_partkey", op.native_size(F.lit(256), F.lit(0.5), F.lit(0.2) + (F.col("p_partkey") % 7) * 0.04).alias("native"))


@register("tile_limit_to_indices", f"with {TILES_SQL}, t as (select *, row_number() over (partition by slide_id order by x, y) - 1 as tile_index from tiles) select slide_id, tile_index, x, y from t where tile_index in (select n_nationkey from nation)")
def tile_limit_to_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile scan limited to an index list."""
    wanted = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("tile_index"))
    return op.indexed(tiles(spark, sf_dir)).join(wanted, "tile_index", "left_semi").select("slide_id", "tile_index", "x", "y")


# A raster whose pixels are events, and tiles on it that are suppliers.
PIXELS_SQL = "pixels as (select event_id % 100 as px, event_id // 100 % 100 as py, (event_id * 7 // 300) % 5 as raw from events), grid as (select s_suppkey as tile_index, (s_suppkey % 12) * 9 as x, (s_suppkey // 12 % 12) * 9 as y from supplier)"


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id % 100 as px", "event_id div 100 % 100 as py", "(event_id * 7 div 300) % 5 as raw")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey as tile_index", "(s_suppkey % 12) * 9 as x", "(s_suppkey div 12 % 12) * 9 as y")


@register(
    "raster_class_areas",
    f"with {PIXELS_SQL} select tile_index, raw, count(*) as overlap_area, (least(x + 16, 100) - x) * (least(y + 16, 100) - y) as tile_area from grid join pixels on px >= x and px < x + 16 and py >= y and py < y + 16 where raw <> 0 group by tile_index, x, y, raw",
)
def raster_class_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of each raw class under each tile."""
    return op.class_areas(grid(spark, sf_dir), raster(spark, sf_dir), 16, 100, 100)


@register(
    "otsu_threshold",
    """with h as (select (event_id * event_id % 211)::int as value, count(*) as n from events group by 1),
r as (select value, sum(n) over (order by value) as w0, sum(n * value) over (order by value) as s0, sum(n) over () as w, sum(n * value) over () as s from h)
select arg_max(value, (round((w0 * (w - w0) * pow(s0 / w0 - (s - s0) / (w - w0), 2))::double, 3), -value)) as threshold from r where w0 < w""",
)
def otsu_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold of a histogram by variance between classes."""
    h = table(spark, sf_dir, "events").groupBy(F.expr("cast(event_id * event_id % 211 as int)").alias("value")).agg(F.count("*").alias("n"))
    return op.otsu(h)


@register("duplicate_ids", "select c_nationkey as slide_id, count(*) as n from customer group by 1 having count(*) > 1")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that occur more than once."""
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("slide_id")).agg(F.count("*").alias("n")).where("n > 1")


@register("missing_slides", "select c_custkey as slide_id, case when n is null then 'skipped' else 'ok' end as status, coalesce(n, 0) as tiles from customer left join (select o_custkey, count(*) as n from orders group by 1) on o_custkey = c_custkey")
def missing_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slides joined with the number of their tiles."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("slide_id")).agg(F.count("*").alias("n"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("slide_id"))
    return c.join(n, "slide_id", "left").select("slide_id", F.when(F.col("n").isNull(), "skipped").otherwise("ok").alias("status"), F.coalesce("n", F.lit(0)).alias("tiles"))


@register("candidates_left", "select c_custkey as tile from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def candidates_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that were not proposed yet."""
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(F.col("c_custkey").alias("tile"))


@register("slides_present", "select count(*) as n, sum(l_quantity)::bigint as area from lineitem where l_suppkey in (select s_suppkey from supplier where s_acctbal > 0)")
def slides_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of the slides that are there."""
    there = table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    return table(spark, sf_dir, "lineitem").join(there, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("area"))


@register("overlap_binary_label", "select l_orderkey, l_linenumber, (l_returnflag = 'R')::int as y from lineitem where l_quantity > 0.5 * 50")
def overlap_binary_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles over the overlap threshold with a binary label."""
    return table(spark, sf_dir, "lineitem").where(F.col("l_quantity") > 0.5 * 50).select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("y"))


@register("stage_timings", "select event_type as stage, count(*) as calls, round(sum(value), 3) as seconds from events group by 1")
def stage_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters by stage."""
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("stage")).agg(F.count("*").alias("calls"), F.round(F.sum("value"), 3).alias("seconds"))


@register("score_heatmap", f"with {PIXELS_SQL}, cells as (select tile_index, unnest(range(x // 4, (x + 15) // 4 + 1)) as cx, y from grid), c2 as (select tile_index, cx, unnest(range(y // 4, (y + 15) // 4 + 1)) as cy from cells) select cx, cy, round(avg((tile_index * 31 % 97) / 97.0), 6) as score from c2 group by 1, 2")
def score_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean score of the tiles over each cell."""
    held = grid(spark, sf_dir).select("tile_index", "y", F.explode(F.expr("sequence(x div 4, (x + 15) div 4)")).alias("cx"))
    cells = held.select("tile_index", "cx", F.explode(F.expr("sequence(y div 4, (y + 15) div 4)")).alias("cy"))
    return cells.groupBy("cx", "cy").agg(F.round(F.avg(F.col("tile_index") * 31 % 97 / 97.0), 6).alias("score"))
