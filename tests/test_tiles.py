from pyspark.sql import functions as F

from tilewright.functions.slides import mpp_of
from tilewright.operators import metrics, sampling, tiles
from tilewright.operators.components import connected_components
from tilewright.workspace import Workspace


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lattice_of_a_box(spark):
    box = spark.createDataFrame([(1, 0, 0, 1000, 450)], "box_id long, x0 long, y0 long, x1 long, y1 long")
    got = rows(tiles.lattice(box, 224, 224))
    assert {x for _, x, _ in got} == {0, 224, 448, 672, 896} and {y for _, _, y in got} == {0, 224, 448}


def test_lattice_stays_inside_the_slide(spark):
    got = spark.range(1).select(F.explode(tiles.axis_origins(F.lit(0), F.lit(1000), 224, 224, F.lit(1000)))).collect()
    assert [r[0] for r in got] == [0, 224, 448, 672]
    assert spark.range(1).select(tiles.axis_origins(F.lit(0), F.lit(100), 224, 224, F.lit(100))).first()[0] == []


def test_derived_grid_case(spark):
    t = spark.createDataFrame([(1, x, y, 448) for x, y in [(0, 0), (448, 0), (896, 0), (0, 1344), (3000, 3000)]], "slide_id long, x long, y long, size int")
    assert rows(tiles.coarser(t, 1024)) == [(1, 0, 0), (1, 0, 1024), (1, 1024, 0), (1, 3072, 3072)]
    assert rows(tiles.coarser(t.limit(0), 1024)) == []


def test_two_raw_classes_give_two_rows(spark):
    pixels = spark.createDataFrame([(x, y, 1 if x < 4 else 2) for x in range(8) for y in range(8)], "px long, py long, raw int")
    tile = spark.createDataFrame([(0, 0, 0)], "tile_index long, x long, y long")
    assert rows(tiles.class_areas(tile, pixels, 8, 8, 8)) == [(0, 1, 32, 64), (0, 2, 32, 64)]


def joined_rows(df):
    """Rows that the joins of ``df`` made when it was last collected."""
    def walk(node):
        name = node.nodeName()
        inner = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else [node.children().apply(i) for i in range(node.children().size())]
        own = node.metrics().apply("numOutputRows").value() if "Join" in name else 0
        return own + sum(map(walk, inner))

    return walk(df._jdf.queryExecution().executedPlan())


def test_areas_of_many_tiles_and_pixels_at_one_place(spark):
    tile = spark.range(1000).selectExpr("id as tile_index", "8 * (id % 2) as x", "0L as y")
    pixels = spark.range(16 * 8 * 50).selectExpr("id % 16 as px", "id div 16 % 8 as py", "id div 128 % 2 as raw")
    again = tile.unionByName(tile.where("tile_index = 0"))
    areas = tiles.class_areas(again, pixels, 8, 16, 8)
    assert rows(areas) == [(i, 1, 64 * 25 * (1 + (i == 0)), 64) for i in range(1000)]
    assert joined_rows(areas) < 2000  # one for each tile, and for each pixel under a place; not 1,600 a tile
    mapping = spark.createDataFrame([(1, 4)], "raw long, label int")
    assert rows(tiles.mapped_areas(tile.where("tile_index < 2"), pixels, mapping, 8, 16, 8)) == [(i, 8 * i, 0, 1, 4, 1600, 64) for i in (0, 1)]


def test_mapped_areas_of_many_tiles_and_pixels_at_one_place(spark):
    tile = spark.range(1000).selectExpr("id as tile_index", "8 * (id % 2) as x", "0L as y")
    pixels = spark.range(16 * 8 * 50).selectExpr("id % 16 as px", "id div 16 % 8 as py", "id div 128 % 5 as raw")
    mapping = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "raw long, label int")
    areas = tiles.mapped_areas(tile, pixels, mapping, 8, 16, 8)
    assert rows(areas) == sorted((i, 8 * (i % 2), 0, raw, label, 640, 64) for i in range(1000) for raw, label in ((1, 1), (2, 1), (3, 0)))
    assert joined_rows(areas) < 15000  # the mapped pixels once, three rows a tile twice, and the pixels of each place; not 1,920 a tile


def test_quotas(spark):
    s = lambda *n: spark.createDataFrame([(0, i, k) for i, k in enumerate(n)], "sample_id long, slide_id long, size long")
    assert [r["quota"] for r in sampling.proportional_quotas(s(60, 40), 20).orderBy("slide_id").collect()] == [12, 8]
    assert [r["quota"] for r in sampling.equal_quotas(s(80, 40), 10).orderBy("slide_id").collect()] == [5, 5]
    assert [r["quota"] for r in sampling.equal_quotas(s(2, 40), 10).orderBy("slide_id").collect()] == [2, 5]
    assert [r["quota"] for r in sampling.equal_quotas(s(50), 100).collect()] == [50]


def test_metrics_on_small_cases(spark):
    same = spark.createDataFrame([(0, 0)] * 3 + [(1, 1)] * 3, "a int, b int")
    assert metrics.purity(same).first()[0] == 1.0 and abs(metrics.ari(same).first()[0] - 1) < 1e-12 and abs(metrics.nmi(same).first()[0] - 1) < 1e-12
    tie = spark.createDataFrame([(0, 1), (0, 0), (1, -1)], "slide_id int, label int")
    assert rows(metrics.majority(tie)) == [(0, 0), (1, -1)]
    ranks = metrics.rank_normalised(spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,)], "v double"), "v")
    assert [r["rank"] for r in ranks.orderBy("v").collect()] == [0.25, 0.625, 0.625, 1.0]
    perfect = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.9)], "y int, p double")
    assert metrics.roc_auc(perfect).first()[0] == 1.0 and metrics.average_precision(perfect).first()[0] == 1.0


def test_mpp_fallbacks(spark):
    cases = [({"aperio.MPP": "bad", "aperio.AppMag": "20"}, 0.5), ({"aperio.AppMag": "40"}, 0.25), ({"tiff.XResolution": "20000", "tiff.ResolutionUnit": "centimeter"}, 0.5), ({}, 0.5), ({"tiffslide.mpp-x": "0.3", "aperio.MPP": "9"}, 0.3)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "p map<string,string>")
    assert [r[0] for r in df.select(mpp_of(F.col("p"))).collect()] == [v for _, v in cases]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (200, 200), (None, 3)]
    got = dict(rows(connected_components(Workspace(spark, "t"), spark.createDataFrame(edges, "u long, v long"))))
    assert {got[i] for i in range(41)} == {0} and got[101] == 100 and got[200] == 200
    assert rows(connected_components(Workspace(spark, "t"), spark.createDataFrame([], "u long, v long"))) == []


def test_bounded_components_are_sound(spark):
    edges = [(50, i) for i in range(60) if i != 50] + [(i, i + 1) for i in range(100, 140)]
    got = dict(rows(connected_components(Workspace(spark, "t"), spark.createDataFrame(edges, "u long, v long"), most=2)))
    assert {got[i] for i in range(60)} == {0}  # two rounds join a star
    assert len(got) == 101 and all((n < 100) == (c < 100) for n, c in got.items())
