import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.commands import analysis, commands, features, tiling
from tilewright.operators import batches, clustering, encoders, probe, registry
from tilewright.operators import features as feat
from tilewright.sources import files, stores
from tilewright.sources.images import read_png, write_png


def slide(spark, *rows):
    return spark.createDataFrame(list(rows), "slide_id string, width int, height int, mpp double, level_width int, level_height int, pixels binary")


def stained(h=80, w=100):
    rgb = np.full((h, w, 3), 245, np.uint8)
    rgb[10:60, 20:90] = (180, 60, 140)
    rgb[30:40, 40:60] = 245
    return rgb


def test_every_command_is_there():
    assert len(commands()) == 18 and all(map(callable, commands().values()))


def test_tessellate(spark):
    rgb = stained()
    blank = np.full((20, 20, 3), 255, np.uint8)
    df = slide(spark, ("a", 1000, 800, 0.5, 100, 80, rgb.tobytes()), ("b", 200, 200, 0.5, 20, 20, blank.tobytes()), ("c", 100, 100, 0.5, 10, 10, b"x"))
    cfg = tiling.SegConfig(patch_size=50, median_blur_ksize=3, tissue_area_threshold=1, hole_area_threshold=1)
    found, status = tiling.tessellate(df, cfg)
    assert {r["slide_id"]: r["status"] for r in status.collect()} == {"a": "ok", "b": "skipped", "c": "failed"}
    tiles = found.orderBy("tile_index").collect()
    assert [r["tile_index"] for r in tiles] == list(range(len(tiles))) and all(r["patch_size"] == 50 and r["tissue_share"] > 0 for r in tiles)
    assert (450, 300) not in {(r["x"], r["y"]) for r in tiles} and (200, 100) in {(r["x"], r["y"]) for r in tiles}
    with pytest.raises(batches.BatchError, match="c: "):
        tiling.tessellate(df, cfg, continue_on_error=False)
    several = tiling.SegConfig(patch_sizes=[50, 100], patch_mpps=[0.5, 0.5], median_blur_ksize=3, tissue_area_threshold=1, hole_area_threshold=1)
    both, _ = tiling.tessellate(df.where("slide_id = 'a'"), several)
    for size in (50, 100):
        single, _ = tiling.tessellate(df.where("slide_id = 'a'"), tiling.SegConfig(patch_size=size, median_blur_ksize=3, tissue_area_threshold=1, hole_area_threshold=1))
        want = sorted((r["x"], r["y"], r["tile_index"]) for r in single.collect())
        assert sorted((r["x"], r["y"], r["tile_index"]) for r in both.where(f"target_px = {size}").collect()) == want
    capped, _ = tiling.tessellate(df.where("slide_id = 'a'"), tiling.SegConfig(patch_size=50, median_blur_ksize=3, tissue_area_threshold=1, hole_area_threshold=1, max_tiles=5))
    at = np.sort(np.random.default_rng(42).choice(len(tiles), 5, replace=False))
    assert [(r["x"], r["y"]) for r in capped.orderBy("tile_index").collect()] == [(tiles[i]["x"], tiles[i]["y"]) for i in at]


def test_configurations_are_checked():
    for cfg in (dict(patch_sizes=[]), dict(patch_sizes=[224, 224]), dict(patch_sizes=[224, 512], step_size=100), dict(patch_sizes=[224, 512], patch_mpps=[0.5])):
        with pytest.raises(ValueError):
            tiling.SegConfig(**cfg).specs()
    with pytest.raises(ValueError):
        tiling.step_of(tiling.SegConfig(overlap=256), 256)
    assert tiling.native_size(224, 0.5, 0.25) == 448 and tiling.PRESETS["tcga"].segment_threshold == 8


def test_bounded_selection_of_a_slide(spark):
    df = slide(spark, ("a", 1000, 800, 0.5, 100, 80, stained().tobytes()))
    hooks = tiling.Hooks(accepts=lambda rgb, tiles, size: [rgb[y // 10 : (y + size) // 10, x // 10 : (x + size) // 10, 1].mean() < 100 for x, y in tiles])
    cfg = tiling.SegConfig(patch_size=100, selection_mode="bounded_neural", max_tiles=4, max_candidate_tiles=50)
    found, _ = tiling.tessellate(df, cfg, hooks)
    assert 0 < found.count() <= 4


def test_derived_grid(spark):
    sets = spark.createDataFrame([("s", 448, 448, 224, 0, 0.5, 0.25, "kept")], "slide_id string, patch_size long, step_size long, target_px int, patch_level int, mpp double, native_mpp double, name string")
    tiles = spark.createDataFrame([("s", 0, 0), ("s", 448, 448)], "slide_id string, x long, y long")
    made, cells = tiling.derive_tile_grid(sets, tiles, 512)
    r = made.first()
    assert (r["patch_size"], r["step_size"], r["target_px"], r["derived_source_tiles"], r["tiles"], r["name"]) == (1024, 1024, 512, 2, 1, "kept")
    assert [(c["x"], c["y"]) for c in cells.collect()] == [(0, 0)]
    for change in ({"patch_level": F.lit(1)}, {"target_px": F.lit(1024)}, {"native_mpp": F.lit(0.0)}):
        with pytest.raises(Exception):
            tiling.derive_tile_grid(sets.withColumns(change), tiles, 512)[0].collect()


def test_export_and_cache(spark):
    image = lambda v: np.full((4, 4, 3), v, np.uint8).tobytes()
    rows = [("s", 0, 0, 0, 4, 4, image(250)), ("s", 1, 4, 0, 4, 4, image(3)), ("s", 2, 8, 4, 4, 4, stained(4, 4).tobytes()), ("s", 3, 12, 0, 4, 4, None), ("s", 4, 16, 0, 4, 4, np.dstack([np.full((4, 4), v, np.uint8) for v in (200, 90, 90)]).tobytes())]
    images = spark.createDataFrame(rows, "slide_id string, tile_index long, x long, y long, width int, height int, pixels binary")
    got = tiling.export_tiles(images).collect()
    assert {r["name"] for r in got} == {"16_0.png"} and read_png(bytes(got[0]["png"])).shape == (4, 4, 3)
    kept, indices = tiling.cache_tiles(images)
    assert indices.first()["tile_indices"] == [0, 1, 2, 4]
    scores = spark.createDataFrame([(t, c, f"c{c}", float(t == c)) for t in range(5) for c in range(5)], "tile_index long, class_idx int, class string, score double")
    assert tiling.cache_tiles(images, scores, ["c2", "c3"])[1].first()["tile_indices"] == [2]


def test_features_and_aggregation(spark):
    encoders.register_encoder("mean-colour", lambda: lambda images: np.stack([i.reshape(-1, 3).mean(axis=0) for i in images]))
    encoders.register_encoder("slide-sum", lambda: lambda x, places: x.sum(axis=0) + places.sum())
    rows = [("s", i, i, 0, 2, 2, bytes([i] * 12)) for i in range(5)] + [("s", 5, 5, 0, 2, 2, b"short"), ("t", 0, 0, 0, 2, 2, bytes([9] * 12))]
    images = spark.createDataFrame(rows, "slide_id string, tile_index long, x long, y long, width int, height int, pixels binary")
    found = features.extract_features(images, features.ExtractFeaturesConfig(model_types=("mean-colour",)))
    assert found.count() == 6
    pooled, status = features.aggregate_slide_features(found, features.AggregateSlideFeaturesConfig("mean"), spark.createDataFrame([("s",), ("t",), ("u",)], "slide_id string"))
    assert {r["slide_id"]: r["embedding"][0] for r in pooled.collect()} == {"s": 2.0, "t": 9.0}
    assert {r["slide_id"]: r["status"] for r in status.collect()}["u"] == "skipped"
    slides, _ = features.aggregate_slide_features(found, features.AggregateSlideFeaturesConfig(slide_model_type="slide-sum"))
    assert {r["slide_id"]: r["embedding"][0] for r in slides.collect()}["s"] == 20.0
    with pytest.raises(batches.BatchError):
        features.aggregate_slide_features(found.limit(0), features.AggregateSlideFeaturesConfig("max"), spark.createDataFrame([("s",)], "slide_id string"))
    with pytest.raises(ValueError):
        features.extract_features(images, features.ExtractFeaturesConfig(model_types=("nothing",)))
    assert features.filter_features(found, [1.0, 0, 0], -3.0, features.FilterFeaturesConfig(0.5)).count() == 2
    assert encoders.quantised(np.array([1.00390625, 1.01171875, np.inf], np.float32), "bfloat16").tolist() == [1.0, 1.015625, np.inf]


def test_samples(spark):
    f = spark.range(35).selectExpr("if(id < 20, 'a', 'b') as slide_id", "if(id < 20, id, id - 20) as tile_index", "array(double(id)) as embedding")
    slides = spark.createDataFrame([("a", "p", 0), ("b", "p", 1), ("c", "p", 2)], "slide_id string, sample_id string, slide_order int")
    whole = features.aggregate_sample_features(f, slides).orderBy("sample_index").collect()
    assert [r["sample_index"] for r in whole] == list(range(35)) and [r["slide_id"] for r in whole] == ["a"] * 20 + ["b"] * 15
    some = features.aggregate_sample_features(f, slides, features.AggregateSampleFeaturesConfig(10, "equal")).collect()
    assert sorted(r["slide_id"] for r in some) == ["a"] * 5 + ["b"] * 5
    with pytest.raises(ValueError):
        features.aggregate_sample_features(f.limit(0), slides)


def test_annotate(spark):
    classes = analysis.create_class_embeddings(spark, ["x", "y"], lambda names: [[1.0, 0.0], [0.0, 1.0]])
    f = spark.createDataFrame([(0, [1.0, 0.1]), (1, [0.1, 1.0]), (2, [float("nan"), 1.0])], "tile_index long, embedding array<double>")
    scores, best, groups = analysis.annotate(f, classes, analysis.AnnotateConfig(("x", "y"), 2))
    assert {r["tile_index"]: r["class"] for r in best.collect()} == {0: "x", 1: "y", 2: None}
    assert {r["class"]: r["tile_indices"] for r in groups.collect()} == {"x": [0, 1], "y": [1, 0]}
    for names in (("y", "x"), ("x",)):
        with pytest.raises(ValueError):
            analysis.annotate(f, classes, analysis.AnnotateConfig(names))
    with pytest.raises(ValueError, match="adapter"):
        analysis.annotate(f.withColumn("embedding", F.array(F.lit(1.0))), classes, analysis.AnnotateConfig(("x", "y")))


def test_merge(spark):
    f = spark.createDataFrame([("s", i, i * 8, 0, [float(i)]) for i in range(3)], "slide_id string, tile_index long, x long, y long, embedding array<double>")
    raster = spark.createDataFrame([(x, y, 1 if x < 4 else 2 if x < 10 else 5) for x in range(20) for y in range(8)], "px long, py long, raw long")
    got = sorted((r["tile_index"], r["annotation"], r["overlap_area"], r["tile_area"]) for r in analysis.merge_annotation_features(f, raster, 8, 20, 8, {1: 1, 2: 1}).collect())
    assert got == [(0, 1, 32, 64), (0, 1, 32, 64), (1, 1, 16, 64)]
    assert analysis.merge_annotation_features(f, raster, 8, 20, 8).where("annotation = 5").count() == 2


def annotated(spark, slides=20, tiles=10):
    rng = np.random.default_rng(0)
    rows = []
    for s in range(slides):
        y = 2 if s < slides // 2 else 1
        for t in range(tiles):
            rows.append((s * 100 + t, f"s{s}", y, 0.8, 1.0, (rng.standard_normal(8) + 2.0 * (y == 2)).tolist()))
    rows.append((9999, "s0", 2, 0.4, 1.0, [0.0] * 8))
    return spark.createDataFrame(rows, "tile_id long, slide_id string, annotation int, overlap_area double, tile_area double, embedding array<double>")


def test_clustering_benchmark(spark):
    got = analysis.clustering_benchmark(annotated(spark), analysis.ClusteringBenchmarkConfig(algorithms=("kmeans", "hierarchical", "dbscan"), dbscan_eps=2.5, dbscan_min_samples=3))
    assert got["kmeans"]["purity"] > 0.9 and got["hierarchical"]["purity"] > 0.8 and got["kmeans"]["slide_purity"] == 1.0
    assert {"dbscan", "kmeans", "hierarchical"} == {*got} and got["kmeans"]["n_clusters_found"] == 2
    with pytest.raises(ValueError, match="nothing"):
        analysis.clustering_benchmark(annotated(spark), analysis.ClusteringBenchmarkConfig(algorithms=("nothing",)))


def test_dbscan_and_ward(spark):
    x = [0.0, 0.1, 0.2, 5.0, 5.1, 5.2, 9.0, 0.35]
    rows = spark.createDataFrame([(i, [v]) for i, v in enumerate(x)], "id long, v array<double>")
    assert {r["id"]: r["cluster"] for r in clustering.dbscan(rows, 0.16, 3).collect()} == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: -1, 7: 0}
    rng = np.random.default_rng(3)
    points = rng.standard_normal((24, 2))
    groups = [[i] for i in range(24)]
    while len(groups) > 4:  # merge what adds least
        cost = lambda a, b: len(a) * len(b) / (len(a) + len(b)) * ((points[a].mean(0) - points[b].mean(0)) ** 2).sum()
        i, j = min(((i, j) for i in range(len(groups)) for j in range(i)), key=lambda ij: cost(groups[ij[0]], groups[ij[1]]))
        groups[j] += groups.pop(i)
    labels = clustering.ward_labels(points, 4)
    assert {frozenset(np.flatnonzero(labels == k).tolist()) for k in range(4)} == {frozenset(g) for g in groups}


def test_linear_probe(spark):
    cfg = analysis.LinearProbeBenchmarkConfig(n_seeds=2, cv=3, C_values=(0.01, 1.0), n_bootstrap=20)
    got = analysis.linear_probe_benchmark(annotated(spark), cfg)
    assert got["test"]["tile_auc_roc"]["mean"] > 0.9 and got["C"] in (0.01, 1.0) and len(got["importance"]) == 8
    assert got["test_auc_ci"][0] <= got["test_auc_ci"][1] or math.isnan(got["test_auc_ci"][0])
    folds = probe.group_folds(analysis.labelled_tiles(annotated(spark), cfg), "slide_id", "y", 5)
    assert len(folds) == 20 and sorted({*folds.values()}) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        probe.search_probe(annotated(spark), None, [1.0], ["elasticnet"], 2)


def test_attention_models(spark):
    how = probe.AttentionTraining(hidden=3, heads=2, gated=True, seed=1)
    model = probe.AttentionModel(4, how)
    x = np.random.default_rng(1).standard_normal((5, 4))
    loss, grads = model.gradients(x, 1.0)
    for k in model.p:
        flat = model.p[k].reshape(-1)
        for i in range(0, flat.size, 5):
            kept = flat[i]
            flat[i] = kept + 1e-6
            up = model.gradients(x, 1.0)[0]
            flat[i] = kept
            assert abs((up - loss) / 1e-6 - grads[k].reshape(-1)[i]) < 1e-4
    rng = np.random.default_rng(2)
    rows = [(f"s{s}", t, (rng.standard_normal(4) + 1.5 * (s % 2)).tolist()) for s in range(20) for t in range(6)]
    f = spark.createDataFrame(rows, "slide_id string, tile_index long, embedding array<double>")
    labels = spark.createDataFrame([(f"s{s}", s % 2) for s in range(25)], "slide_id string, y int")
    got = analysis.abmil_benchmark(f, labels, analysis.AbmilBenchmarkConfig(n_seeds=2, n_bootstrap=10, training=probe.AttentionTraining(hidden=4, epochs=15, rate=0.01)))
    assert got["summary"]["error"]["mean"] < 0.4
    with pytest.raises(ValueError, match="empty"):
        analysis.abmil_benchmark(f, labels.withColumn("split", F.lit("train")), split_col="split")


def test_registry(spark):
    assert registry.resolved_patch_encoder("clip", "titan_slide") == "conch1_5" and registry.resolved_aggregation("identity", "titan_slide") == "model"
    for call in (lambda: registry.required_patch_encoder("abmil_slide"), lambda: registry.required_patch_encoder("clip"), lambda: registry.resolved_patch_encoder(None, "abmil_slide")):
        with pytest.raises(ValueError):
            call()
    sets = spark.createDataFrame([("clip", 256, 0.5)], "code string, px int, mpp double")
    assert "224 px" in registry.checked_tiles(sets, registry.encoders(spark)).first()["problem"]
    with pytest.raises(Exception):
        registry.checked_tiles(sets, registry.encoders(spark), "error").collect()


def test_stores_and_folders(spark, tmp_path):
    rows = spark.createDataFrame([("s", 1, [0.5, 2.0])], "slide_id string, annotation int, embedding array<double>")
    stores.write_annotated(rows, 2, str(tmp_path / "a"))
    assert stores.read_annotated(spark, str(tmp_path / "a")).first()["embedding"] == [0.5, 2.0]
    assert stores.feature_names(["feature_10", "feature_2", "x"]) == ["feature_2", "feature_10"]
    for _ in range(2):
        stores.append_features(rows, str(tmp_path / "f"))
    held = stores.read_features(spark, str(tmp_path / "f"))
    assert held.count() == 2 and "embedding" not in stores.without_features(held).columns
    with pytest.raises(ValueError):
        stores.export_vectors(rows.limit(0), str(tmp_path / "v"))
    assert stores.export_vectors(rows, str(tmp_path / "v")) == 1
    for name in ("a.SVS", "b.txt", "c.ndpi"):
        (tmp_path / "w").mkdir(exist_ok=True)
        (tmp_path / "w" / name).write_bytes(b"x")
    assert sorted(r["slide_id"] for r in files.slide_files(spark, str(tmp_path / "w")).collect()) == ["a", "c"]
    (tmp_path / "w" / "a.tif").write_bytes(b"x")
    with pytest.raises(ValueError, match="a"):
        files.slide_files(spark, str(tmp_path / "w"))
    for folder in ("cats", "dogs"):
        (tmp_path / "i" / folder).mkdir(parents=True)
        (tmp_path / "i" / folder / "1.png").write_bytes(write_png(np.zeros((1, 1, 3), np.uint8)))
    assert sorted((r["class"], r["label"]) for r in files.image_files(spark, str(tmp_path / "i")).collect()) == [("cats", 0), ("dogs", 1)]
    assert feat.alibi_slopes(6) == [0.25, 0.0625, 0.015625, 0.00390625, 0.5, 0.125]
