"""Commands that score, label and evaluate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import annotate as ann
from tilewright.operators import clustering as cl
from tilewright.operators import metrics as m
from tilewright.operators import probe as pr
from tilewright.operators import sampling as sm
from tilewright.operators import tiles as tl
from tilewright.operators.features import scaled_vectors


@dataclass(frozen=True)
class AnnotateConfig:
    classes: tuple[str, ...] = ()
    top_k: int | None = None


def annotate(features: DataFrame, class_embeddings: DataFrame, cfg: AnnotateConfig, adapter=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores of every tile and class, the best class of each tile, and the report groups.

    ``class_embeddings`` is ``(class_idx, class, class_embedding)``; its names must be those of the configuration, in order. ``adapter`` is a function of
    the vector column. Vectors of another width than the classes' are an error that asks for an adapter.
    """
    names = [r["class"] for r in class_embeddings.orderBy("class_idx").select("class").collect()]  # class names
    if list(cfg.classes) != names:
        raise ValueError(f"the class vectors are of {names}, not of {list(cfg.classes)}")
    held = features if adapter is None else features.withColumn("embedding", adapter(F.col("embedding").cast("array<double>")))
    widths = held.select(F.size("embedding").alias("n")).distinct().collect(), class_embeddings.select(F.size("class_embedding").alias("n")).distinct().collect()
    if {r["n"] for r in widths[0]} - {r["n"] for r in widths[1]}:
        raise ValueError("features and class vectors have different widths: an adapter is needed")
    scores = ann.class_scores(held, class_embeddings)
    return scores, ann.best_class(scores), ann.report_groups(scores, cfg.top_k)


def create_class_embeddings(spark: SparkSession, classes: list[str], encode: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """``(class_idx, class, class_embedding)`` of a text encoder, in the order of the names."""
    vectors = np.asarray(encode(classes), np.float64)
    return spark.createDataFrame([(i, c, v.tolist()) for i, (c, v) in enumerate(zip(classes, vectors, strict=True))], "class_idx int, class string, class_embedding array<double>")


def merge_annotation_features(features: DataFrame, raster: DataFrame, tile_size: int, width: int, height: int, mapping: dict[int, int] | None = None) -> DataFrame:
    """``(slide_id, tile_index, embedding, annotation, overlap_area, tile_area, tile_size)``: a row for each tile and raw class under it.

    ``raster`` is ``(px, py, raw)`` of one slide; without a mapping every class over 0 is its own label.
    """
    pairs = [(int(k), int(v)) for k, v in (mapping or {k: k for k in range(1, 256)}).items() if 0 < int(k) <= 255]
    table = features.sparkSession.createDataFrame(pairs, "raw long, label int")
    areas = tl.mapped_areas(features.select("tile_index", "x", "y"), raster, table, tile_size, width, height)
    held = areas.select("tile_index", "annotation", "overlap_area", "tile_area", F.lit(tile_size).alias("tile_size"))
    return features.select("slide_id", "tile_index", "embedding").join(held, "tile_index")


@dataclass(frozen=True)
class BenchmarkConfig:
    """What both benchmarks share: which tiles count, and what their label is."""

    annotation_percent_filter_threshold: float = 0.5
    positive_annotation_label: int = 2
    multiclass: bool = False
    random_state: int = 42


def labelled_tiles(annotated: DataFrame, cfg: BenchmarkConfig) -> DataFrame:
    """Tiles over the overlap threshold with their label ``y``."""
    held = m.annotated(annotated, cfg.annotation_percent_filter_threshold, cfg.multiclass)
    return held.withColumn("y", F.col("annotation").cast("int") if cfg.multiclass else (F.col("annotation") == cfg.positive_annotation_label).cast("int"))


@dataclass(frozen=True)
class ClusteringBenchmarkConfig(BenchmarkConfig):
    algorithms: tuple[str, ...] = ("kmeans", "hierarchical")
    n_clusters: int = 2
    dbscan_eps: float = 0.5
    dbscan_min_samples: int = 5


def clustering_benchmark(annotated: DataFrame, cfg: ClusteringBenchmarkConfig = ClusteringBenchmarkConfig()) -> dict[str, dict]:
    """Metrics of each algorithm on tiles and on slides; one that fails is left out, and none left is an error. ``annotated`` has ``tile_id``, ``slide_id`` and ``embedding``."""
    cl.check_algorithms(list(cfg.algorithms))
    rows = labelled_tiles(annotated, cfg)
    if rows.isEmpty():
        raise ValueError("no tiles remain after filtering")
    scaled = scaled_vectors(rows).select("tile_id", "slide_id", "y", F.col("scaled").alias("v")).cache()
    summary, failed = {}, {}
    for name in cfg.algorithms:
        try:
            labels = cl.fitted(name, scaled.select(F.col("tile_id").alias("id"), "v"), cfg.n_clusters, cfg.dbscan_eps, cfg.dbscan_min_samples, cfg.random_state)
            both = scaled.join(labels.withColumnRenamed("id", "tile_id"), "tile_id").select(F.col("tile_id").alias("id"), "slide_id", "v", F.col("y").alias("a"), F.col("cluster").alias("b")).cache()
            clean = sm.capped(both.where("b <> -1").withColumn("_g", F.lit(0)), m.SILHOUETTE_ROWS, cfg.random_state, "_g", "id")
            found = {"nmi": m.nmi(both).first()[0], "ari": m.ari(both).first()[0], "purity": m.purity(both).first()[0], "silhouette": m.silhouette(clean).first()[0]}
            found["n_noise"], found["n_clusters_found"] = both.agg(F.count_if(F.col("b") == -1), F.countDistinct(F.when(F.col("b") != -1, F.col("b")))).first()
            slides = m.slide_clusters(both)
            if slides.select("a").distinct().count() >= 2:
                found |= {"slide_nmi": m.nmi(slides).first()[0], "slide_ari": m.ari(slides).first()[0], "slide_purity": m.purity(slides).first()[0]}
            summary[name] = found
            both.unpersist()
        except Exception as problem:  # the other algorithms go on
            failed[name] = f"{type(problem).__name__}: {problem}"
    scaled.unpersist()
    if not summary:
        raise RuntimeError("no algorithm succeeded: " + "; ".join(f"{k}: {v}" for k, v in failed.items()))
    return summary


@dataclass(frozen=True)
class LinearProbeBenchmarkConfig(BenchmarkConfig):
    test_size: float = 0.2
    val_size: float = 0.1
    cv: int = 5
    C_values: tuple[float, ...] = (1e-05, 0.0001, 0.001, 0.01, 0.1, 1.0, 10.0)
    penalties: tuple[str, ...] = ("l2",)
    max_iter: int = 5000
    n_top_features: int = 20
    n_seeds: int = 5
    n_bootstrap: int = 1000


def split_metrics(rows: DataFrame) -> dict[str, float]:
    """Tile and slide metrics of ``rows(slide_id, y, probs)``; with more than two classes those of tiles only."""
    if len(rows.select(F.size("probs").alias("n")).first() or [0]) and rows.select(F.size("probs")).first()[0] > 2:
        each = rows.select("y", F.posexplode("probs").alias("class", "p"))
        picked = rows.select("y", (F.array_position("probs", F.array_max("probs")) - 1).cast("int").alias("y_pred"))
        return {"tile_f1": m.report_averages(picked).where("average = 'macro avg'").first()["f1"], "tile_auc_roc": m.macro_auc(each).first()[0]}
    binary = rows.select("slide_id", "y", F.get("probs", F.lit(1)).alias("p"))
    told = {}
    for name, held in (("tile", binary), ("slide", binary.groupBy("slide_id").agg(F.max("y").alias("y"), F.avg("p").alias("p")))):
        if name == "slide" and held.select("y").distinct().count() < 2:
            continue
        report = m.report_averages(held.select("y", (F.col("p") >= 0.5).cast("int").alias("y_pred")))
        told |= {f"{name}_f1": report.where("average = 'weighted avg'").first()["f1"], f"{name}_auc_roc": m.roc_auc(held).first()[0], f"{name}_average_precision": m.average_precision(held).first()[0]}
    return told


def summarised(runs: list[dict[str, float]]) -> dict[str, dict[str, float]]:
    """Mean and population deviation of each metric over the runs that have it; what isn't a number doesn't count."""
    out = {}
    for name in sorted({k for r in runs for k in r}):
        values = [r[name] for r in runs if name in r and r[name] is not None and not np.isnan(r[name])]
        out[name] = {"mean": float(np.mean(values)) if values else None, "std": float(np.std(values)) if values else None}
    return out


def linear_probe_benchmark(annotated: DataFrame, cfg: LinearProbeBenchmarkConfig = LinearProbeBenchmarkConfig()) -> dict:
    """Linear probe over several seeds: the first searches the grid over group folds, the others reuse its choice.

    Returns summaries by split, the chosen parameters, the interval of the test AUC by bootstrap, the confusion and the greatest coefficients of the first
    seed. Labels of several classes are mapped to 0, 1, ... in order. Slide ids and the predictions of a split are gathered, as a report needs them.
    """
    rows = labelled_tiles(annotated, cfg).select("slide_id", "y", "embedding").cache()
    names = [r["y"] for r in rows.select("y").distinct().orderBy("y").collect()]  # labels
    if cfg.multiclass:
        places = F.array(*map(F.lit, names))
        rows = rows.withColumn("y", (F.array_position(places, F.col("y")) - 1).cast("int"))
    slides = [r["slide_id"] for r in rows.select("slide_id").distinct().collect()]
    kind = rows.schema["slide_id"].dataType.simpleString()
    score = lambda held: m.macro_auc(held.select("y", F.posexplode("probs").alias("class", "p"))).first()[0] if cfg.multiclass else m.roc_auc(held.select("y", F.get("probs", F.lit(1)).alias("p"))).first()[0]
    chosen, first, val_runs, test_runs = None, {}, [], []
    for seed in range(cfg.random_state, cfg.random_state + cfg.n_seeds):
        split = rows.sparkSession.createDataFrame(list(sm.group_split_numpy(slides, cfg.test_size, cfg.val_size, seed).items()), f"slide_id {kind}, split string")
        dealt = rows.join(F.broadcast(split), "slide_id")
        train = sm.selected(dealt, "train")
        if chosen is None:
            fit, scores = pr.search_probe(train, score, list(cfg.C_values), list(cfg.penalties), cfg.cv)
            chosen = (fit.penalty, fit.strength)
        else:
            fit = pr.fit_probe(train, *chosen, max_iter=min(cfg.max_iter, 1000))
        told = fit.probabilities(dealt.where("split <> 'train'")).select("slide_id", "split", "y", "probs").cache()
        val_runs.append(split_metrics(told.where("split = 'val'")))
        test_runs.append(split_metrics(told.where("split = 'test'")))
        if not first:
            predicted = (F.array_position("probs", F.array_max("probs")) - 1).cast("int")
            first = {
                "cv_scores": scores, "confusion": m.confusion(told.where("split = 'test'").select("y", predicted.alias("y_pred"))).collect(),
                "importance": [tuple(r) for r in m.importance(fit.coefficients(), cfg.n_top_features).collect()],
            }
            if not cfg.multiclass:
                held = told.where("split = 'test'").select("y", F.get("probs", F.lit(1)).alias("p")).toPandas()
                first["test_auc_ci"] = sm.bootstrap_interval(held, cfg.n_bootstrap, cfg.random_state)
        told.unpersist()
    rows.unpersist()
    return {"labels": names, "penalty": chosen[0], "C": chosen[1], "val": summarised(val_runs), "test": summarised(test_runs), **first}


@dataclass(frozen=True)
class AbmilBenchmarkConfig:
    n_seeds: int = 3
    random_state: int = 42
    test_size: float = 0.2
    val_size: float = 0.1
    n_bootstrap: int = 1000
    training: pr.AttentionTraining = pr.AttentionTraining()


def abmil_benchmark(features: DataFrame, labels: DataFrame, cfg: AbmilBenchmarkConfig = AbmilBenchmarkConfig(), split_col: str | None = None) -> dict:
    """Attention models over the tiles of each slide, for several seeds: AUC of the test slides with its interval, and its mean and deviation.

    ``labels`` is ``(slide_id, y)`` and the split, if one is given. Slides without features don't count; a split may not be empty. A seed is trained in one task: the bags
    of a benchmark are sent to it whole.
    """
    import pandas as pd

    there = labels.join(features.select("slide_id").distinct(), "slide_id", "left_semi")
    slides = there.orderBy("slide_id").toPandas()  # a row a slide
    bags = features.select("slide_id", "tile_index", F.col("embedding").cast("array<double>").alias("embedding")).join(F.broadcast(there.select("slide_id")), "slide_id", "left_semi")
    y_of = dict(zip(slides["slide_id"], slides["y"]))
    plans = []
    for seed in range(cfg.random_state, cfg.random_state + cfg.n_seeds):
        split = dict(zip(slides["slide_id"], slides[split_col])) if split_col else sm.group_split_numpy(list(y_of), cfg.test_size, cfg.val_size, seed)
        if {*split.values()} != {"train", "val", "test"}:
            raise ValueError("a split is empty")
        plans += [(seed, split)]
    seeds = features.sparkSession.createDataFrame([(s,) for s, _ in plans], "seed int")
    held = dict(plans)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        seed = int(pdf["seed"].iloc[0])
        groups = {s: np.stack(g.sort_values("tile_index")["embedding"].to_list()) for s, g in pdf.groupby("slide_id")}
        part = lambda name: [s for s in sorted(groups, key=str) if held[seed][s] == name]
        how = pr.AttentionTraining(**{**cfg.training.__dict__, "seed": seed})
        fitted = pr.AttentionModel(next(iter(groups.values())).shape[1], how)
        fitted.fit([groups[s] for s in part("train")], [y_of[s] for s in part("train")], ([groups[s] for s in part("val")], [y_of[s] for s in part("val")]))
        rows = [(seed, held[seed][s], int(y_of[s]), fitted.forward(groups[s])[0]) for s in part("val") + part("test")]
        return pd.DataFrame(rows, columns=["seed", "split", "y", "p"])

    told = bags.crossJoin(F.broadcast(seeds)).groupBy("seed").applyInPandas(train, "seed int, split string, y int, p double").toPandas()
    runs = []
    for seed, _ in plans:
        test = told[(told["seed"] == seed) & (told["split"] == "test")]
        one = test["y"].nunique() < 2
        runs.append({"auc": float("nan") if one else sm.auc_of(test["y"].to_numpy(), test["p"].to_numpy()), "error": float(((test["p"] >= 0.5).astype(int) != test["y"]).mean())})
    first = told[(told["seed"] == cfg.random_state) & (told["split"] == "test")]
    return {"summary": summarised(runs), "auc_ci": sm.bootstrap_interval(first, cfg.n_bootstrap, cfg.random_state)}
