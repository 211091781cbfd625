"""Zero-shot annotation: cosine of every tile with every class vector, top tiles of a class, argmax class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.vectors import as_double, dot, norm

#: Class vectors of up to this many bytes are sent to every task.
CLASS_BYTES = 64 << 20
EPS = 1e-8


def class_vectors(labelled: DataFrame, label: str = "label", key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(class_idx, class, class_embedding)``: the vector with the least key of each label; only keys are grouped."""
    first = labelled.groupBy(F.col(label).alias("class_idx")).agg(F.min(key).alias(key))
    picked = labelled.select(key, vector).join(F.broadcast(first), key)  # one row a class
    return picked.select("class_idx", F.concat(F.lit("class_"), F.col("class_idx").cast("string")).alias("class"), F.col(vector).alias("class_embedding"))


def class_scores(tiles: DataFrame, classes: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(tile_index, *carry, class_idx, class, score)``: one row for each tile and class.

    ``classes`` is ``(class_idx, class, class_embedding)`` and is measured: up to :data:`CLASS_BYTES` it is sent to every task, else tiles are
    scored with one part of the classes at a time. Each side's lengths are computed once.
    """
    named = classes.select("class_idx", "class", as_double("class_embedding").alias("_c")).withColumn("_nc", F.greatest(norm(F.col("_c")), F.lit(EPS)))
    rows, width = named.agg(F.count("*"), F.max(F.size("_c"))).first()
    scored = tiles.select("tile_index", *carry, as_double("embedding").alias("_v")).withColumn("_nv", F.greatest(norm(F.col("_v")), F.lit(EPS)))
    parts = max(1, -(-rows * (width or 0) * 8 // CLASS_BYTES))
    out = None
    for k in range(parts):
        part = named if parts == 1 else named.where(F.pmod(F.xxhash64("class_idx"), F.lit(parts)) == k)
        met = scored.crossJoin(F.broadcast(part)).select("tile_index", *carry, "class_idx", "class", (dot(F.col("_v"), F.col("_c")) / (F.col("_nv") * F.col("_nc"))).alias("score"))
        out = met if out is None else out.unionByName(met)
    return out


def number(score: str = "score") -> Column:
    """A score, or null where it is NaN: such a score is no candidate for a best one."""
    return F.when(~F.isnan(score), F.col(score))


def top_tiles(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best tiles of each class, rank from 0; equal scores in tile order, NaN never."""
    order = Window.partitionBy("class_idx").orderBy(F.desc("score"), "tile_index")
    kept = scores.where(number().isNotNull()).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    return kept.withColumn("rank", (F.col("_r") - 1).cast("int")).drop("_r")


def best_class(scores: DataFrame, by: tuple[str, ...] = ("tile_index",)) -> DataFrame:
    """``(tile_index, class, score)`` of the best class; ties go to the first class, NaN scores to none."""
    best = F.max_by(F.struct("class", "score"), F.when(number().isNotNull(), F.struct("score", (-F.col("class_idx")).alias("o"))))
    return scores.groupBy(*by).agg(best.alias("b")).select(*by, "b.class", "b.score")


def in_classes(scores: DataFrame, wanted: list[str]) -> DataFrame:
    """``(tile_index)`` of the tiles whose best class is among ``wanted``."""
    return best_class(scores).where(F.col("class").isin(*wanted)).select("tile_index")


def report_groups(scores: DataFrame, k: int | None) -> DataFrame:
    """``(class, tile_indices)`` of a report: the best ``k`` tiles of each class, best first, or, without ``k``, the tiles of each best class in order.

    With ``k`` None a group is as long as its class: for reports on one slide.
    """
    if k is None:
        return best_class(scores).groupBy("class").agg(F.sort_array(F.collect_list("tile_index")).alias("tile_indices"))
    ranked = F.array_sort(F.collect_list(F.struct("rank", "tile_index")))  # k a class
    return top_tiles(scores, k).groupBy("class").agg(F.transform(ranked, lambda x: x["tile_index"]).alias("tile_indices"))


def wide_scores(scores: DataFrame, classes: list[str]) -> DataFrame:
    """One row a tile and one column a class, in the order of ``classes``."""
    return scores.groupBy("tile_index").agg(*[F.max(F.when(F.col("class") == c, F.col("score"))).alias(c) for c in classes])
