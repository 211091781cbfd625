"""Annotation queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import annotate as op
from tilewright.plans.catalog import register
from tilewright.plans.tables import table

#: One class vector for each label: that with the lowest vec_id.
CLASSES_SQL = """
classes as (
  select label as class_idx, 'class_' || label as class, arg_min(embedding, vec_id) as class_embedding
  from embeddings group by label),
scores as (
  select e.vec_id as tile_index, c.class_idx, c.class,
         list_cosine_similarity(e.embedding::double[], c.class_embedding::double[]) as score
  from embeddings e cross join classes c)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return op.class_scores(e.select(F.col("vec_id").alias("tile_index"), "embedding"), op.class_vectors(e))


@register(
    "annotate_tiles",
    f"""with {CLASSES_SQL}
select tile_index, arg_max(class, (score, -class_idx)) as class, round(max(score), 6) as score from scores group by tile_index""",
)
def annotate_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Argmax class of each tile with its score."""
    return op.best_class(scores(spark, sf_dir)).select("tile_index", "class", F.round("score", 6).alias("score"))
