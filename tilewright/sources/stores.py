"""Where tile sets, features, scores and reports are kept: Parquet, CSV and JSON lines in any store that Spark writes to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.slides import finite_or_null


def append_features(features: DataFrame, folder: str, codec: str = "zstd") -> None:
    """Adds rows to a features table; batches of a run may come one after another."""
    features.write.mode("append").option("compression", codec).parquet(folder)


def write_attributes(attributes: DataFrame, folder: str) -> None:
    """The attributes of tile sets, written once: a later batch never changes them."""
    attributes.write.mode("ignore").parquet(folder)


def read_features(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """A features table, or some of its columns, which are then all that is read; vectors are single precision."""
    held = spark.read.parquet(folder)
    held = held.select(*columns) if columns else held
    return held.withColumn("embedding", F.col("embedding").cast("array<float>")) if "embedding" in held.columns else held


def without_features(features: DataFrame) -> DataFrame:
    """Tiles of a features table; their attributes are in a table of their own and stay."""
    return features.drop("embedding")


def feature_names(columns: list[str]) -> list[str]:
    """``feature_0``, ``feature_1``, ... of a wide table, by number."""
    return sorted((c for c in columns if c.startswith("feature_")), key=lambda c: int(c.removeprefix("feature_")))


def read_annotated(spark: SparkSession, folder: str) -> DataFrame:
    """Annotated features with one ``embedding`` in place of the columns ``feature_<k>``; outlines aren't read."""
    held = spark.read.parquet(folder)
    names = feature_names(held.columns)
    return held.select(*[c for c in held.columns if c not in names and c != "geometry"], F.array(*[F.col(n).cast("double") for n in names]).alias("embedding"))


def write_annotated(rows: DataFrame, width: int, folder: str) -> None:
    """The opposite of :func:`read_annotated` for vectors of ``width`` components."""
    wide = [F.get("embedding", F.lit(k)).alias(f"feature_{k}") for k in range(width)]
    rows.select(*wide, *[c for c in rows.columns if c != "embedding"]).write.mode("overwrite").parquet(folder)


def write_scores(scores: DataFrame, folder: str) -> None:
    scores.write.mode("overwrite").option("header", True).csv(folder)


def write_failures(status: DataFrame, folder: str) -> None:
    """Slides that failed, with their errors, separated by tabs."""
    status.where("status = 'failed'").select("slide_id", "error").write.mode("overwrite").option("header", True).option("sep", "\t").csv(folder)


def write_json(rows: DataFrame, folder: str) -> None:
    """JSON lines; numbers that JSON can't hold are null."""
    doubles = [f.name for f in rows.schema if f.dataType.typeName() in ("double", "float")]
    rows.withColumns({c: finite_or_null(F.col(c)) for c in doubles}).write.mode("overwrite").option("ignoreNullFields", False).json(folder)


def export_vectors(features: DataFrame, folder: str) -> int:
    """Vectors of all slides that have tiles, a folder a slide; the number of rows. An export of nothing is an error."""
    held = features.where("embedding is not null")
    n = held.count()
    if not n:
        raise ValueError("no slide has features, so nothing was written")
    held.write.mode("overwrite").partitionBy("slide_id").parquet(folder)
    return n
