"""What becomes of the slides of a batch: one that fails is noted and the others go on; one without tiles is skipped."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


class BatchError(RuntimeError):
    """Slides of a batch failed, or none had tiles."""


def slide_status(slides: DataFrame, tiles: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """``(slide_id, status, tiles, error)``: ``failed`` with an error, ``skipped`` without tiles, else ``ok``."""
    n = tiles.groupBy("slide_id").agg(F.count("*").alias("tiles"))
    told = slides.select("slide_id").join(n, "slide_id", "left")
    told = told.withColumn("error", F.lit(None).cast("string")) if errors is None else told.join(errors.groupBy("slide_id").agg(F.min("error").alias("error")), "slide_id", "left")
    status = F.when(F.col("error").isNotNull(), "failed").when(F.coalesce("tiles", F.lit(0)) == 0, "skipped").otherwise("ok")
    return told.select("slide_id", status.alias("status"), F.coalesce("tiles", F.lit(0)).alias("tiles"), "error")


def check_batch(status: DataFrame) -> None:
    """Raises if slides failed, naming up to ten of them, or if every slide was skipped; an empty batch passes."""
    counts = {r["status"]: r["count"] for r in status.groupBy("status").count().collect()}  # three rows
    if counts.get("failed"):
        some = status.where("status = 'failed'").select("slide_id", "error").limit(10).collect()
        raise BatchError(f"{counts['failed']} slides failed: " + "; ".join(f"{r['slide_id']}: {r['error']}" for r in some))
    if counts.get("skipped") and not counts.get("ok"):
        raise BatchError("no slide has tiles")


def each_slide(rasters: DataFrame, make: Callable[[dict], Iterator[dict]], columns: StructType) -> DataFrame:
    """Rows that ``make`` gives for each row of ``rasters``, with ``error``: a row that fails gives one row with its ``slide_id`` and the error only.

    ``columns`` must have ``slide_id``. What a failed row had given before is dropped.
    """
    names = columns.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                try:
                    made = [{**r, "error": None} for r in make(row)]
                except MemoryError:
                    raise
                except Exception as problem:  # the slide is noted, the batch goes on
                    made = [{"slide_id": row["slide_id"], "error": f"{type(problem).__name__}: {problem}"}]
                if made:
                    yield pd.DataFrame({n: pd.Series([r.get(n) for r in made], dtype=object) for n in [*names, "error"]})

    return rasters.mapInPandas(run, StructType([*columns, StructField("error", StringType())]))
