"""Listings of slides and images in folders of any store that Spark reads; contents aren't read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilewright.functions.slides import IMAGE_SUFFIXES, SLIDE_SUFFIXES, slide_name


def listed(spark: SparkSession, folder: str, suffixes: list[str], nested: bool = False) -> DataFrame:
    """``(path, length)`` of the files below ``folder`` whose name ends in one of ``suffixes``, whatever its case; with ``nested`` in folders below it too."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(nested).lower()).load(folder).select("path", "length")
    low = F.lower("path")
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | low.endswith(suffix if suffix.startswith(".") else f".{suffix}")
    return files.where(wanted).distinct()


def slide_files(spark: SparkSession, folder: str, nested: bool = False, suffixes: list[str] = SLIDE_SUFFIXES) -> DataFrame:
    """``(path, slide_id)`` of the slides of a folder; two files with one id are an error."""
    found = listed(spark, folder, suffixes, nested).select("path", slide_name(F.col("path")).alias("slide_id"))
    twice = found.groupBy("slide_id").agg(F.count("*").alias("n")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError("several files have one id: " + ", ".join(r["slide_id"] for r in twice))
    return found


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, class, label)`` of the images of a folder. Images in folders of their own have that folder's name as class and its place in the
    order of names as label; images of a flat folder have no class and label 0. A folder without images is an error."""
    nested = listed(spark, folder, IMAGE_SUFFIXES, nested=True)
    root = folder.rstrip("/").rsplit("/", 1)[-1]
    held = nested.select("path", F.element_at(F.split("path", "/"), -2).alias("class"))
    if held.isEmpty():
        raise ValueError(f"no images in {folder}")
    classed = held.where(F.col("class") != root)
    if classed.isEmpty():
        return held.select("path", F.lit(None).cast("string").alias("class"), F.lit(0).alias("label"))
    names = classed.select("class").distinct()
    labels = names.withColumn("label", F.row_number().over(Window.orderBy("class")) - 1)  # folders, not files
    return classed.join(F.broadcast(labels), "class").select("path", "class", "label")
