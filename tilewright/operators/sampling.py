"""Seeded samples and splits; a group never straddles a split.

The default order is that of ``md5(seed:id)``, which SQL can reproduce. The functions that end in ``_numpy`` take the very rows that a numpy generator
of the same seed takes: the generator draws positions, which are joined with the rows' indices, so no row is gathered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def hash_order(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def capped(tiles: DataFrame, k: int, seed: int, per: str = "slide_id", key: str = "tile_index") -> DataFrame:
    """``k`` rows of each group at most, as hashed; a sampling operator, so the cap is its purpose."""
    w = Window.partitionBy(per).orderBy(hash_order(F.col(key), seed), key)
    return tiles.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def drawn_numpy(sizes: DataFrame, k: int, seed: int | None = None, per: str = "slide_id") -> DataFrame:
    """``(per, tile_index)`` of ``k`` of the ``size`` tiles of each group, or all of a group that has no more.

    With a seed each group draws by ``default_rng(seed).choice(size, k, replace=False)``; without one the seed is the CRC-32 of the group's name.
    """

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for group, size in zip(pdf["g"], pdf["size"]):
                rng = np.random.default_rng(zlib.crc32(str(group).encode()) if seed is None else seed)
                picked = np.arange(size) if size <= k else np.sort(rng.choice(size, k, replace=False))
                yield pd.DataFrame({"g": [group] * len(picked), "tile_index": picked})

    kind = sizes.schema[per].dataType.simpleString()
    return sizes.select(F.col(per).alias("g"), "size").mapInPandas(draw, f"g {kind}, tile_index long").withColumnRenamed("g", per)


def capped_numpy(tiles: DataFrame, k: int, seed: int | None = None, per: str = "slide_id") -> DataFrame:
    """The rows of ``tiles`` (indices from 0 without gaps in each group) that :func:`drawn_numpy` picks."""
    sizes = tiles.groupBy(per).agg(F.count("*").alias("size"))
    return tiles.join(drawn_numpy(sizes, k, seed, per), [per, "tile_index"], "left_semi")


def pooled_numpy(spark: SparkSession, sizes: list[int], most: int, strategy: str = "random", seed: int = 42) -> DataFrame:
    """``(slide, tile_index)`` that one seeded generator draws from the slides of a sample, in their order; all if they are no more than ``most``.

    ``random`` draws from all tiles, ``proportional`` by size with the rest from the last slide, ``equal`` the same number from each, the last
    also the remainder, none over its size. Only positions are drawn on the driver, ``most`` of them at most.
    """
    rng, total = np.random.default_rng(seed), sum(sizes)
    starts = np.r_[0, np.cumsum(sizes)]
    if strategy not in ("random", "proportional", "equal"):
        raise ValueError(f"unknown sampling strategy {strategy!r}")
    if total <= most:
        picked = np.arange(total)
    elif strategy == "random":
        picked = rng.choice(total, size=most, replace=False)
    else:
        quotas = quotas_of(sizes, most, strategy)
        if any(q > n for q, n in zip(quotas, sizes)):
            raise ValueError("the last slide has fewer tiles than are left to draw")
        picked = np.concatenate([rng.choice(np.arange(a, a + n), size=q, replace=False) for a, n, q in zip(starts, sizes, quotas)])
    picked = np.sort(picked)
    slide = np.searchsorted(starts, picked, "right") - 1
    return spark.createDataFrame(pd.DataFrame({"slide": slide.astype("int64"), "tile_index": (picked - starts[slide]).astype("int64")}), "slide long, tile_index long")


def quotas_of(sizes: list[int], most: int, strategy: str) -> list[int]:
    """Tiles of each slide of one sample, the last slide being the last of the list."""
    if strategy == "proportional":
        shares = [min(round(most * n / sum(sizes)), n) for n in sizes[:-1]]
        return [*shares, max(0, most - sum(shares))]
    base, rest = divmod(most, len(sizes))
    return [min(base + (rest if i == len(sizes) - 1 else 0), n) for i, n in enumerate(sizes)]


def proportional_quotas(sizes: DataFrame, most: int) -> DataFrame:
    """Adds ``quota``: shares of ``most`` by size, halves to even; the last slide takes what is left, 0 at least. All rows if they are no more than ``most``."""
    group = Window.partitionBy("sample_id")
    before = group.orderBy("slide_id").rowsBetween(Window.unboundedPreceding, -1)
    sized = sizes.withColumns({"total": F.sum("size").over(group), "last": F.max("slide_id").over(group)})
    sized = sized.withColumn("share", F.least(F.rint(F.lit(most) * F.col("size") / F.col("total")).cast("long"), F.col("size")))
    rest = F.greatest(F.lit(most) - F.coalesce(F.sum("share").over(before), F.lit(0)), F.lit(0))
    quota = F.when(F.col("total") <= most, F.col("size")).when(F.col("slide_id") == F.col("last"), rest).otherwise(F.col("share"))
    return sized.withColumn("quota", quota.cast("long")).drop("total", "last", "share")


def equal_quotas(sizes: DataFrame, most: int) -> DataFrame:
    """Adds ``quota``: an equal share, the last slide also the remainder, no more than a slide has."""
    group = Window.partitionBy("sample_id")
    sized = sizes.withColumns({"total": F.sum("size").over(group), "k": F.count("*").over(group), "last": F.max("slide_id").over(group)})
    share = F.expr(f"{most} div k") + F.when(F.col("slide_id") == F.col("last"), F.lit(most) % F.col("k")).otherwise(0)
    return sized.withColumn("quota", F.when(F.col("total") <= most, F.col("size")).otherwise(F.least(share, F.col("size"))).cast("long")).drop("total", "k", "last")


def group_split(groups: DataFrame, key: str, test: float, val: float, seed: int) -> DataFrame:
    """Adds ``split`` to distinct ``groups``: first test, then val, in hash order; each has one group at least.

    Groups are dealt by the first two digits of their hash, so ranks are counted in 256 parts and no task orders them all.
    """
    hashed = groups.withColumns({"_h": hash_order(F.col(key), seed)}).withColumn("_part", F.substring("_h", 1, 2))
    sums = hashed.groupBy("_part").agg(F.count("*").alias("_n"))
    below = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows
    bases = sums.select("_part", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_b"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    within = Window.partitionBy("_part").orderBy("_h", key)
    ranked = hashed.join(F.broadcast(bases), "_part").withColumn("_r", F.row_number().over(within) + F.col("_b"))
    n_test, n_val = F.greatest(F.lit(1), F.rint(F.col("_all") * test)), F.greatest(F.lit(1), F.rint(F.col("_all") * val))
    split = F.when(F.col("_r") <= n_test, "test").when(F.col("_r") <= n_test + n_val, "val").otherwise("train")
    return ranked.withColumn("split", split).drop("_h", "_part", "_b", "_all", "_r")


def group_split_numpy(groups: list, test: float, val: float, seed: int) -> dict:
    """The split of each of a list of groups, as ``RandomState(seed).permutation`` of the sorted groups deals them: test, val, train."""
    order = np.random.RandomState(seed).permutation(np.sort(np.array(groups)))
    n_test, n_val = max(1, int(round(len(order) * test))), max(1, int(round(len(order) * val)))
    names = ["test"] * n_test + ["val"] * n_val
    return {g: names[i] if i < len(names) else "train" for i, g in enumerate(order.tolist())}


def class_splits(rows: DataFrame, label: str, key: str, n_val: dict, n_test: dict, splits: int, seed: int, label_frac: float = 1.0) -> DataFrame:
    """``(fold, key, split)``: for each fold and class ``n_val`` rows, then ``n_test``, and of the rest the first ``ceil(rest * label_frac)`` in order of the key.

    Folds draw by hash. Rows of classes that aren't named, and train rows beyond the fraction, come back in no split.
    """
    folds = rows.sparkSession.range(splits).select(F.col("id").cast("int").alias("fold"))
    spread = rows.select(F.col(key), F.col(label)).crossJoin(F.broadcast(folds))  # a stated number of folds
    wanted = lambda sizes: F.coalesce(*[F.when(F.col(label) == c, F.lit(n)) for c, n in sizes.items()], F.lit(0))
    w = Window.partitionBy("fold", label)
    drawn = spread.withColumn("_r", F.row_number().over(w.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("fold").cast("string"), F.col(key).cast("string"))), key)))
    drawn = drawn.withColumn("split", F.when(F.col("_r") <= wanted(n_val), "val").when(F.col("_r") <= wanted(n_val) + wanted(n_test), "test").otherwise("train"))
    place = F.row_number().over(Window.partitionBy("fold", label, "split").orderBy(key))
    rest = F.count("*").over(Window.partitionBy("fold", label, "split"))
    drawn = drawn.withColumns({"_p": place, "_n": rest}).where((F.col("split") != "train") | (F.col("_p") <= F.ceil(F.col("_n") * label_frac)))
    return drawn.where(F.col(label).isin(*n_val)).select("fold", key, "split")


def bootstrap_interval(predictions: pd.DataFrame, replicates: int, seed: int) -> tuple[float, float]:
    """The 2.5 and 97.5 percentiles of the AUC of resamples of ``(y, p)``, as ``RandomState(seed).randint`` draws them.

    Resamples of one class don't count; NaN if none is left. A benchmark's predictions of one split, so a table of bounded size on the driver.
    """
    y, p = predictions["y"].to_numpy(), predictions["p"].to_numpy()
    rng, found = np.random.RandomState(seed), []
    for _ in range(replicates):
        at = rng.randint(0, len(y), len(y))
        if len(np.unique(y[at])) == 2:
            found.append(auc_of(y[at], p[at]))
    return (float(np.percentile(found, 2.5)), float(np.percentile(found, 97.5))) if found else (float("nan"), float("nan"))


def auc_of(y: np.ndarray, p: np.ndarray) -> float:
    """The AUC of a resample by mean ranks."""
    order = np.argsort(p, kind="stable")
    _, first, times = np.unique(p[order], return_index=True, return_counts=True)
    ranks = np.empty(len(p))
    ranks[order] = np.repeat(first + (times + 1) / 2, times)
    n = int(y.sum())
    return float((ranks[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n)))


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """``(label, weight)``: all rows over those of the class."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    return counts.select(label, (F.sum("n").over(Window.partitionBy()) / F.col("n")).alias("weight"))


def share(rows: DataFrame, key: str, part: float, seed: int) -> DataFrame:
    """``floor(n * part)`` of all rows, in hash order; a sampling operator. Ranks are counted by the first two digits of the hash."""
    hashed = rows.withColumn("_h", hash_order(F.col(key), seed)).withColumn("_part", F.substring("_h", 1, 2))
    sums = hashed.groupBy("_part").agg(F.count("*").alias("_n"))
    below = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows
    bases = sums.select("_part", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_b"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    ranked = hashed.join(F.broadcast(bases), "_part").withColumn("_r", F.row_number().over(Window.partitionBy("_part").orderBy("_h", key)) + F.col("_b"))
    return ranked.where(F.col("_r") <= F.floor(F.col("_all") * part)).drop("_h", "_part", "_b", "_all", "_r")


def selected(rows: DataFrame, split: str, column: str = "split") -> DataFrame:
    """The rows of one split; an empty split is an error."""
    part = rows.where(F.col(column) == split)
    if part.isEmpty():
        raise ValueError(f"no rows in split {split!r}")
    return part
