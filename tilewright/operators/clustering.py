"""Clusterings of scaled vectors: k-means, Ward's hierarchical clustering, DBSCAN. Input is ``(id, v)``, output ``(id, cluster)``, -1 for noise."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.functions.vectors import as_double
from tilewright.operators.components import connected_components
from tilewright.workspace import Workspace

ALGORITHMS = ("kmeans", "hierarchical", "dbscan")
#: Rows that Ward's method takes: it holds all distances of them on the driver.
WARD_ROWS = 10_000


def check_algorithms(names: list[str]) -> None:
    """Fails, before any work, on a name that is no algorithm."""
    unknown = [n for n in names if n not in ALGORITHMS]
    if unknown:
        raise ValueError(f"unknown algorithm {unknown[0]!r}; there are {', '.join(ALGORITHMS)}")


def kmeans(rows: DataFrame, k: int, seed: int, starts: int = 10) -> DataFrame:
    """The best of ``starts`` seeded fits by the sum of squared distances."""
    held = rows.select("id", array_to_vector(as_double("v")).alias("features"))
    fits = [KMeans(k=k, seed=seed + i, maxIter=300, tol=1e-4).fit(held) for i in range(starts)]
    best = min(fits, key=lambda f: f.summary.trainingCost)
    return best.transform(held).select("id", F.col("prediction").alias("cluster"))


def ward_labels(x: np.ndarray, k: int) -> np.ndarray:
    """``k`` clusters by merging the pair whose union adds the least squared distance; labels by first row."""
    n = len(x)
    if not 1 <= k <= max(n, 1):
        raise ValueError("there must be as many rows as clusters")
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2) if n * n * x.shape[1] <= 1 << 26 else np.maximum((x**2).sum(1)[:, None] + (x**2).sum(1)[None] - 2 * x @ x.T, 0)
    np.fill_diagonal(d, np.inf)
    size, alive, merges, chain = np.ones(n), np.ones(n, bool), [], []
    while len(merges) < n - 1:  # chains of nearest neighbours end in a pair that is each other's nearest
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        a = chain[-1]
        b = int(d[a].argmin())
        if len(chain) > 1 and d[a, chain[-2]] <= d[a, b]:
            b = chain[-2]
        if len(chain) > 1 and b == chain[-2]:
            chain = chain[:-2]
            merges.append((float(d[a, b]), min(a, b), max(a, b)))
            low, high = min(a, b), max(a, b)
            with np.errstate(invalid="ignore"):
                joined = ((size[low] + size) * d[low] + (size[high] + size) * d[high] - size * d[low, high]) / (size[low] + size[high] + size)
            size[low] += size[high]
            alive[high] = False
            d[low], d[:, low] = joined, joined
            d[high], d[:, high] = np.inf, np.inf
            d[low, ~alive], d[~alive, low], d[low, low] = np.inf, np.inf, np.inf
        else:
            chain.append(b)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    for _, a, b in sorted(merges, key=lambda m: m[0])[: n - k]:
        ra, rb = sorted((find(a), find(b)))
        root[rb] = ra
    roots = [find(i) for i in range(n)]
    names = {r: i for i, r in enumerate(sorted({*roots}))}
    return np.array([names[r] for r in roots])


def hierarchical(rows: DataFrame, k: int) -> DataFrame:
    """Ward's method over a benchmark's rows, :data:`WARD_ROWS` at most, else an error: it needs all their distances at once."""
    if rows.count() > WARD_ROWS:
        raise ValueError(f"hierarchical clustering takes {WARD_ROWS} rows at most")
    held = rows.select("id", as_double("v").alias("v")).orderBy("id").toPandas()
    labels = ward_labels(np.stack(held["v"].to_list()), k) if len(held) else np.zeros(0, int)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.sparkSession.createDataFrame(list(zip(held["id"].tolist(), labels.tolist())), f"id {kind}, cluster int")


def dbscan(rows: DataFrame, eps: float, least: int) -> DataFrame:
    """Rows with ``least`` rows (itself included) within ``eps`` are cores; cores within ``eps`` of each other share a cluster, other rows join the first
    cluster of a core near them. Clusters are numbered by their least core.

    All pairs of a benchmark's rows are compared, one side in broadcast-free blocks that Spark deals out; only pairs within ``eps`` are kept.
    """
    ws = Workspace(rows.sparkSession, "dbscan")
    held = ws.save(rows.select(F.col("id").cast("long").alias("id"), as_double("v").alias("v")), "rows")
    other = held.select(F.col("id").alias("near"), F.col("v").alias("w"))
    far = F.aggregate(F.zip_with("v", "w", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    pairs = ws.save(held.crossJoin(other).where(F.sqrt(far) <= eps).select("id", "near"), "pairs")  # with itself
    cores = ws.save(pairs.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("id"), "cores")
    links = pairs.join(cores, "id", "left_semi").join(cores.withColumnRenamed("id", "near"), "near", "left_semi")
    found = connected_components(ws, links.select(F.col("id").alias("u"), F.col("near").alias("v")))
    names = ws.save(found.select("component").distinct(), "names").orderBy("component").collect()  # a row a cluster
    number = {r["component"]: i for i, r in enumerate(names)}
    table = rows.sparkSession.createDataFrame(list(number.items()), "component long, cluster int")
    labels = found.join(F.broadcast(table), "component").select(F.col("node").alias("near"), "cluster")
    reached = pairs.join(labels, "near").groupBy("id").agg(F.min("cluster").alias("reached"))
    own = labels.withColumnRenamed("near", "id").withColumnRenamed("cluster", "own")
    return held.select("id").join(own, "id", "left").join(reached, "id", "left").select("id", F.coalesce("own", "reached", F.lit(-1)).alias("cluster"))


def fitted(name: str, rows: DataFrame, n_clusters: int = 2, eps: float = 0.5, least: int = 5, seed: int = 42) -> DataFrame:
    check_algorithms([name])
    if name == "kmeans":
        return kmeans(rows, n_clusters, seed)
    return hierarchical(rows, n_clusters) if name == "hierarchical" else dbscan(rows, eps, least)
