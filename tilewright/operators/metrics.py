"""Metrics over prediction tables ``(y, p)`` or ``(y, y_pred)``, as aggregations without a driver loop.

Ranking metrics first count distinct scores; sums over their order run in ranges (:mod:`ranking`). A metric that isn't defined for its
rows (no positives, no negatives, no rows, only noise) is NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.vectors import as_double
from tilewright.operators.distances import class_distances
from tilewright.operators.ranking import with_running_sums
from tilewright.workspace import Workspace

NAN = float("nan")


def by_score(rows: DataFrame) -> DataFrame:
    """``(p, pos, n)``: positives and rows of each distinct score."""
    return rows.groupBy("p").agg(F.sum(F.col("y").cast("long")).alias("pos"), F.count("*").alias("n"))


def cumulative(rows: DataFrame) -> DataFrame:
    """``(p, pos, n, tp, seen, all_pos, total)`` by descending score."""
    counts = by_score(rows).withColumn("_down", -F.col("p"))
    run = with_running_sums(counts, "_down", ["pos", "n"])
    return run.select("p", "pos", "n", F.col("run_pos").alias("tp"), F.col("run_n").alias("seen"), "all_pos", F.col("all_n").alias("total"))


def _over(a: Column, b: Column, empty: float | None = NAN) -> Column:
    """``a / b``, or ``empty`` where b is 0 or null."""
    return F.when(b != 0, a / b).otherwise(F.lit(empty))


def roc_auc(rows: DataFrame) -> DataFrame:
    """``(auc)``: trapezoids between distinct scores, so ties count half."""
    gained = (F.col("n") - F.col("pos")) * (F.col("tp") - F.col("pos") / 2)  # negatives of this score under the positives so far
    pairs = F.max("all_pos") * (F.max("total") - F.max("all_pos"))
    return cumulative(rows).agg(_over(F.sum(gained), F.coalesce(pairs, F.lit(0))).alias("auc"))


def macro_auc(rows: DataFrame) -> DataFrame:
    """``(auc)``: mean over the classes that occur of the one-against-rest AUC of ``(y, class, p)``, a row for each row and class.

    Classes are few, rows many: scores are counted for each class and pairs are summed within it.
    """
    counts = rows.groupBy("class", "p").agg(F.sum((F.col("y") == F.col("class")).cast("long")).alias("pos"), F.count("*").alias("n"))
    down = Window.partitionBy("class").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    run = counts.withColumn("tp", F.sum("pos").over(down))
    each = run.groupBy("class").agg(F.sum((F.col("n") - F.col("pos")) * (F.col("tp") - F.col("pos") / 2)).alias("g"), F.sum("pos").alias("a"), F.sum("n").alias("t"))
    each = each.where("a > 0").select(_over(F.col("g"), F.col("a") * (F.col("t") - F.col("a"))).alias("auc"))
    return each.agg(F.coalesce(F.avg("auc"), F.lit(NAN)).alias("auc"))


def average_precision(rows: DataFrame) -> DataFrame:
    """``(ap)``: sum of recall steps times precision over distinct scores; 0 without positives."""
    step = F.col("pos") * F.col("tp") / F.col("seen")
    return cumulative(rows).agg(_over(F.sum(step), F.coalesce(F.max("all_pos"), F.lit(0)), 0.0).alias("ap"))


def roc_points(rows: DataFrame) -> DataFrame:
    """``(threshold, fpr, tpr)`` for each distinct score; NaN where a class is missing."""
    return cumulative(rows).select(
        F.col("p").alias("threshold"), _over(F.col("seen") - F.col("tp"), F.col("total") - F.col("all_pos")).alias("fpr"), _over(F.col("tp"), F.col("all_pos")).alias("tpr")
    )


def pr_points(rows: DataFrame) -> DataFrame:
    """``(threshold, precision, recall)`` for each distinct score; the recall is 1 where there are no positives."""
    return cumulative(rows).select(F.col("p").alias("threshold"), (F.col("tp") / F.col("seen")).alias("precision"), _over(F.col("tp"), F.col("all_pos"), 1.0).alias("recall"))


def calibration(rows: DataFrame, bins: int = 10) -> DataFrame:
    """``(bin, mean_p, observed)`` of uniform bins that are closed on the right; empty ones are left out."""
    edges = [F.lit(k * (1.0 / bins)) for k in range(1, bins)]
    b = sum(((F.col("p") > e).cast("int") for e in edges), F.lit(0)).alias("bin")
    return rows.groupBy(b).agg(F.avg("p").alias("mean_p"), F.avg(F.col("y").cast("double")).alias("observed"))


def confusion(rows: DataFrame) -> DataFrame:
    """``(y, y_pred, n)`` for every pair of labels that occur on either side, also those with no row."""
    pairs = rows.groupBy("y", "y_pred").agg(F.count("*").alias("n"))
    labels = pairs.select("y").union(pairs.select("y_pred")).distinct()
    grid = labels.crossJoin(F.broadcast(labels.withColumnRenamed("y", "y_pred")))  # labels of a task, a few by a few
    return grid.join(pairs, ["y", "y_pred"], "left").select("y", "y_pred", F.coalesce("n", F.lit(0)).alias("n"))


def class_report(rows: DataFrame) -> DataFrame:
    """``(class, precision, recall, f1, support)``; a ratio over 0 is 0."""
    pairs = rows.groupBy("y", "y_pred").agg(F.count("*").alias("n"))
    each = pairs.select(F.col("y").alias("class"), F.when(F.col("y") == F.col("y_pred"), F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")).unionByName(
        pairs.select(F.col("y_pred").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"))
    )
    s = each.groupBy("class").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return s.select("class", ratio(F.col("tp"), F.col("predicted")).alias("precision"), ratio(F.col("tp"), F.col("support")).alias("recall"), ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"), "support")


def report_averages(rows: DataFrame) -> DataFrame:
    """``(average, precision, recall, f1, support)`` with rows ``accuracy``, ``macro avg`` and ``weighted avg``; accuracy fills every column."""
    each = class_report(rows)
    total = F.sum("support")
    macro = each.agg(F.lit("macro avg").alias("average"), *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")], total.alias("support"))
    weighted = each.agg(F.lit("weighted avg").alias("average"), *[_over(F.sum(F.col(c) * F.col("support")), total).alias(c) for c in ("precision", "recall", "f1")], total.alias("support"))
    share = F.avg((F.col("y") == F.col("y_pred")).cast("double"))
    accuracy = rows.agg(F.lit("accuracy").alias("average"), share.alias("precision"), share.alias("recall"), share.alias("f1"), F.count("*").alias("support"))
    return accuracy.unionByName(macro).unionByName(weighted)


def error_rate(rows: DataFrame) -> DataFrame:
    """``(error)``: the share of rows whose prediction is wrong; NaN without rows."""
    return rows.agg(F.coalesce(1 - F.avg((F.col("y") == F.col("y_pred")).cast("double")), F.lit(NAN)).alias("error"))


def without_noise(rows: DataFrame) -> DataFrame:
    """Rows that a clustering ``b`` didn't take as noise (-1)."""
    return rows.where("b <> -1")


def contingency(rows: DataFrame) -> DataFrame:
    """``(a, b, n, na, nb, total)`` of two labelings."""
    n = rows.groupBy("a", "b").agg(F.count("*").alias("n"))
    return n.select("*", F.sum("n").over(Window.partitionBy("a")).alias("na"), F.sum("n").over(Window.partitionBy("b")).alias("nb"), F.sum("n").over(Window.partitionBy()).alias("total"))


def _once(value: Column, size: str, own: str) -> Column:
    """Sums a value of the group that ``size`` counts once, spread over its cells."""
    return F.sum(value * F.col(own) / F.col(size))


def nmi(rows: DataFrame) -> DataFrame:
    """``(nmi)`` with the arithmetic mean of the entropies, noise left out: 1 for one label on both sides, 0 without mutual information."""
    c = contingency(without_noise(rows))
    mutual = F.sum(F.col("n") / F.col("total") * F.ln(F.col("n") * F.col("total") / (F.col("na") * F.col("nb"))))
    entropy = lambda k: -F.sum(F.col("n") / F.col("total") * F.ln(F.col(k) / F.col("total")))
    s = c.agg(mutual.alias("m"), entropy("na").alias("ha"), entropy("nb").alias("hb"), F.countDistinct("a").alias("ka"), F.countDistinct("b").alias("kb"))
    value = F.when(F.col("ka") == 0, F.lit(NAN)).when((F.col("ka") == 1) & (F.col("kb") == 1), F.lit(1.0)).when(F.col("m") <= 2.220446049250313e-16, F.lit(0.0))
    return s.select(value.otherwise(_over(2 * F.col("m"), F.col("ha") + F.col("hb"))).alias("nmi"))


def ari(rows: DataFrame) -> DataFrame:
    """``(ari)``: the adjusted Rand index by pair counts, noise left out; 1 where both sides join the same pairs."""
    two = lambda k: F.col(k).cast("double") * (F.col(k) - 1) / 2
    c = contingency(without_noise(rows))
    s = c.agg(F.sum(two("n")).alias("ij"), _once(two("na"), "na", "n").alias("ai"), _once(two("nb"), "nb", "n").alias("bj"), F.max(two("total")).alias("t"), F.count("*").alias("cells"))
    expected = _over(F.col("ai") * F.col("bj"), F.col("t"), 0.0)
    spread = (F.col("ai") + F.col("bj")) / 2 - expected
    same = (F.abs(F.col("ij") - F.col("ai")) < 0.5) & (F.abs(F.col("ij") - F.col("bj")) < 0.5)
    return s.select(F.when(F.col("cells") == 0, F.lit(NAN)).when(same, F.lit(1.0)).otherwise(_over(F.col("ij") - expected, spread, 1.0)).alias("ari"))


def purity(rows: DataFrame) -> DataFrame:
    """``(purity)``: rows of the most frequent true label ``a`` of each cluster ``b``; noise (-1) is left out."""
    top = without_noise(rows).groupBy("b", "a").agg(F.count("*").alias("n")).groupBy("b").agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    return top.agg(_over(F.sum("top"), F.coalesce(F.sum("n"), F.lit(0))).alias("purity"))


def silhouette(rows: DataFrame, key: str = "id", vector: str = "v") -> DataFrame:
    """``(silhouette)``: mean of ``(b - a) / max(a, b)`` by euclidean distance over rows ``(id, v, b)`` that aren't noise; 0 for a row alone in its cluster.

    NaN with fewer than two clusters, or fewer rows than clusters and one. All rows are compared with all, block by block
    (:func:`class_distances`), so the time grows with their square; a caller that wants an estimate gives a sample.
    """
    held = without_noise(rows).select(F.col(key).alias("i"), as_double(vector).alias("v"), "b")
    n, k = held.agg(F.count("*"), F.countDistinct("b")).first()
    if k < 2 or n < k + 1:
        return rows.sparkSession.createDataFrame([(NAN,)], "silhouette double")
    ws = Workspace(rows.sparkSession, "silhouette")
    far = ws.save(class_distances(ws, held), "sums")
    ws.keep("sums")
    alone = held.where("i is not null").select("i", "b", F.lit(None).cast(held.schema["b"].dataType).alias("c"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s"))  # rows at no distance count too
    to = far.unionByName(alone).groupBy("i", "b", "c").agg(_over(F.sum("s"), F.sum("n"), None).alias("d"))
    each = to.groupBy("i").agg(F.max(F.when(F.col("b") == F.col("c"), F.col("d"))).alias("own"), F.min(F.when(F.col("b") != F.col("c"), F.col("d"))).alias("next"))
    value = F.when(F.col("own").isNull(), 0.0).otherwise(_over(F.col("next") - F.col("own"), F.greatest("own", "next"), 0.0))
    return each.agg(F.avg(value).alias("silhouette"))


#: Rows of the sample whose silhouette the clustering benchmark tells; the usual sample size of the measure.
SILHOUETTE_ROWS = 5000


def majority(rows: DataFrame) -> DataFrame:
    """``(slide_id, label)``: the most frequent label other than -1, the smallest of equals; -1 if there is only noise."""
    counts = rows.groupBy("slide_id", "label").agg(F.count("*").alias("n"))
    best = F.max_by("label", F.when(F.col("label") != -1, F.struct("n", (-F.col("label")).alias("o"))))
    return counts.groupBy("slide_id").agg(F.coalesce(best, F.lit(-1)).cast("int").alias("label"))


def slide_clusters(rows: DataFrame) -> DataFrame:
    """``(slide_id, a, b)`` by majority of each from ``(slide_id, a, b)``; slides of noise only are left out."""
    of = lambda c: majority(rows.select("slide_id", F.col(c).alias("label"))).withColumnRenamed("label", c)
    return of("a").join(of("b"), "slide_id").where("b <> -1")


def importance(coefficients: DataFrame, n: int) -> DataFrame:
    """``(feature, weight)`` of the ``n`` greatest from ``(class, feature, coefficient)``: the signed coefficient of one class, the length over several."""
    each = coefficients.groupBy("feature").agg(F.count("*").alias("k"), F.first("coefficient").alias("c"), F.sqrt(F.sum(F.col("coefficient") * F.col("coefficient"))).alias("l"))
    return each.select("feature", F.when(F.col("k") == 1, F.col("c")).otherwise(F.col("l")).alias("weight")).orderBy(F.desc("weight"), F.desc("feature")).limit(n)


def rank_normalised(rows: DataFrame, value: str) -> DataFrame:
    """Adds ``rank``: the mean rank of equals over the number of rows, from counts of distinct values."""
    counts = rows.groupBy(value).agg(F.count("*").alias("n"))
    run = with_running_sums(counts, value, ["n"])
    ranks = run.select(value, ((F.col("run_n") - F.col("n") + (F.col("n") + 1) / 2) / F.col("all_n")).alias("rank"))
    return rows.join(ranks, value)


def top_by_score(scored: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the greatest ``score``, with ``rank`` from 0 for the least of them; of equals the greater key is taken."""
    best = scored.orderBy(F.desc("score"), F.desc(key)).limit(n)  # a bounded heap in each task
    w = Window.orderBy("score", key)
    return best.withColumn("rank", (F.row_number().over(w) - 1).cast("int"))


def annotated(tiles: DataFrame, least_overlap: float, multiclass: bool) -> DataFrame:
    """Tiles whose ``overlap_area`` is strictly over that share of their ``tile_area``; with several classes without background (0)."""
    kept = tiles.where(F.col("overlap_area") > least_overlap * F.col("tile_area"))
    return kept.where("annotation <> 0") if multiclass else kept
