"""Queries over feature vectors, samples and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.vectors import as_double, l2_normalise, norm
from tilewright.operators import annotate as ann
from tilewright.operators import features as op
from tilewright.operators import metrics as m
from tilewright.operators import sampling as sm
from tilewright.plans.annotate import CLASSES_SQL, scores
from tilewright.plans.catalog import register
from tilewright.plans.tables import table

FEATURES_SQL = "features as (select vec_id % 20 as slide_id, vec_id // 20 as tile_index, embedding::double[] as v, vec_id from embeddings), each_ as (select slide_id, tile_index, vec_id, unnest(v) as value, unnest(range(0, len(v)))::int as pos from features)"


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.expr("vec_id % 20").alias("slide_id"), F.expr("vec_id div 20").alias("tile_index"), "embedding", "vec_id", "label")


def _pool(how: str):
    sql = f"with {FEATURES_SQL} select slide_id, pos, round({'avg' if how == 'mean' else 'max'}(value), 6) as value from each_ group by 1, 2"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op.pooled(features(spark, sf_dir), how).withColumn("value", F.round("value", 6))

    register(f"{how}_pool", sql)(run)


_pool("mean")  # A2
_pool("max")  # A3


@register("attention_pool", f"with {FEATURES_SQL}, a as (select vec_id, slide_id, exp(v[1] * 3) as e from features), p as (select vec_id, e / sum(e) over (partition by slide_id) as p from a) select slide_id, pos, round(sum(p * value), 6) as value from each_ join p using (vec_id) group by 1, 2")
def attention_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Softmax-weighted pooling."""
    return op.attention_pooled(features(spark, sf_dir), F.get(as_double("embedding"), F.lit(0)) * 3).withColumn("value", F.round("value", 6))


@register("l2_normalise", f"with {FEATURES_SQL} select vec_id, pos, round(value / greatest(sqrt(sum(value * value) over (partition by vec_id)), 1e-12), 6) as value from each_")
def l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit vectors."""
    return features(spark, sf_dir).select("vec_id", F.posexplode(l2_normalise(as_double("embedding"))).alias("pos", "value")).withColumn("value", F.round("value", 6))


@register("standardise", f"with {FEATURES_SQL} select vec_id as tile_index, pos, round((value - avg(value) over (partition by pos)) / stddev_pop(value) over (partition by pos), 6) as value from each_")
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population scaling (V7)."""
    return op.standardised(features(spark, sf_dir).withColumn("tile_index", F.col("vec_id"))).withColumn("value", F.round("value", 6))


WEIGHTS = [round(0.3 * (-1) ** i * (1 + i % 5), 1) for i in range(64)]


@register("classifier_filter", f"with {FEATURES_SQL}, z as (select vec_id, list_inner_product(v, {WEIGHTS}::double[]) + 0.1 as z from features) select vec_id, round(1 / (1 + exp(-z)), 6) as probability from z where 1 / (1 + exp(-z)) > 0.5")
def classifier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows over a classifier's threshold."""
    return op.logistic_filter(features(spark, sf_dir), WEIGHTS, 0.1, 0.5).select("vec_id", F.round("probability", 6).alias("probability"))


@register("ridge_adapter", f"""with {FEATURES_SQL}, x as (select vec_id, list_transform(v, lambda c: (c - 0.01) / 0.5) as x from features),
y as (select vec_id, [list_inner_product(x, {WEIGHTS}::double[]) + 0.1, list_inner_product(x, {WEIGHTS[::-1]}::double[]) - 0.2] as y from x)
select vec_id, round(y[1] / greatest(sqrt(y[1] * y[1] + y[2] * y[2]), 1e-12), 6) as a, round(y[2] / greatest(sqrt(y[1] * y[1] + y[2] * y[2]), 1e-12), 6) as b from y""")
def ridge_adapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear adapter between feature spaces (V2)."""
    out = op.ridge_adapted(as_double("embedding"), [0.01] * 64, [0.5] * 64, [WEIGHTS, WEIGHTS[::-1]], [0.1, -0.2])
    return features(spark, sf_dir).select("vec_id", out.alias("y")).select("vec_id", F.round(F.get("y", F.lit(0)), 6).alias("a"), F.round(F.get("y", F.lit(1)), 6).alias("b"))


@register("feature_norms", f"with {FEATURES_SQL} select slide_id, tile_index, round(sqrt(list_inner_product(v, v)), 6) as norm, (vec_id % 25) * 448 as x, (vec_id // 25) * 448 as y from features")
def feature_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features joined with their coordinates by key, not by position."""
    f = features(spark, sf_dir)
    coords = f.select("slide_id", "tile_index", F.expr("(vec_id % 25) * 448").alias("x"), F.expr("(vec_id div 25) * 448").alias("y"))
    return f.select("slide_id", "tile_index", F.round(norm(as_double("embedding")), 6).alias("norm")).join(coords, ["slide_id", "tile_index"])


@register("class_scores", f"with {CLASSES_SQL} select tile_index, class_idx, class, round(score, 6) as score from scores")
def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of every tile with every class."""
    return scores(spark, sf_dir).withColumn("score", F.round("score", 6))


@register("top_tiles", f"with {CLASSES_SQL} select * from (select tile_index, class_idx, class, round(score, 6) as score, (row_number() over (partition by class_idx order by score desc, tile_index) - 1)::int as rank, (tile_index % 25) * 448 as x, (tile_index // 25) * 448 as y from scores) where rank < 5")
def top_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best tiles of each class, with their places."""
    places = {"x": F.expr("(tile_index % 25) * 448"), "y": F.expr("(tile_index div 25) * 448")}
    return ann.top_tiles(scores(spark, sf_dir), 5).withColumns({"score": F.round("score", 6), **places})


@register("class_counts", f"with {CLASSES_SQL}, b as (select tile_index, arg_max(class, (score, -class_idx)) as class from scores group by 1) select class, count(*) as n from b group by 1")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of each argmax class."""
    return ann.best_class(scores(spark, sf_dir)).groupBy("class").agg(F.count("*").alias("n"))


@register("hash_sample", "select l_suppkey, l_orderkey, l_linenumber from (select *, row_number() over (partition by l_suppkey order by md5('42:' || l_orderkey || '-' || l_linenumber), l_orderkey || '-' || l_linenumber, l_partkey) as r from lineitem) where r <= 16")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 16 tiles of each slide (R1, R2, R5 by hash)."""
    t = table(spark, sf_dir, "lineitem").withColumn("k", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return sm.capped(t, 16, 42, "l_suppkey", "k").select("l_suppkey", "l_orderkey", "l_linenumber")


SIZES_SQL = "sizes as (select o_custkey % 50 as sample_id, o_custkey as slide_id, count(*) as size from orders group by 1, 2), s as (select *, sum(size) over (partition by sample_id) as total, max(slide_id) over (partition by sample_id) as last, count(*) over (partition by sample_id) as k from sizes)"


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 50).alias("sample_id"), F.col("o_custkey").alias("slide_id")).agg(F.count("*").alias("size"))


@register("proportional_quotas", f"with {SIZES_SQL}, q as (select *, least(round_even(100.0 * size / total, 0)::bigint, size) as share from s) select sample_id, slide_id, size, (case when total <= 100 then size when slide_id = last then greatest(0, 100 - coalesce(sum(share) over (partition by sample_id order by slide_id rows between unbounded preceding and 1 preceding), 0)) else share end)::bigint as quota from q")
def proportional_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas by size, the last slide takes the rest."""
    return sm.proportional_quotas(sizes(spark, sf_dir), 100)


@register("equal_quotas", f"with {SIZES_SQL} select sample_id, slide_id, size, (case when total <= 100 then size else least(100 // k + case when slide_id = last then 100 % k else 0 end, size) end)::bigint as quota from s")
def equal_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal quotas, capped by size."""
    return sm.equal_quotas(sizes(spark, sf_dir), 100)


@register("group_split", "with g as (select distinct l_suppkey as slide_id from lineitem), r as (select slide_id, row_number() over (order by md5('42:' || slide_id), slide_id) as r, greatest(1, round_even(count(*) over () * 0.2, 0)) as t, greatest(1, round_even(count(*) over () * 0.1, 0)) as v from g) select slide_id, case when r <= t then 'test' when r <= t + v then 'val' else 'train' end as split from r")
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slides dealt to train, val and test (R6 by hash)."""
    return sm.group_split(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("slide_id")).distinct(), "slide_id", 0.2, 0.1, 42)


@register("class_weights", "select l_returnflag, sum(count(*)) over () / count(*) as weight from lineitem group by 1")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced weights."""
    return sm.class_weights(table(spark, sf_dir, "lineitem"), "l_returnflag")


PRED_SQL = "pred as (select l_suppkey as slide_id, (l_returnflag = 'R')::int as y, round(((l_orderkey * 7 + l_linenumber * 13) % 101) / 100.0, 2)::double as p from lineitem)"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.round(((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 101) / 100.0, 2)
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("slide_id"), (F.col("l_returnflag") == "R").cast("int").alias("y"), p.alias("p"))


@register("roc_auc", f"with {PRED_SQL}, r as (select y, rank() over (order by p) + (count(*) over (partition by p) - 1) / 2.0 as r from pred) select round((sum(r) filter (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 6)::double as auc from r")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the ROC curve with ties (M1)."""
    return m.roc_auc(predictions(spark, sf_dir)).select(F.round("auc", 6).alias("auc"))


CUM_SQL = f"{PRED_SQL}, g as (select p, sum(y) as pos, count(*) as n from pred group by p), c as (select *, sum(pos) over (order by p desc) as tp, sum(n) over (order by p desc) as seen, sum(pos) over () as all_pos, sum(n) over () as total from g)"


@register("average_precision", f"with {CUM_SQL} select round(sum(pos / all_pos * tp / seen), 6)::double as ap from c")
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step-wise average precision (M4)."""
    return m.average_precision(predictions(spark, sf_dir)).select(F.round("ap", 6).alias("ap"))


@register("roc_points", f"with {CUM_SQL} select p as threshold, round((seen - tp) / (total - all_pos), 6)::double as fpr, round(tp / all_pos, 6)::double as tpr from c")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the ROC curve (M6)."""
    return m.roc_points(predictions(spark, sf_dir)).select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@register("calibration", f"with {PRED_SQL} select (case when p <= 0.1 then 0 when p <= 0.2 then 1 when p <= 0.3 then 2 when p <= 0.4 then 3 when p <= 0.5 then 4 when p <= 0.6 then 5 when p <= 0.7 then 6 when p <= 0.8 then 7 when p <= 0.9 then 8 else 9 end)::int as bin, round(avg(p), 6) as mean_p, round(avg(y::double), 6) as observed from pred group by 1")
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration in ten bins (M7)."""
    return m.calibration(predictions(spark, sf_dir)).select("bin", F.round("mean_p", 6).alias("mean_p"), F.round("observed", 6).alias("observed"))


@register("class_report", f"with {PRED_SQL}, q as (select y, (p > 0.5)::int as z from pred), c as (select unnest([0, 1]) as class) select class::int as class, round(coalesce(count(*) filter (y = class and z = class) / nullif(count(*) filter (z = class), 0), 0), 6)::double as precision, round(count(*) filter (y = class and z = class) / count(*) filter (y = class), 6)::double as recall, round(2 * count(*) filter (y = class and z = class) / (count(*) filter (z = class) + count(*) filter (y = class)), 6)::double as f1, count(*) filter (y = class) as support from q cross join c group by class")
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall, F1 and support (M3, M5)."""
    rows = predictions(spark, sf_dir).select("y", (F.col("p") > 0.5).cast("int").alias("y_pred"))
    return m.class_report(rows).select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("slide_rollup", f"with {PRED_SQL} select slide_id, max(y) as y, round(avg(p), 6) as p from pred group by 1")
def slide_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slide label and mean probability."""
    return predictions(spark, sf_dir).groupBy("slide_id").agg(F.max("y").alias("y"), F.round(F.avg("p"), 6).alias("p"))


@register("seed_summary", f"with {PRED_SQL} select round(avg(a), 6) as mean, round(stddev_pop(a), 6) as std, round(quantile_cont(a, 0.025), 6) as low, round(quantile_cont(a, 0.975), 6) as high, round(avg((a > 0.5)::int), 6) as error from (select avg(p) as a from pred group by slide_id)")
def seed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, population deviation and percentile interval."""
    a = predictions(spark, sf_dir).groupBy("slide_id").agg(F.avg("p").alias("a"))
    q = F.percentile("a", F.array(F.lit(0.025), F.lit(0.975)))
    return a.agg(F.avg("a").alias("mean"), F.stddev_pop("a").alias("std"), F.get(q, F.lit(0)).alias("low"), F.get(q, F.lit(1)).alias("high"), F.avg((F.col("a") > 0.5).cast("int")).alias("error")).select(*[F.round(c, 6).alias(c) for c in ("mean", "std", "low", "high", "error")])


@register("rank_normalise", f"with {PRED_SQL} select slide_id, p, round((rank() over (order by p) + (count(*) over (partition by p) - 1) / 2.0) / count(*) over (), 6)::double as rank from pred")
def rank_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean rank over the number of rows."""
    return m.rank_normalised(predictions(spark, sf_dir), "p").select("slide_id", "p", F.round("rank", 6).alias("rank"))


CLUSTER_SQL = "lab as (select l_suppkey as slide_id, (l_partkey * 3 % 4)::int as a, case when l_orderkey % 11 = 0 then -1 else (l_partkey % 5)::int end as b from lineitem), t as (select a, b, count(*) as n, sum(count(*)) over (partition by a) as na, sum(count(*)) over (partition by b) as nb, sum(count(*)) over () as total from lab where b <> -1 group by a, b)"


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("l_suppkey as slide_id", "int(l_partkey * 3 % 4) as a", "case when l_orderkey % 11 = 0 then -1 else int(l_partkey % 5) end as b")


@register("nmi", f"with {CLUSTER_SQL} select round(2 * sum(n / total * ln(n * total / (na * nb))) / (-sum(n / total * ln(na / total)) - sum(n / total * ln(nb / total))), 6)::double as nmi from t")
def nmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised mutual information (M9)."""
    return m.nmi(clusters(spark, sf_dir)).select(F.round("nmi", 6).alias("nmi"))


@register("ari", f"with {CLUSTER_SQL}, i as (select sum(n * (n - 1) / 2.0) as ij from t), a as (select sum(x * (x - 1) / 2.0) as v from (select distinct a, na as x from t)), b as (select sum(x * (x - 1) / 2.0) as v from (select distinct b, nb as x from t)), w as (select max(total * (total - 1) / 2.0) as v from t) select round((ij - a.v * b.v / w.v) / ((a.v + b.v) / 2 - a.v * b.v / w.v), 6)::double as ari from i, a, b, w")
def ari(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjusted Rand index."""
    return m.ari(clusters(spark, sf_dir)).select(F.round("ari", 6).alias("ari"))


@register("purity", f"with {CLUSTER_SQL} select round(sum(top) / sum(n), 6)::double as purity from (select b, max(n) as top, sum(n) as n from t group by b)")
def purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purity without noise."""
    return m.purity(clusters(spark, sf_dir)).select(F.round("purity", 6).alias("purity"))


@register("noise_counts", f"with {CLUSTER_SQL} select count(*) filter (b = -1) as noise, count(distinct b) filter (b <> -1) as clusters from lab")
def noise_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise rows and clusters."""
    return clusters(spark, sf_dir).agg(F.count_if(F.col("b") == -1).alias("noise"), F.countDistinct(F.when(F.col("b") != -1, F.col("b"))).alias("clusters"))


@register("majority_vote", f"with {CLUSTER_SQL}, c as (select slide_id, b, count(*) as n from lab group by 1, 2) select slide_id, coalesce(arg_max(b, (n, -b)) filter (b <> -1), -1)::int as label from c group by 1")
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent cluster of a slide."""
    return m.majority(clusters(spark, sf_dir).select("slide_id", F.col("b").alias("label")))


@register("split_statistics", f"with {PRED_SQL} select slide_id % 3 as split, count(*) as n_rows, count(distinct slide_id) as slides, round(avg(y), 6) as positive from pred group by 1")
def split_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, slides and positive rate of each split."""
    return predictions(spark, sf_dir).groupBy((F.col("slide_id") % 3).alias("split")).agg(F.count("*").alias("n_rows"), F.countDistinct("slide_id").alias("slides"), F.round(F.avg("y"), 6).alias("positive"))
