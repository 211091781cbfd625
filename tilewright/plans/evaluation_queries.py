"""Queries over predictions, clusterings, samples, bags and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.vectors import as_double
from tilewright.operators import annotate as ann
from tilewright.operators import batches
from tilewright.operators import features as op
from tilewright.operators import metrics as m
from tilewright.operators import sampling as sm
from tilewright.plans.annotate import CLASSES_SQL, scores
from tilewright.plans.catalog import register
from tilewright.plans.feature_queries import CLUSTER_SQL, CUM_SQL, FEATURES_SQL, PRED_SQL, WEIGHTS, clusters, features, predictions
from tilewright.plans.tables import table

MULTI_SQL = "multi as (select l_orderkey * 10 + l_linenumber as id, (l_partkey % 4)::int as y, c::int as class, round(((l_orderkey * (c + 3) + l_partkey) % 97) / 97.0, 4)::double as p from lineitem cross join (select unnest([0, 1, 2, 3, 9]) as c))"


def multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber as id", "int(l_partkey % 4) as y", "l_orderkey", "l_partkey", "explode(array(0, 1, 2, 3, 9)) as class")
    return each.selectExpr("id", "y", "class", "double(round(((l_orderkey * (class + 3) + l_partkey) % 97) / 97.0D, 4)) as p")


@register(
    "macro_auc",
    f"with {MULTI_SQL}, r as (select class, y = class as hit, rank() over (partition by class order by p) + (count(*) over (partition by class, p) - 1) / 2.0 as r from multi), a as (select class, count(*) filter (hit) as pos, count(*) as n, sum(r) filter (hit) as s from r group by class) select round(avg((s - pos * (pos + 1) / 2.0) / (pos * (n - pos))), 6)::double as auc from a where pos > 0",
)
def macro_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean one-against-rest AUC of the classes that occur; class 9 doesn't (M2)."""
    return m.macro_auc(multi(spark, sf_dir)).select(F.round("auc", 6).alias("auc"))


LABELS_SQL = "lab2 as (select (l_partkey % 4)::int as y, ((l_partkey + case when l_orderkey % 3 = 0 then l_linenumber else 0 end) % 5)::int as y_pred from lineitem)"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("int(l_partkey % 4) as y", "int((l_partkey + if(l_orderkey % 3 = 0, l_linenumber, 0)) % 5) as y_pred")


@register("confusion_matrix", f"with {LABELS_SQL}, l as (select y from lab2 union select y_pred from lab2) select a.y, b.y as y_pred, (select count(*) from lab2 where lab2.y = a.y and lab2.y_pred = b.y) as n from l a cross join l b")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each pair of labels, also of those that never meet (M5)."""
    return m.confusion(labelled(spark, sf_dir))


@register(
    "report_averages",
    f"""with {LABELS_SQL}, l as (select y as c from lab2 union select y_pred from lab2), s as (select c, (select count(*) from lab2 where y = c and y_pred = c) as tp, (select count(*) from lab2 where y = c) as sup, (select count(*) from lab2 where y_pred = c) as pred from l),
e as (select sup, coalesce(tp / nullif(pred, 0), 0) as p, coalesce(tp / nullif(sup, 0), 0) as r, coalesce(2 * tp / nullif(pred + sup, 0), 0) as f from s)
select 'macro avg' as average, round(avg(p), 6) as precision, round(avg(r), 6) as recall, round(avg(f), 6) as f1, sum(sup)::bigint as support from e
union all select 'weighted avg', round(sum(p * sup) / sum(sup), 6), round(sum(r * sup) / sum(sup), 6), round(sum(f * sup) / sum(sup), 6), sum(sup)::bigint from e
union all select 'accuracy', round(avg((y = y_pred)::int), 6), round(avg((y = y_pred)::int), 6), round(avg((y = y_pred)::int), 6), count(*) from lab2""",
)
def report_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and macro and weighted averages of precision, recall and F1 (M3, M5)."""
    return m.report_averages(labelled(spark, sf_dir)).select("average", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("error_rate", f"with {LABELS_SQL} select round(1 - avg((y = y_pred)::int), 6) as error from lab2")
def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of wrong predictions."""
    return m.error_rate(labelled(spark, sf_dir)).select(F.round("error", 6).alias("error"))


@register("pr_points", f"with {CUM_SQL} select p as threshold, round(tp / seen, 6)::double as precision, round(tp / all_pos, 6)::double as recall from c")
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the curve of precision and recall (M6)."""
    return m.pr_points(predictions(spark, sf_dir)).select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@register(
    "slide_cluster_metrics",
    f"""with {CLUSTER_SQL}, ca as (select slide_id, a, count(*) as n from lab group by 1, 2), cb as (select slide_id, b, count(*) as n from lab where b <> -1 group by 1, 2),
v as (select x.slide_id, x.a, y.b from (select slide_id, arg_max(a, (n, -a)) as a from ca group by 1) x join (select slide_id, arg_max(b, (n, -b)) as b from cb group by 1) y using (slide_id)),
tt as (select a, b, count(*) as n, sum(count(*)) over (partition by a) as na, sum(count(*)) over (partition by b) as nb, sum(count(*)) over () as total from v group by a, b),
pu as (select sum(top) / sum(n) as purity from (select b, max(n) as top, sum(n) as n from tt group by b)),
ii as (select sum(n * (n - 1) / 2.0) as ij, max(total * (total - 1) / 2.0) as w from tt), aa as (select sum(x * (x - 1) / 2.0) as v from (select distinct a, na as x from tt)), bb as (select sum(x * (x - 1) / 2.0) as v from (select distinct b, nb as x from tt))
select round(purity, 6)::double as purity, round((ij - aa.v * bb.v / w) / ((aa.v + bb.v) / 2 - aa.v * bb.v / w), 6)::double as ari, (select round(2 * sum(n / total * ln(n * total / (na * nb))) / (-sum(n / total * ln(na / total)) - sum(n / total * ln(nb / total))), 6)::double from tt) as nmi from pu, ii, aa, bb""",
)
def slide_cluster_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustering metrics of slides by majority votes."""
    v = m.slide_clusters(clusters(spark, sf_dir))
    r = lambda df, c: df.select(F.round(c, 6).alias(c))
    return r(m.purity(v), "purity").crossJoin(r(m.ari(v), "ari")).crossJoin(r(m.nmi(v), "nmi"))  # one row each


SIL_SQL = "s as (select vec_id as i, embedding::double[] as v, case when label = 9 then -1 else label % 4 end as b from embeddings)"


@register(
    "silhouette",
    f"""with {SIL_SQL}, h as (select * from s where b <> -1), d as (select x.i, x.b, y.b as c, avg(list_distance(x.v, y.v)) as d from h x join h y on x.i <> y.i group by 1, 2, 3),
e as (select i, max(d) filter (b = c) as own, min(d) filter (b <> c) as next from d group by i) select round(avg(case when own is null then 0 else (next - own) / greatest(own, next) end), 6) as silhouette from e""",
)
def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well rows lie in their cluster, by euclidean distance."""
    rows = table(spark, sf_dir, "embeddings").selectExpr("vec_id as id", "embedding as v", "if(label = 9, -1, label % 4) as b")
    return m.silhouette(rows).select(F.round("silhouette", 6).alias("silhouette"))


COEF_SQL = "coef as (select c::int as class, p_partkey as feature, sin(p_partkey * 1.7 + c)::double as coefficient from part cross join (select unnest([0, 1, 2]) as c) where p_partkey <= 64)"


@register("feature_importance", f"with {COEF_SQL}, e as (select feature, sqrt(sum(coefficient * coefficient)) as weight from coef group by 1), s as (select feature, coefficient as weight from coef where class = 0) select kind, feature, round(weight, 6) as weight from ((select 'signed' as kind, * from s order by weight desc, feature desc limit 20) union all (select 'length' as kind, * from e order by weight desc, feature desc limit 20))")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty features with the greatest coefficient of one class, or length over three."""
    c = table(spark, sf_dir, "part").where("p_partkey <= 64").selectExpr("p_partkey as feature", "explode(array(0, 1, 2)) as class").selectExpr("class", "feature", "sin(feature * 1.7D + class) as coefficient")
    both = m.importance(c.where("class = 0"), 20).withColumn("kind", F.lit("signed")).unionByName(m.importance(c, 20).withColumn("kind", F.lit("length")))
    return both.select("kind", "feature", F.round("weight", 6).alias("weight"))


@register("grid_search_scores", "select o_orderpriority as penalty, round(avg(o_totalprice) filter (o_custkey % 3 = 0), 4) as c_0, round(avg(o_totalprice) filter (o_custkey % 3 = 1), 4) as c_1, round(avg(o_totalprice) filter (o_custkey % 3 = 2), 4) as c_2 from orders group by 1")
def grid_search_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean scores of a grid search, penalties down and strengths across."""
    o = table(spark, sf_dir, "orders").selectExpr("o_orderpriority as penalty", "o_custkey % 3 as c", "o_totalprice as score")
    wide = o.groupBy("penalty").pivot("c", [0, 1, 2]).agg(F.round(F.avg("score"), 4))
    return wide.toDF("penalty", "c_0", "c_1", "c_2")


@register("best_class_filter", f"with {CLASSES_SQL} select tile_index from (select tile_index, arg_max(class, (score, -class_idx)) as class from scores group by 1) where class in ('class_1', 'class_4')")
def best_class_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles whose best class is among some."""
    return ann.in_classes(scores(spark, sf_dir), ["class_1", "class_4"])


@register(
    "report_groups",
    f"with {CLASSES_SQL}, r as (select class, tile_index, row_number() over (partition by class_idx order by score desc, tile_index) as r from scores), b as (select tile_index, arg_max(class, (score, -class_idx)) as class from scores group by 1) select 'top' as kind, class, string_agg(tile_index::varchar, ',' order by r) as tiles from r where r <= 3 group by class union all select 'best', class, string_agg(tile_index::varchar, ',' order by tile_index) from b group by class",
)
def report_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of a report: the three best of each class, or all by their best class."""
    s = scores(spark, sf_dir)
    text = lambda df, kind: df.select(F.lit(kind).alias("kind"), "class", F.array_join(F.transform("tile_indices", lambda x: x.cast("string")), ",").alias("tiles"))
    return text(ann.report_groups(s, 3), "top").unionByName(text(ann.report_groups(s, None), "best"))


@register("wide_scores", f"with {CLASSES_SQL} select tile_index, round(max(score) filter (class = 'class_0'), 6) as class_0, round(max(score) filter (class = 'class_1'), 6) as class_1, round(max(score) filter (class = 'class_7'), 6) as class_7 from scores group by 1")
def wide_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of scores for each class (the score table of a slide, S18)."""
    wide = ann.wide_scores(scores(spark, sf_dir), ["class_0", "class_1", "class_7"])
    return wide.select("tile_index", *[F.round(c, 6).alias(c) for c in wide.columns[1:]])


@register("top_patches", f"with {PRED_SQL}, s as (select slide_id, avg(p) as score from pred group by 1), r as (select slide_id, score, row_number() over (order by score desc, slide_id desc) as r from s) select slide_id, round(score, 6) as score, (5 - r)::int as rank from r where r <= 5")
def top_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best by score; rank 0 is the least of them."""
    s = predictions(spark, sf_dir).groupBy("slide_id").agg(F.avg("p").alias("score"))
    return m.top_by_score(s, "slide_id", 5).select("slide_id", F.round("score", 6).alias("score"), "rank")


@register("foreground_tiles", "select l_orderkey, l_linenumber, (l_partkey % 5)::int as annotation, (l_partkey % 5 = 2)::int as y from lineitem where l_quantity > 25 and l_partkey % 5 <> 0")
def foreground_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles over the overlap threshold without background, with a binary label."""
    t = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "int(l_partkey % 5) as annotation", "l_quantity as overlap_area", "50D as tile_area")
    kept = m.annotated(t, 0.5, multiclass=True).select("l_orderkey", "l_linenumber", "annotation")
    return kept.withColumn("y", (F.col("annotation") == 2).cast("int"))


_A, _B = WEIGHTS, WEIGHTS[::-1]


@register(
    "attention_heads",
    f"""with {FEATURES_SQL}, h as (select vec_id, slide_id, [tanh(list_inner_product(v, {_A}::double[]) + 0.1), tanh(list_inner_product(v, {_B}::double[]) - 0.2)] as t, [1 / (1 + exp(-(list_inner_product(v, {_B}::double[]) + 0.3))), 1 / (1 + exp(-(list_inner_product(v, {_A}::double[]) - 0.1)))] as g from features),
a as (select vec_id, slide_id, 1.5 * t[1] - 0.5 * t[2] + 0.2 as a0, case when vec_id % 7 = 0 then -1e9 else 1.5 * t[1] * g[1] - 0.5 * t[2] * g[2] + 0.2 end as a1 from h),
p as (select vec_id, exp(a0 - max(a0) over w) / sum(exp(a0)) over w * exp(max(a0) over w) as p0, exp(a1) / sum(exp(a1)) over w as p1 from a window w as (partition by slide_id))
select slide_id, pos + head * 64 as pos, round(sum(value * case head when 0 then p0 else p1 end), 6) as value from each_ join p using (vec_id) cross join (select unnest([0, 1])::int as head) group by 1, 2""",
)
def attention_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attention pooling with two heads, one of them gated and masked."""
    v = as_double("embedding")
    plain = op.attention_logit(v, [_A, _B], [0.1, -0.2], [1.5, -0.5], 0.2)
    gated = op.attention_logit(v, [_A, _B], [0.1, -0.2], [1.5, -0.5], 0.2, ([_B, _A], [0.3, -0.1]), F.col("vec_id") % 7 != 0)
    return op.attention_pooled_heads(features(spark, sf_dir), [plain, gated]).withColumn("value", F.round("value", 6))


@register(
    "distance_bias",
    "with c as (select s_nationkey as slide_id, row_number() over (partition by s_nationkey order by s_suppkey) - 1 as i, s_suppkey % 7 as x, s_suppkey // 7 as y from supplier), h as (select unnest([0, 1, 2, 3, 4, 5])::int as head, unnest([0.25, 0.0625, 0.015625, 0.00390625, 0.5, 0.125])::double as slope) select a.slide_id, head, a.i, b.i as j, round(case when a.i = 0 or b.i = 0 then 0 else -slope * sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) end, 6) + 0.0 as bias from c a join c b using (slide_id) cross join h",
)
def distance_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bias of attention heads by the distance of cells; cell 0 is the class token."""
    from pyspark.sql import Window

    number = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")).cast("long") - 1
    cells = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("slide_id"), number.alias("i"), (F.col("s_suppkey") % 7).alias("x"), F.expr("s_suppkey div 7").alias("y"))
    return op.distance_bias(cells, 6).withColumn("bias", F.round("bias", 6) + 0.0)


@register("token_pooling", "with t as (select vec_id, embedding::double[] as v from embeddings), p as (select vec_id, v, unnest(range(0, 16))::int as pos from t) select vec_id, pos, round(case when pos < 8 then v[pos + 1] else (v[24 + pos - 7] + v[32 + pos - 7] + v[40 + pos - 7] + v[48 + pos - 7] + v[56 + pos - 7]) / 5 end, 6) as value from p")
def token_pooling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class token and the mean of the patch tokens after two registers (A10)."""
    tokens = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(as_double("embedding"), i * 8 + 1, F.lit(8)))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(op.class_and_patch_tokens(tokens, 2)).alias("pos", "value")).withColumn("value", F.round("value", 6))


@register("sample_tiles", f"with {FEATURES_SQL} select slide_id % 3 as sample_id, row_number() over (partition by slide_id % 3 order by slide_id * 7 % 20, tile_index) - 1 as sample_index, slide_id, tile_index from features")
def sample_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of the slides of each sample, one after another."""
    f = features(spark, sf_dir)
    slides = f.select("slide_id").distinct().selectExpr("slide_id", "slide_id % 3 as sample_id", "slide_id * 7 % 20 as slide_order")
    return op.sample_tiles(f, slides).select("sample_id", F.col("sample_index").cast("long").alias("sample_index"), "slide_id", "tile_index")


@register("pooled_vectors", f"with {FEATURES_SQL}, p as (select slide_id, pos, round(avg(value), 6) as mean, round(max(value), 6) as most from each_ group by 1, 2), n as (select slide_id, count(*) as n_tiles from features group by 1) select slide_id, pos, mean, most, n_tiles from p join n using (slide_id)")
def pooled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and max pooling by sums of whole arrays (A2, A3, A5)."""
    f = features(spark, sf_dir)
    flat = lambda how, name: op.pooled_vectors(f, how).select("slide_id", F.posexplode("embedding").alias("pos", name), "n_tiles")
    both = flat("mean", "mean").join(flat("max", "most").drop("n_tiles"), ["slide_id", "pos"])
    return both.select("slide_id", "pos", F.round("mean", 6).alias("mean"), F.round("most", 6).alias("most"), "n_tiles")


@register("padded_bags", "with b as (select s_nationkey as slide_id, list(s_acctbal order by s_suppkey) as v from supplier group by 1) select slide_id, i::int as place, case when i < len(v) then v[i + 1] else 0 end as value, i < len(v) as real from b cross join (select unnest(range(0, 40)) as i)")
def padded_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bags filled up to one length with a mask."""
    held = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("slide_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_acctbal"))), lambda x: x["s_acctbal"]).alias("values"))
    padded = op.padded_bags(held, 40)
    return padded.select("slide_id", F.posexplode(F.arrays_zip("values", "mask")).alias("place", "z")).where("place < 40").select("slide_id", "place", F.col("z.values").alias("value"), F.col("z.mask").alias("real"))


@register(
    "class_splits",
    "with f as (select unnest([0, 1, 2])::int as fold), r as (select fold, c_custkey, (c_nationkey % 3)::int as label, row_number() over (partition by fold, c_nationkey % 3 order by md5('7:' || fold || ':' || c_custkey), c_custkey) as r from customer cross join f), s as (select *, case when r <= 4 then 'val' when r <= 9 then 'test' else 'train' end as split from r), n as (select *, row_number() over (partition by fold, label, split order by c_custkey) as p, count(*) over (partition by fold, label, split) as n from s) select fold, c_custkey, split from n where label < 2 and (split <> 'train' or p <= ceil(n * 0.5))",
)
def class_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation, test and half of the other rows of two classes, three times."""
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "int(c_nationkey % 3) as label")
    return sm.class_splits(rows, "label", "c_custkey", {0: 4, 1: 4}, {0: 5, 1: 5}, 3, 7, 0.5)


@register("test_subset", "with r as (select o_orderkey, row_number() over (order by md5('1:' || o_orderkey), o_orderkey) as r, count(*) over () as n from orders) select o_orderkey from r where r <= floor(n * 0.1)")
def test_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all rows by hash."""
    return sm.share(table(spark, sf_dir, "orders"), "o_orderkey", 0.1, 1).select("o_orderkey")


@register(
    "slide_status",
    "select c_custkey as slide_id, case when c_custkey % 13 = 0 then 'failed' when n is null then 'skipped' else 'ok' end as status, coalesce(n, 0) as tiles, case when c_custkey % 13 = 0 then 'unreadable' end as error from customer left join (select o_custkey, count(*) as n from orders group by 1) on o_custkey = c_custkey",
)
def slide_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slides that failed, that have no tiles, and the others (P15, batch failure)."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("slide_id"))
    tiles = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("slide_id"))
    return batches.slide_status(c, tiles, c.where("slide_id % 13 = 0").withColumn("error", F.lit("unreadable")))


@register("split_rows", "with g as (select distinct l_suppkey as slide_id from lineitem), r as (select slide_id, row_number() over (order by md5('42:' || slide_id), slide_id) as r, greatest(1, round_even(count(*) over () * 0.2, 0)) as t, greatest(1, round_even(count(*) over () * 0.1, 0)) as v from g), s as (select slide_id, case when r <= t then 'test' when r <= t + v then 'val' else 'train' end as split from r) select split, count(*) as n, count(distinct slide_id) as slides from lineitem join s on slide_id = l_suppkey group by 1")
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each split; none may be empty."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("slide_id"))
    split = sm.group_split(rows.distinct(), "slide_id", 0.2, 0.1, 42)
    joined = rows.join(split, "slide_id")
    parts = [sm.selected(joined, name).agg(F.lit(name).alias("split"), F.count("*").alias("n"), F.countDistinct("slide_id").alias("slides")) for name in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
