import math

import numpy as np
import pytest

from tilewright.operators import distances, metrics, ranking, sampling
from tilewright.workspace import Workspace


def one(df):
    return df.first()[0]


def pairs(spark, a, b):
    return spark.createDataFrame(list(zip(a, b)), "a int, b int")


def test_clustering_metrics_leave_noise_out(spark):
    noisy = pairs(spark, [0, 0, 0, 1, 1, 1, 0, 1], [5, 5, 5, 7, 7, 7, -1, -1])
    assert [round(one(f(noisy)), 12) for f in (metrics.nmi, metrics.ari, metrics.purity)] == [1.0, 1.0, 1.0]
    single = pairs(spark, [3, 3, 3], [1, 1, 1])
    assert one(metrics.nmi(single)) == 1.0 and one(metrics.ari(single)) == 1.0
    split = pairs(spark, [3, 3, 3, 3], [1, 1, 2, 2])
    assert one(metrics.nmi(split)) == 0.0 and one(metrics.ari(split)) == 0.0
    noise = pairs(spark, [0, 1], [-1, -1])
    assert all(math.isnan(one(f(noise))) for f in (metrics.nmi, metrics.ari, metrics.purity))


@pytest.mark.parametrize("ys", [[], [0, 0, 0], [1, 1], [0, 1, 1, 0]])
def test_ranking_metrics_are_defined_for_any_labels(spark, ys):
    rows = spark.createDataFrame([(y, (i % 3) / 3) for i, y in enumerate(ys)], "y int, p double")
    auc, ap = one(metrics.roc_auc(rows)), one(metrics.average_precision(rows))
    assert math.isnan(auc) == (len({*ys}) < 2) and (ap == 0.0) == (1 not in ys)
    assert metrics.roc_points(rows).count() == metrics.pr_points(rows).count() == len({i % 3 for i in range(len(ys))})
    assert all(r["recall"] == 1.0 for r in metrics.pr_points(rows).collect() if 1 not in ys)


def test_auc_over_many_ranges(spark):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 3000), np.round(rng.random(3000) ** 4, 5)
    rows = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    assert abs(one(metrics.roc_auc(rows)) - sampling.auc_of(y, p)) < 1e-12
    ranks = {r["p"]: r["rank"] for r in metrics.rank_normalised(rows, "p").collect()}
    order = np.sort(p)
    for v in (p.min(), p.max(), p[7]):
        at = np.flatnonzero(order == v)
        assert abs(ranks[v] - (at.mean() + 1) / 3000) < 1e-12
    run = ranking.with_running_sums(rows.groupBy("p").count(), "p", ["count"])
    assert {r["p"]: r["run_count"] for r in run.collect()}[p.max()] == 3000


def test_plans_have_no_single_task_over_rows(spark):
    rows = spark.range(1000).selectExpr("int(id % 2) as y", "id / 1000D as p")
    for df in (metrics.roc_points(rows), metrics.rank_normalised(rows, "p"), sampling.group_split(rows.selectExpr("p as g"), "g", 0.2, 0.1, 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        single = [line for line in plan.splitlines() if "SinglePartition" in line]
        assert len(single) <= 2 and "_range" in plan or "_part" in plan  # only the sums of ranges


def test_macro_auc_leaves_absent_classes_out(spark):
    rows = [(y, c, 1.0 if y == c else 0.0) for y in (0, 1, 1) for c in (0, 1, 2)]
    assert one(metrics.macro_auc(spark.createDataFrame(rows, "y int, class int, p double"))) == 1.0
    assert math.isnan(one(metrics.macro_auc(spark.createDataFrame([], "y int, class int, p double"))))


def test_calibration_bins_are_closed_on_the_right(spark):
    edges = np.linspace(0, 1, 11)
    rows = spark.createDataFrame([(1, float(p)) for p in [*edges, 0.3, 0.30000000000000004, 0.7000000000000001]], "y int, p double")
    got = {r["mean_p"]: r["bin"] for p in rows.select("p").distinct().collect() for r in metrics.calibration(rows.where(rows["p"] == p["p"])).collect()}
    for p, b in got.items():
        assert b == int(np.searchsorted(edges[1:-1], p)), p


def test_silhouette_and_importance(spark):
    rng = np.random.default_rng(2)
    x, b = rng.standard_normal((40, 3)), [i % 3 - 1 if i < 39 else 9 for i in range(40)]
    rows = spark.createDataFrame([(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, b))], "id long, v array<double>, b int")
    keep = [i for i in range(40) if b[i] != -1]
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    want = []
    for i in keep:
        same = [j for j in keep if j != i and b[j] == b[i]]
        if not same:
            want.append(0.0)
            continue
        own, nxt = d[i, same].mean(), min(d[i, [j for j in keep if b[j] == c]].mean() for c in {b[j] for j in keep} - {b[i]})
        want.append((nxt - own) / max(own, nxt))
    assert abs(one(metrics.silhouette(rows)) - np.mean(want)) < 1e-9
    assert math.isnan(one(metrics.silhouette(rows.where("b = 0"))))
    signed = spark.createDataFrame([(0, 0, -5.0), (0, 1, 2.0), (0, 2, 1.0)], "class int, feature int, coefficient double")
    assert [tuple(r) for r in metrics.importance(signed, 2).collect()] == [(1, 2.0), (2, 1.0)]


def silhouette_by_pairs(ids, vectors, classes):
    """Every distance by itself, as the SQL has it; vectors that are None or of another width have none."""
    far = {}
    for i, v, b in zip(ids, vectors, classes):
        far.setdefault((i, b), {})
        for j, w, c in zip(ids, vectors, classes):
            if i != j and v is not None and w is not None and len(v) == len(w):
                far[i, b].setdefault(c, []).append(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum()))
    each = []
    for (_, b), of in far.items():
        own, other = [np.mean(d) for c, d in of.items() if c == b], [np.mean(d) for c, d in of.items() if c != b]
        if not own:
            each.append(0.0)
        elif other:
            top = max(own[0], min(other))
            each.append((min(other) - own[0]) / top if top else 0.0)
    return np.mean(each)


def test_silhouette_of_more_rows_than_a_sample_has(spark):
    rng = np.random.default_rng(5)
    b = rng.integers(0, 3, 5600)
    x = rng.standard_normal((5600, 4)) + b[:, None]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    to = np.stack([d[:, b == c].sum(axis=1) / (np.sum(b == c) - (b == c)) for c in range(3)], axis=1)
    own = to[np.arange(5600), b]
    to[np.arange(5600), b] = np.inf
    want = ((to.min(axis=1) - own) / np.maximum(own, to.min(axis=1))).mean()
    rows = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, b))], "id long, v array<double>, b int")
    assert abs(one(metrics.silhouette(rows)) - want) < 1e-9


def test_silhouette_in_small_blocks_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(distances, "BLOCK_ROWS", 7)
    monkeypatch.setattr(distances, "HELD_SUMS", 20)
    rng = np.random.default_rng(6)
    ids = [f"t{i}" for i in range(60)] + ["t0", "t1", "t2"]  # ids that come again
    vectors = [(1e6 + rng.standard_normal(3)).tolist() for _ in ids]  # far from the origin
    classes = [i % 4 for i in range(60)] + [0, 1, 2]
    for i in (5, 9, 13, 17, 18):
        vectors[i] = vectors[1]  # copies
    vectors[20], vectors[21], vectors[22], vectors[23], vectors[27] = None, [1.0, 2.0], [1.5, 2.0], [3.0], [0.5, 0.5]
    classes[30] = 7  # alone in its class
    nulls = [v if k != 40 else [*v[:2], None] for k, v in enumerate(vectors)]
    vectors[40] = None
    rows = spark.createDataFrame(list(zip(ids, nulls, classes)), "id string, v array<double>, b int")
    assert abs(one(metrics.silhouette(rows)) - silhouette_by_pairs(ids, vectors, classes)) < 1e-9
    far = spark.createDataFrame([(0, [1.0], 0), (1, [3.0], 0), (2, [float("inf")], 1), (3, [1e200], 2)], "id long, v array<double>, b int")
    told = {(r["i"], r["c"]): r["s"] for r in distances.class_distances(Workspace(spark, "far"), far.selectExpr("id as i", "v", "b")).groupBy("i", "c").sum("s").withColumnRenamed("sum(s)", "s").collect()}
    assert told[0, 0] == 2 and told[0, 1] == told[1, 2] == told[2, 0] == float("inf") and (2, 1) not in told


def test_majority_and_errors(spark):
    rows = spark.createDataFrame([(0, 1, -1), (0, 1, 4), (0, 2, 4), (1, 2, -1)], "slide_id int, a int, b int")
    assert [tuple(r) for r in metrics.slide_clusters(rows).collect()] == [(0, 1, 4)]
    assert math.isnan(one(metrics.error_rate(spark.createDataFrame([], "y int, y_pred int"))))
