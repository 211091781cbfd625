import math
import zlib

import numpy as np
import pandas as pd
import pytest

from tilewright.operators import sampling


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_hash_seeded_cap_of_a_slide(spark):
    tiles = spark.range(1000).selectExpr("'948176.patch_features' as slide_id", "id as tile_index")
    got = [i for _, i in rows(sampling.capped_numpy(tiles, 10))]
    assert got == [352, 367, 404, 418, 450, 480, 561, 578, 588, 877]
    assert got == sorted(np.random.default_rng(zlib.crc32(b"948176.patch_features")).choice(1000, 10, replace=False).tolist())


def test_seeded_cap_equals_numpy(spark):
    tiles = spark.range(60).selectExpr("if(id < 50, 'a', 'b') as slide_id", "if(id < 50, id, id - 50) as tile_index")
    got = rows(sampling.capped_numpy(tiles, 20, 42))
    want = sorted(np.random.default_rng(42).choice(50, 20, replace=False).tolist())
    assert [i for s, i in got if s == "a"] == want and [i for s, i in got if s == "b"] == list(range(10))


def test_pooled_draws(spark):
    whole = lambda sizes, most, how: rows(sampling.pooled_numpy(spark, sizes, most, how))
    got = whole([60, 40], 20, "proportional")
    assert [sum(s == k for s, _ in got) for k in (0, 1)] == [12, 8]
    rng = np.random.default_rng(42)
    a, b = rng.choice(np.arange(60), 12, replace=False), rng.choice(np.arange(60, 100), 8, replace=False)
    assert got == sorted([(0, int(i)) for i in a] + [(1, int(i) - 60) for i in b])
    assert [sum(s == k for s, _ in whole([80, 40], 10, "equal")) for k in (0, 1)] == [5, 5]
    assert [sum(s == k for s, _ in whole([2, 40], 10, "equal")) for k in (0, 1)] == [2, 5]
    assert len(whole([50], 100, "random")) == 50
    want = sorted(np.random.default_rng(42).choice(100, 20, replace=False).tolist())
    assert [s * 60 + i for s, i in whole([60, 40], 20, "random")] == want
    with pytest.raises(ValueError, match="bogus"):
        whole([1], 1, "bogus")


def test_quota_of_the_last_slide_is_never_negative(spark):
    sizes = spark.createDataFrame([(0, i, 1) for i in range(10)], "sample_id long, slide_id long, size long")
    got = [r["quota"] for r in sampling.proportional_quotas(sizes, 7).orderBy("slide_id").collect()]
    assert got == sampling.quotas_of([1] * 10, 7, "proportional") and got[-1] == 0


def test_group_splits(spark):
    groups = [f"s{i}" for i in range(30)]
    split = sampling.group_split_numpy(groups, 0.2, 0.1, 42)
    order = np.random.RandomState(42).permutation(np.sort(np.array(groups))).tolist()
    assert [s for s in order[:6]] == [s for s in order if split[s] == "test"] and [split[s] for s in order[6:9]] == ["val"] * 3
    tiny = sampling.group_split_numpy(["a", "b", "c"], 0.01, 0.01, 1)
    assert sorted(tiny.values()) == ["test", "train", "val"]
    df = sampling.group_split(spark.createDataFrame([(g,) for g in groups], "g string"), "g", 0.2, 0.1, 42)
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert counts == {"test": 6, "val": 3, "train": 21}
    with pytest.raises(ValueError):
        sampling.selected(df, "none")


def test_bootstrap_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 2, 50), rng.random(50)
    low, high = sampling.bootstrap_interval(pd.DataFrame({"y": y, "p": p}), 50, 42)
    draws, found = np.random.RandomState(42), []
    for _ in range(50):
        at = draws.randint(0, 50, 50)
        pos, neg = p[at][y[at] == 1], p[at][y[at] == 0]
        if len(pos) and len(neg):
            found.append(np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]))
    assert abs(low - np.percentile(found, 2.5)) < 1e-12 and abs(high - np.percentile(found, 97.5)) < 1e-12
    assert all(map(math.isnan, sampling.bootstrap_interval(pd.DataFrame({"y": [1, 1], "p": [0.1, 0.2]}), 5, 1)))
