"""Feature vectors of tiles: pooling, attention, scaling, adapters, classifier filters, tokens, slots of ragged bags."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.vectors import as_double, dot, l2_normalise


def pooled(features: DataFrame, how: str, by: str = "slide_id") -> DataFrame:
    """``(slide_id, pos, value)``: mean or max over the tiles of a slide for each dimension. A slide without tiles gives no rows."""
    if how not in ("mean", "max"):
        raise ValueError(f"unknown pooling {how}")
    each = features.select(by, F.posexplode(as_double("embedding")).alias("pos", "value"))
    return each.groupBy(by, "pos").agg((F.avg if how == "mean" else F.max)("value").alias("value"))


def pooled_vectors(features: DataFrame, how: str, by: str = "slide_id") -> DataFrame:
    """``(slide_id, embedding, n_tiles)``: mean or max over tiles, by summaries of whole arrays.

    Each task sums the arrays of a slide in its batches, and only those sums are shuffled: a row a slide and task instead of one a dimension. A null
    vector counts as no tile; vectors of different widths in one slide are an error.
    """
    if how not in ("mean", "max"):
        raise ValueError(f"unknown pooling {how}")
    kind = features.schema[by].dataType.simpleString()
    schema = f"g {kind}, v array<double>, n long"
    join = np.add.reduce if how == "mean" else np.maximum.reduce

    def merge(keys, vectors, counts) -> pd.DataFrame:
        frame = pd.DataFrame({"g": keys, "n": counts})
        out = []
        for g, at in frame.groupby("g", dropna=False).indices.items():
            out.append((g, join(np.stack([vectors[i] for i in at])).tolist(), int(frame["n"].to_numpy()[at].sum())))
        return pd.DataFrame(out, columns=["g", "v", "n"])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield merge(pdf["g"], [np.asarray(v, np.float64) for v in pdf["v"]], np.ones(len(pdf), np.int64))

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        return merge(pdf["g"], [np.asarray(v, np.float64) for v in pdf["v"]], pdf["n"].to_numpy())

    sums = features.where("embedding is not null").select(F.col(by).alias("g"), as_double("embedding").alias("v")).mapInPandas(partial, schema)
    # A slide has one partial sum a batch of the scan, so a group is far smaller than the slide.
    whole = sums.groupBy("g").applyInPandas(final, schema)
    vector = F.transform("v", lambda x: x / F.col("n")) if how == "mean" else F.col("v")
    return whole.select(F.col("g").alias(by), vector.alias("embedding"), F.col("n").alias("n_tiles"))


def attention_pooled(features: DataFrame, logit: Column) -> DataFrame:
    """``(slide_id, pos, value)``: tiles weighted by the softmax of ``logit`` within their slide."""
    w = Window.partitionBy("slide_id")
    weighed = features.withColumn("a", logit).withColumn("e", F.exp(F.col("a") - F.max("a").over(w))).withColumn("p", F.col("e") / F.sum("e").over(w))
    each = weighed.select("slide_id", "p", F.posexplode(as_double("embedding")).alias("pos", "value"))
    return each.groupBy("slide_id", "pos").agg(F.sum(F.col("p") * F.col("value")).alias("value"))


def linear(v: Column, rows: list[list[float]], bias: list[float]) -> Column:
    """``W v + b``; weights are parameters of the job."""
    return F.array(*[dot(v, F.array(*map(F.lit, r))) + b for r, b in zip(rows, bias, strict=True)])


def attention_logit(v: Column, weights: list[list[float]], bias: list[float], out: list[float], out_bias: float, gate: tuple[list[list[float]], list[float]] | None = None, keep: Column | None = None) -> Column:
    """The logit of one attention head: ``out . tanh(W v + b)``, gated by ``sigmoid(G v + g)`` if given; -1e9 where ``keep`` is false."""
    hidden = F.transform(linear(v, weights, bias), lambda x: F.tanh(x))
    if gate:
        hidden = F.zip_with(hidden, F.transform(linear(v, *gate), lambda x: 1 / (1 + F.exp(-x))), lambda a, b: a * b)
    logit = dot(hidden, F.array(*map(F.lit, out))) + out_bias
    return logit if keep is None else F.when(keep, logit).otherwise(F.lit(-1e9))


def attention_pooled_heads(features: DataFrame, logits: list[Column]) -> DataFrame:
    """``(slide_id, pos, value)``: the pooled vectors of several heads, one after another; ``pos`` counts through."""
    w = Window.partitionBy("slide_id")
    held = features.select("slide_id", as_double("embedding").alias("v"), *[x.alias(f"a{i}") for i, x in enumerate(logits)])
    held = held.withColumns({f"e{i}": F.exp(F.col(f"a{i}") - F.max(f"a{i}").over(w)) for i in range(len(logits))})
    held = held.withColumns({f"p{i}": F.col(f"e{i}") / F.sum(f"e{i}").over(w) for i in range(len(logits))})
    weighed = lambda i: F.transform("v", lambda x: x * F.col(f"p{i}"))
    both = F.flatten(F.array(*map(weighed, range(len(logits)))))
    return held.select("slide_id", F.posexplode(both).alias("pos", "value")).groupBy("slide_id", "pos").agg(F.sum("value").alias("value"))


def logistic_filter(features: DataFrame, weights: list[float], bias: float, threshold: float) -> DataFrame:
    """Adds ``probability`` and keeps rows strictly over ``threshold``."""
    z = dot(as_double("embedding"), F.array(*map(F.lit, weights))) + bias
    return features.withColumn("probability", 1 / (1 + F.exp(-z))).where(F.col("probability") > threshold)


def ridge_adapted(v: Column, mean: list[float], scale: list[float], rows: list[list[float]], bias: list[float]) -> Column:
    """``normalise(W ((v - mean) / scale) + b)``."""
    x = F.transform(v, lambda c, i: (c - F.get(F.array(*map(F.lit, mean)), i)) / F.get(F.array(*map(F.lit, scale)), i))
    return l2_normalise(linear(x, rows, bias))


def moments(features: DataFrame) -> DataFrame:
    """One row ``(m, s)``: mean and population deviation of each dimension as arrays; a constant dimension has 1.

    Sums of values and of squares are taken by dimension; the two arrays are what is sent on, however many rows there are.
    """
    each = features.select(F.posexplode(as_double("embedding")).alias("pos", "value")).groupBy("pos").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    packed = each.agg(F.array_sort(F.collect_list(F.struct("pos", "m", "s"))).alias("x"))  # a row a dimension
    return packed.select(F.transform("x", lambda x: x["m"]).alias("m"), F.transform("x", lambda x: F.when(x["s"] > 0, x["s"]).otherwise(1.0)).alias("s"))


def scaled_vectors(features: DataFrame, fitted: DataFrame | None = None) -> DataFrame:
    """``features`` with ``scaled``: each vector minus the mean over the deviation of ``fitted`` (default: of its own rows)."""
    row = F.broadcast(moments(features if fitted is None else fitted))  # one row
    joined = features.crossJoin(row)
    at = F.transform(as_double("embedding"), lambda v, i: (v - F.get("m", i)) / F.get("s", i))
    return joined.withColumn("scaled", at).drop("m", "s")


def standardised(features: DataFrame) -> DataFrame:
    """``(tile_index, pos, value)``: each dimension minus its mean over its population deviation; a constant dimension is divided by 1."""
    return scaled_vectors(features).select("tile_index", F.posexplode("scaled").alias("pos", "value"))


def class_and_patch_tokens(tokens: Column, registers: int = 0) -> Column:
    """The first token and then the mean of the patch tokens, which follow ``registers`` others, of an ``array<array<double>>``."""
    patches = F.slice(tokens, 2 + registers, F.greatest(F.size(tokens) - 1 - registers, F.lit(0)))
    n = F.size(patches)
    zero = F.transform(F.get(tokens, F.lit(0)), lambda x: F.lit(0.0))
    total = F.aggregate(patches, zero, lambda s, t: F.zip_with(s, t, lambda a, b: a + b))
    return F.concat(F.get(tokens, F.lit(0)), F.transform(total, lambda x: x / n))


def alibi_slopes(heads: int) -> list[float]:
    """Slopes of the distance bias of each attention head: a geometric sequence, filled up from the next power of two."""
    low = 2 ** int(math.floor(math.log2(heads)))
    own = [2 ** (-8 * (i + 1) / low) for i in range(low)]
    return own + [2 ** (-4 * (2 * i + 1) / low) for i in range(heads - low)]


def distance_bias(cells: DataFrame, heads: int) -> DataFrame:
    """``(slide_id, head, i, j, bias)`` of all pairs of a slide's cells ``(slide_id, i, x, y)``: minus the head's slope times their distance.

    Cell 0 is the class token: its row and column are 0. All pairs are what the bias is; a slide has some thousand cells, and pairs
    are never gathered.
    """
    slopes = F.explode(F.array(*[F.struct(F.lit(h).alias("head"), F.lit(s).alias("slope")) for h, s in enumerate(alibi_slopes(heads))]))
    other = cells.select("slide_id", F.col("i").alias("j"), F.col("x").alias("u"), F.col("y").alias("v"))
    met = cells.join(other, "slide_id").withColumn("h", slopes)
    far = F.sqrt(((F.col("x") - F.col("u")) * (F.col("x") - F.col("u")) + (F.col("y") - F.col("v")) * (F.col("y") - F.col("v"))).cast("double"))
    inner = (F.col("i") > 0) & (F.col("j") > 0)
    return met.select("slide_id", "h.head", "i", "j", F.when(inner, -F.col("h.slope") * far).otherwise(0.0).alias("bias"))


def padded_bags(bags: DataFrame, longest: int) -> DataFrame:
    """``(slide_id, values, mask)`` from ``(slide_id, values)``: bags filled with 0 up to ``longest``, and which places are real."""
    held = bags.select("slide_id", F.col("values").alias("_held"), F.size("values").alias("_n"))
    short = F.greatest(F.lit(longest) - F.col("_n"), F.lit(0))
    mask = F.transform(F.sequence(F.lit(0), F.lit(longest - 1)), lambda i: i < F.col("_n"))
    return held.select("slide_id", F.concat("_held", F.array_repeat(F.lit(0.0), short)).alias("values"), mask.alias("mask"))


def sample_tiles(features: DataFrame, slides: DataFrame) -> DataFrame:
    """Tiles of the slides of each sample, one after another: ``(sample_id, sample_index, slide_id, tile_index, ...)``.

    ``slides`` is ``(slide_id, sample_id, slide_order)``. Places are counted from the sizes of slides, so no window runs over a sample's tiles;
    tile indices of a slide run from 0 without gaps, and slides without tiles take no place.
    """
    sizes = features.groupBy("slide_id").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("sample_id").orderBy("slide_order").rowsBetween(Window.unboundedPreceding, -1)
    bases = slides.join(sizes, "slide_id").withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("slide_id", "sample_id", "_base")
    return features.join(bases, "slide_id").withColumn("sample_index", F.col("_base") + F.col("tile_index")).drop("_base")
