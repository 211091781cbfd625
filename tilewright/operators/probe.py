"""Linear probes: logistic regression on scaled features, its grid search over group folds, and attention models over bags of tiles."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.operators.features import moments, scaled_vectors


@dataclass(frozen=True)
class Probe:
    """A fitted model, the one row of moments that it was scaled by, and its parameters."""

    model: LogisticRegressionModel
    scale: DataFrame
    penalty: str
    strength: float
    classes: list = field(default_factory=list)

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``probs``, in the order of the classes."""
        scaled = rows.crossJoin(F.broadcast(self.scale))
        features = F.transform(F.col("embedding").cast("array<double>"), lambda v, i: (v - F.get("m", i)) / F.get("s", i))
        held = scaled.withColumn("features", array_to_vector(features)).drop("m", "s")
        return self.model.transform(held).withColumn("probs", vector_to_array("probability")).drop("features", "rawPrediction", "probability", "prediction")

    def coefficients(self) -> DataFrame:
        """``(class, feature, coefficient)``: one class for two labels."""
        matrix = self.model.coefficientMatrix.toArray()
        rows = [(c, f, float(v)) for c, line in enumerate(matrix) for f, v in enumerate(line)]
        return self.scale.sparkSession.createDataFrame(rows, "class int, feature int, coefficient double")


def fit_probe(rows: DataFrame, penalty: str = "l2", strength: float = 1.0, max_iter: int = 1000) -> Probe:
    """Logistic regression on ``rows(embedding, y)``, whose labels are 0, 1, ... ``strength`` multiplies the sum of losses, as a C does."""
    if penalty not in ("l1", "l2"):
        raise ValueError(f"penalty {penalty!r} isn't configured here")
    scale = moments(rows)
    n = rows.count()
    held = scaled_vectors(rows).select(array_to_vector("scaled").alias("features"), F.col("y").cast("double").alias("label"))
    fit = LogisticRegression(regParam=1.0 / (strength * max(n, 1)), elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False, maxIter=max_iter, tol=1e-8)
    model = fit.fit(held)
    return Probe(model, rows.sparkSession.createDataFrame(scale.collect(), scale.schema), penalty, strength, list(range(model.numClasses)))


def group_folds(rows: DataFrame, group: str, label: str, folds: int) -> dict:
    """The fold of each group: groups with the most uneven labels first, each to the fold whose label shares it keeps most even.

    Counts a group and label are gathered: a row a slide.
    """
    counts: dict = {}
    for r in rows.groupBy(group, label).agg(F.count("*").alias("n")).collect():
        counts.setdefault(r[group], {})[r[label]] = r["n"]
    labels = sorted({y for c in counts.values() for y in c})
    table = {g: np.array([c.get(y, 0) for y in labels], float) for g, c in counts.items()}
    total = sum(table.values(), np.zeros(len(labels)))
    held = np.zeros((folds, len(labels)))
    placed = {}
    for g in sorted(table, key=lambda g: (-float(np.std(table[g])), str(g))):
        best = None
        for f in range(folds):
            held[f] += table[g]
            with np.errstate(divide="ignore", invalid="ignore"):
                uneven = float(np.mean(np.nan_to_num(np.std(held / total, axis=0))))
            key = (uneven, float(held[f].sum()), f)
            held[f] -= table[g]
            best = min(best or key, key)
        placed[g] = best[2]
        held[best[2]] += table[g]
    return placed


def search_probe(rows: DataFrame, score, strengths: list[float], penalties: list[str], folds: int, group: str = "slide_id") -> tuple[Probe, DataFrame]:
    """The probe with the best mean score over group folds, fitted on all rows, and ``(penalty, strength, fold, score)``.

    ``score(rows with probs) -> float``. A fold that lacks a class, where the score isn't a number, doesn't count.
    """
    if "elasticnet" in penalties:
        raise ValueError("elasticnet needs a ratio, which this search doesn't have")
    spark = rows.sparkSession
    placed = group_folds(rows, group, "y", folds)
    kind = rows.schema[group].dataType.simpleString()
    dealt = rows.join(F.broadcast(spark.createDataFrame(list(placed.items()), f"`{group}` {kind}, fold int")), group).cache()
    found = []
    for penalty in penalties:
        for strength in strengths:
            for fold in range(folds):
                train, held = dealt.where(F.col("fold") != fold), dealt.where(F.col("fold") == fold)
                if train.select("y").distinct().count() < 2:
                    continue
                found.append((penalty, float(strength), fold, float(score(fit_probe(train, penalty, strength).probabilities(held)))))
    dealt.unpersist()
    scores = spark.createDataFrame(found, "penalty string, strength double, fold int, score double")
    usable: dict = {}
    for penalty, strength, _, value in found:
        if not np.isnan(value):
            usable.setdefault((penalty, strength), []).append(value)
    if not usable:
        raise ValueError("no fold could be scored")
    penalty, strength = max(usable, key=lambda k: np.mean(usable[k]))
    return fit_probe(rows, penalty, strength), scores


@dataclass(frozen=True)
class AttentionTraining:
    """``hidden`` units of each of ``heads`` attention heads; Adam with ``rate`` for ``epochs``."""

    hidden: int = 32
    heads: int = 1
    gated: bool = False
    epochs: int = 20
    rate: float = 1e-3
    seed: int = 42


class AttentionModel:
    """Attention pooling of a bag and a logistic output, trained by gradients in numpy."""

    def __init__(self, width: int, how: AttentionTraining):
        rng = np.random.default_rng(how.seed)
        draw = lambda *shape: rng.standard_normal(shape) * np.sqrt(2.0 / sum(shape))
        self.how = how
        self.p = {"w": draw(how.heads, width, how.hidden), "g": draw(how.heads, width, how.hidden), "a": draw(how.heads, how.hidden), "o": draw(how.heads * width), "b": np.zeros(1)}

    def forward(self, x: np.ndarray) -> tuple[float, dict]:
        t = np.tanh(np.einsum("nd,hdk->hnk", x, self.p["w"]))
        g = 1 / (1 + np.exp(-np.einsum("nd,hdk->hnk", x, self.p["g"]))) if self.how.gated else np.ones_like(t)
        logits = np.einsum("hnk,hk->hn", t * g, self.p["a"])
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        weights = e / e.sum(axis=1, keepdims=True)
        pooled = weights @ x
        z = float(pooled.ravel() @ self.p["o"] + self.p["b"][0])
        return 1 / (1 + np.exp(-z)), {"t": t, "g": g, "weights": weights, "pooled": pooled}

    def gradients(self, x: np.ndarray, y: float) -> tuple[float, dict]:
        """The loss of one bag and its gradients."""
        p, c = self.forward(x)
        dz = p - y
        d_pooled = dz * self.p["o"].reshape(c["pooled"].shape)
        d_weights = d_pooled @ x.T
        d_logits = c["weights"] * (d_weights - (d_weights * c["weights"]).sum(axis=1, keepdims=True))
        d_hidden = d_logits[:, :, None] * self.p["a"][:, None, :]
        d_t = d_hidden * c["g"] * (1 - c["t"] ** 2)
        d_g = d_hidden * c["t"] * c["g"] * (1 - c["g"]) if self.how.gated else np.zeros_like(d_t)
        loss = -(y * np.log(max(p, 1e-12)) + (1 - y) * np.log(max(1 - p, 1e-12)))
        return loss, {
            "w": np.einsum("nd,hnk->hdk", x, d_t), "g": np.einsum("nd,hnk->hdk", x, d_g), "a": np.einsum("hn,hnk->hk", d_logits, c["t"] * c["g"]),
            "o": dz * c["pooled"].ravel(), "b": np.array([dz]),
        }

    def fit(self, bags: list[np.ndarray], labels: list[int], held: tuple[list[np.ndarray], list[int]] | None = None) -> AttentionModel:
        """Adam over the bags in seeded order; keeps the parameters with the least loss on ``held``, if it is given."""
        rng = np.random.default_rng(self.how.seed + 1)
        m, v, step, best = {k: 0 * x for k, x in self.p.items()}, {k: 0 * x for k, x in self.p.items()}, 0, None
        for _ in range(self.how.epochs):
            for i in rng.permutation(len(bags)):
                _, grads = self.gradients(bags[i], labels[i])
                step += 1
                for k, grad in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad * grad
                    self.p[k] = self.p[k] - self.how.rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
            if held and held[0]:
                loss = float(np.mean([self.gradients(x, y)[0] for x, y in zip(*held)]))
                if best is None or loss < best[0]:
                    best = loss, {k: x.copy() for k, x in self.p.items()}
        if best:
            self.p = best[1]
        return self
