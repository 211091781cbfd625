"""Near-duplicate vectors by NN-descent.

A neighbour graph starts from blocks of random hyperplane signatures and is refined by local joins: the neighbours of a node, in both
directions, meet each other, and each keeps its best. Edges at or over the threshold link. Equal vectors are collapsed before. A list that
holds nothing but links is saturated: it can't hold all, so its vector is searched against the vectors of all other components, in
bounded blocks; then the components with a saturated list are compared whole, in bounded blocks too. Recall is
audited against brute force on a stated number of unsaturated queries, each counting alike, and further rounds with new signatures run
while it is too low; if it stays so, every vector is searched as a saturated one is, which loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.operators.components import connected_components
from tilewright.operators.spread import spread_join
from tilewright.workspace import Workspace


@dataclass(frozen=True)
class Descent:
    threshold: float = 0.9
    neighbours: int = 8
    #: Tables of signatures at least; more bits take more tables (:func:`tables_for`).
    tables: int = 10
    rounds: int = 3
    #: Rounds end when less than this share of the lists' places change.
    settled: float = 0.002
    #: Vectors that meet in one group, and in a block of an enlarged component.
    group: int = 512
    #: Saturated vectors that are sent to every task at once, to be searched against all others.
    sent: int = 4096
    audit_queries: int = 500
    #: Further lots of queries are drawn until so many have few links, up to so many lots.
    audit_linked: int = 100
    audit_lots: int = 8
    least_recall: float = 0.97
    repeats: int = 3
    seed: int = 7


def unit_rows(raw: list[bytes], kind: str) -> np.ndarray:
    """Rows of unit length in double precision from the bytes of vectors of one dimension."""
    x = np.frombuffer(b"".join(raw), kind).astype(np.float64).reshape(len(raw), -1)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])  # exact, and no square over- or underflows
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


#: Cosines this near to the threshold are summed again, in one order for every pair wherever it meets.
CLOSE = 1e-9


def cosines(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Cosines of all pairs of unit rows. Whether one reaches ``threshold`` doesn't depend on the rows that it is computed with."""
    s = np.clip(a @ b.T, -1.0, 1.0)
    i, j = np.nonzero(np.abs(s - threshold) <= CLOSE)
    for k in range(0, len(i), 4096):
        p, q = i[k : k + 4096], j[k : k + 4096]
        s[p, q] = np.einsum("ij,ij->i", a[p], b[q])
    return s


def usable(embeddings: DataFrame, key: str, vector: str) -> tuple[DataFrame, str]:
    """``(id, dim, vec)`` of the vectors that can link, one for each id, as raw bytes, and the numpy kind of the bytes."""
    v = F.col("v")
    kind, element = ("<f4", "float") if embeddings.schema[vector].dataType.elementType.typeName() == "float" else ("<f8", "double")
    held = embeddings.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(f"array<{element}>").alias("v")).where("id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = held.where(finite & F.exists("v", lambda x: x != 0))
    held = held.groupBy("id").agg(F.min(v).alias("v"))

    def raw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "dim": [len(x) for x in pdf["v"]], "vec": [np.asarray(x, kind).tobytes() for x in pdf["v"]]})

    return held.mapInPandas(raw, "id long, dim int, vec binary"), kind


def collapse(ws: Workspace, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``found(id, dim, vec)`` one row ``(id, dim, vec, w)`` for each distinct vector, its least id and number, and ``(id, first)`` of all."""
    held = ws.save(found, "found")
    vectors = ws.save(held.groupBy("dim", "vec").agg(F.min("id").alias("id"), F.count("*").alias("w")).select("id", "dim", "vec", "w"), "vectors")
    several = vectors.where("w > 1").select("dim", "vec", F.col("id").alias("first"))
    firsts = ws.save(held.join(several, ["dim", "vec"], "left").select("id", F.coalesce("first", "id").alias("first")), "firsts")
    ws.drop("found")
    return vectors, firsts


def tables_for(bits: int, how: Descent) -> int:
    """Tables after which a pair at the threshold shares a signature of ``bits`` hyperplanes with probability ``how.least_recall``."""
    together = min(1 - 1e-9, (1 - np.arccos(how.threshold) / np.pi) ** bits)
    return max(how.tables, int(np.ceil(np.log(1 - how.least_recall) / np.log1p(-together))))


def signatures(vectors: DataFrame, kind: str, bits: int, how: Descent, repeat: int) -> DataFrame:
    """``(key, id, vec)``: each vector once for each table, keyed by table, dimension and the sides of ``bits`` hyperplanes."""
    tables = tables_for(bits, how)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                x = unit_rows(list(part["vec"]), kind)
                planes = np.random.default_rng([how.seed, repeat, dim]).standard_normal((dim, tables * bits))
                sides = (x @ planes > 0).reshape(len(x), tables, bits)
                codes = (sides * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
                for t in range(tables):
                    yield pd.DataFrame({"t": t, "dim": dim, "code": codes[:, t], "id": part["id"].to_numpy(), "vec": part["vec"].to_numpy()})

    rows = vectors.mapInPandas(sign, "t int, dim int, code long, id long, vec binary")
    return rows.select(F.xxhash64("t", "dim", "code").alias("key"), "id", "vec")


def split_groups(rows: DataFrame, how: Descent, salt: int) -> DataFrame:
    """``rows(key, id, ...)`` with keys of over ``how.group`` rows split at random, each key anew, so that no group is larger by more than chance."""
    over = rows.groupBy("key").agg(F.ceil(F.count("*") / how.group).alias("parts")).where("parts > 1")  # one key in how.group rows at most
    parts = spread_join(rows, over, ["key"], "left").withColumn("part", F.pmod(F.xxhash64("id", "key", F.lit(salt)), F.coalesce("parts", F.lit(1))))
    return parts.withColumn("key", F.xxhash64("key", "part")).drop("parts", "part")


def meet(rows: DataFrame, kind: str, top: int, threshold: float) -> DataFrame:
    """``(u, v, sim)``: for each row of a group of ``rows(key, id, vec)`` its ``top`` most similar others there."""
    dealt = rows.repartition("key").sortWithinPartitions("key")

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            keys = pdf["key"].to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            held = pdf.iloc[last:]  # the last group may go on
            yield from groups(pdf.iloc[:last])
        if held is not None:
            yield from groups(held)

    def groups(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(pdf):
            return
        keys, ids, raw = pdf["key"].to_numpy(), pdf["id"].to_numpy(), list(pdf["vec"])
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        us, vs, sims = [], [], []
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2 or len({len(r) for r in raw[a:b]}) > 1:
                continue
            x = unit_rows(raw[a:b], kind)
            s = cosines(x, x, threshold)
            np.fill_diagonal(s, -2.0)
            k = min(top, b - a - 1)
            best = np.argpartition(-s, k - 1, axis=1)[:, :k]
            us.append(np.repeat(ids[a:b], k))
            vs.append(ids[a:b][best].ravel())
            sims.append(np.take_along_axis(s, best, 1).ravel())
        if us:
            yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs), "sim": np.concatenate(sims)})

    return dealt.mapInPandas(join, "u long, v long, sim double").where("u <> v")


def best_lists(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` most similar neighbours of each node, ties by id; a pair that was found twice counts once."""
    once = pairs.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return once.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def refine(ws: Workspace, graph: DataFrame, vectors: DataFrame, kind: str, how: Descent, name: str) -> DataFrame:
    """One round: neighbours of a node in both directions meet in groups of bounded size."""
    ends = graph.select(F.col("u").alias("key"), F.col("v").alias("id")).union(graph.select(F.col("v"), F.col("u"))).distinct()
    rows = split_groups(ends, how, salt=1).join(vectors.select("id", "vec"), "id")
    found = meet(rows.select("key", "id", "vec"), kind, max(2, how.neighbours // 2), how.threshold)
    return ws.save(best_lists(graph.unionByName(found), how.neighbours), name)


def descend(ws: Workspace, vectors: DataFrame, kind: str, how: Descent, repeat: int, known: DataFrame | None) -> DataFrame:
    """``graph(u, v, sim)`` after the rounds of one repeat; ``known`` is an earlier graph to go on from."""
    n = vectors.count()
    bits = max(1, int(np.ceil(np.log2(max(2, n / (how.group / 2))))))
    start = meet(split_groups(signatures(vectors, kind, bits, how, repeat), how, salt=repeat), kind, how.neighbours, how.threshold)
    graph = ws.save(best_lists(start if known is None else start.unionByName(known), how.neighbours), f"graph-{repeat}-0")
    for r in range(how.rounds):
        after = refine(ws, graph, vectors, kind, how, f"graph-{repeat}-{r + 1}")
        changed = after.join(graph.select("u", "v"), ["u", "v"], "left_anti").count()
        ws.drop(f"graph-{repeat}-{r}")
        graph = after
        if changed <= how.settled * how.neighbours * n:
            break
    return graph


def leaving(ws: Workspace, placed: DataFrame, full: DataFrame, kind: str, how: Descent, name: str) -> DataFrame:
    """``(u, v)``: links of the vectors ``full(id)`` with vectors of other components; at least one for each two components that such links join.

    ``placed(id, dim, vec, component)`` holds all vectors. ``how.sent`` of the wanted ones at a time meet all, without a shuffle.
    """
    wanted = placed.join(full, "id")
    parts = -(-full.count() // how.sent)
    wanted = ws.save(wanted.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(max(1, parts))).cast("int")), f"{name}-wanted")
    found = ws.spark.createDataFrame([], "u long, v long")
    for part in range(parts):
        rows = wanted.where(F.col("part") == part).collect()  # about how.sent rows
        held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for dim in {r["dim"] for r in rows}:
            own = [r for r in rows if r["dim"] == dim]
            held[dim] = np.array([r["id"] for r in own]), np.array([r["component"] for r in own]), unit_rows([bytes(r["vec"]) for r in own], kind)
        shared = ws.spark.sparkContext.broadcast(held)

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for at in range(0, len(pdf), how.group):
                    for dim, rows in pdf.iloc[at : at + how.group].groupby("dim"):
                        if dim not in shared.value:
                            continue
                        ids, classes, q = shared.value[dim]
                        theirs = rows["component"].to_numpy()
                        i, j = np.nonzero((cosines(q, unit_rows(list(rows["vec"]), kind), how.threshold) >= how.threshold) & (classes[:, None] != theirs[None, :]))
                        if len(i):
                            met = pd.DataFrame({"u": ids[i], "v": rows["id"].to_numpy()[j], "a": classes[i], "b": theirs[j]})
                            yield met.drop_duplicates(["a", "b"])[["u", "v"]]

        found = found.union(ws.save(placed.mapInPandas(search, "u long, v long"), f"{name}-leaving-{part}"))
        shared.unpersist()
    return found


def enlarge(ws: Workspace, graph: DataFrame, vectors: DataFrame, kind: str, how: Descent, name: str, whole: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(classes, counts, full)``: ``(node, component)`` of the vectors that link, ``(id, n_links, n_near)``: linked rows and distinct vectors
    besides the own copies, and the saturated ``(id)``; with ``whole`` every vector is taken as saturated.

    Saturated vectors are searched against all other components, so every link of theirs lies within a component after that. Components
    with a saturated list are then compared whole, in pairs of blocks; their links are only counted, as the component is known.
    """
    over = ws.save(graph.where(F.col("sim") >= how.threshold), f"{name}-over")
    links = ws.save(over.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), f"{name}-links")
    classes = ws.save(connected_components(ws, links, f"{name}-cc"), f"{name}-classes")
    held = over.groupBy(F.col("u").alias("id")).agg(F.count("*").alias("n")).where(F.col("n") >= how.neighbours)
    full = ws.save((vectors if whole else held).select("id"), f"{name}-full")
    if not full.isEmpty():
        placed = vectors.join(classes.withColumnRenamed("node", "id"), "id", "left").select("id", "dim", "vec", F.coalesce("component", "id").alias("component"))
        placed = ws.save(placed, f"{name}-placed")
        out = leaving(ws, placed, full, kind, how, name)
        if not out.isEmpty():
            classes = ws.save(connected_components(ws, links.union(out), f"{name}-cc-all"), f"{name}-classes-all")
        ws.drop(f"{name}-placed", f"{name}-wanted")
    dense = classes.join(full.select(F.col("id").alias("node")), "node").select("component").distinct()
    sizes = classes.join(dense, "component").groupBy("component").agg(F.ceil(F.count("*") / how.group).cast("int").alias("blocks"))
    inside = ws.save(classes.join(sizes, "component"), f"{name}-inside")
    placed = inside.withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = placed.select("component", "node", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("p"))
    spread = spread.select(F.xxhash64("component", F.least("b", "p"), F.greatest("b", "p")).alias("key"), F.col("node").alias("id"), "b", (F.col("b") <= F.col("p")).alias("low"), (F.col("b") >= F.col("p")).alias("high"))
    rows = spread.join(vectors.select("id", "vec", "w"), "id")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, low, high, w = pdf["id"].to_numpy(), pdf["low"].to_numpy(), pdf["high"].to_numpy(), pdf["w"].to_numpy()
        x = unit_rows(list(pdf["vec"]), kind)
        if (low & high).all():  # a block with itself
            s = cosines(x, x, how.threshold) >= how.threshold
            np.fill_diagonal(s, False)
            return pd.DataFrame({"id": ids, "n": s @ w, "near": s.sum(axis=1)})
        s = cosines(x[low], x[high], how.threshold) >= how.threshold
        n, near = np.concatenate([s @ w[high], s.T @ w[low]]), np.concatenate([s.sum(axis=1), s.sum(axis=0)])
        return pd.DataFrame({"id": np.concatenate([ids[low], ids[high]]), "n": n, "near": near})

    sums = [F.sum("n").alias("n_links"), F.sum("near").alias("n_near")]
    dense_counts = rows.groupBy("key").applyInPandas(count, "id long, n long, near long").groupBy("id").agg(*sums)
    sparse = links.join(inside.select(F.col("node").alias("u")), "u", "left_anti")
    ends = sparse.select("u", "v").union(sparse.select("v", "u")).toDF("id", "other").join(vectors.select(F.col("id").alias("other"), F.col("w").alias("n")), "other")
    sparse_counts = ends.withColumn("near", F.lit(1).cast("long")).groupBy("id").agg(*sums)
    counts = ws.save(dense_counts.unionByName(sparse_counts), f"{name}-counts")
    return classes, counts, full


def audit(vectors: DataFrame, kind: str, counts: DataFrame, full: DataFrame, how: Descent) -> float:
    """Mean share of its true links that was found, over vectors with links, chosen by hash; 1.0 where none has links.

    Links that were found have been computed, so a vector's count of them over its true count is the share of pairs. Every vector counts alike, and those with fewer than ``how.neighbours`` links count apart too: the lower mean is returned. Vectors in
    ``full(id)`` are not asked, as they have been searched against all. Lots of ``how.audit_queries`` are drawn until ``how.audit_linked``
    vectors with few links are among them.
    """
    asked = vectors.join(full, "id", "left_anti").orderBy(F.xxhash64("id", F.lit(how.seed)), "id").limit(how.audit_queries * how.audit_lots)
    asked = asked.select("id", "dim", "vec").collect()  # a stated number of rows
    shares, few = [], []
    for at in range(0, len(asked), how.audit_queries):
        queries = asked[at : at + how.audit_queries]
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for dim in {q["dim"] for q in queries}:
            own = [q for q in queries if q["dim"] == dim]
            held[dim] = np.array([q["id"] for q in own]), unit_rows([bytes(q["vec"]) for q in own], kind)
        shared = vectors.sparkSession.sparkContext.broadcast(held)

        def brute(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for dim, part in pdf.groupby("dim"):
                    if dim in shared.value:
                        ids, q = shared.value[dim]
                        true = (cosines(q, unit_rows(list(part["vec"]), kind), how.threshold) >= how.threshold).sum(axis=1) - np.isin(ids, part["id"])
                        yield pd.DataFrame({"id": ids, "true_links": true})

        truth = vectors.select("id", "dim", "vec").mapInPandas(brute, "id long, true_links long").groupBy("id").agg(F.sum("true_links").alias("t")).where("t > 0")
        for r in truth.join(counts, "id", "left").select("t", F.least("t", F.coalesce("n_near", F.lit(0))).alias("f")).collect():
            shares.append(r["f"] / r["t"])
            if r["t"] < how.neighbours:
                few.append(r["f"] / r["t"])
        shared.unpersist()
        if len(few) >= how.audit_linked:
            break
    return min((float(np.mean(x)) for x in (shares, few) if x), default=1.0)


def near_vectors(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", how: Descent = Descent()) -> DataFrame:
    """``(key, n_links, component_id, kept)``: a row for each row of ``embeddings``.

    Vectors that are null, zero, or hold a null or non-finite component link with nothing, nor do vectors of different dimensions. Rows with
    one id count as one vector (the least of them) and all get its result; a null id gets 0 links and a null component. An empty table gives an
    empty one. A pair with a cosine of the threshold links; vectors are scaled exactly before they are squared, so tiny and huge ones count as
    others do. Other columns aren't read, so their names can't clash.
    """
    ws = Workspace(embeddings.sparkSession, "descent")
    found, kind = usable(embeddings, key, vector)
    vectors, firsts = collapse(ws, found)
    graph, classes, counts = None, None, None
    for repeat in range(how.repeats):
        graph = descend(ws, vectors, kind, how, repeat, graph)
        classes, counts, full = enlarge(ws, graph, vectors, kind, how, f"final-{repeat}")
        if audit(vectors, kind, counts, full, how) >= how.least_recall:
            break
    else:
        classes, counts, _ = enlarge(ws, graph, vectors, kind, how, "final-whole", whole=True)
    own = vectors.select("id", F.col("w") - 1).toDF("first", "copies")
    told = own.join(counts.withColumnRenamed("id", "first"), "first", "left").join(classes.select(F.col("node").alias("first"), F.col("component").alias("c")), "first", "left")
    told = told.select("first", (F.coalesce("n_links", F.lit(0)) + F.col("copies")).alias("n_links"), F.coalesce("c", "first").alias("c"))
    told = firsts.join(told, "first").select("id", "n_links", "c")
    out = embeddings.select(F.col(key).cast("long").alias("id")).join(told, "id", "left")
    out = out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "id").alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
