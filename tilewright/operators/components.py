"""Connected components by root contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.operators.spread import spread_join
from tilewright.workspace import Workspace


#: Contractions whose renamings are put together in one plan before they are written.
FOLDED = 8


def connected_components(ws: Workspace, edges: DataFrame, name: str = "cc", most: int | None = None) -> DataFrame:
    """``(node, component)`` for every end of ``edges(u, v)``; the component is its smallest node.

    Each round hooks every root to its smallest neighbour, jumps once, and renames the ends of the remaining edges, so the edge
    table shrinks geometrically on ordinary graphs and by hops of doubling length on chains. Nothing is gathered per node: a hub
    costs one partial minimum, and is no hot key of a join (:func:`spread_join`). Null ends are ignored, self links and repeated edges change nothing, an empty table gives an empty one.

    With ``most`` rounds at most, nodes of one component are connected, but not all that are connected need share one.
    """
    pairs = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u is not null and v is not null")
    links = ws.save(pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), f"{name}-e0")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = nodes.select("node", F.col("node").alias("component"))
    k, held = 0, []
    while not links.isEmpty() and (most is None or k < most):
        ends = links.select("u", "v").union(links.select(F.col("v"), F.col("u")))
        parent = ends.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")).select("node", F.least("node", "low").alias("up"))
        parent = ws.save(parent, f"{name}-p{k}")
        upper = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jumped = ws.save(spread_join(parent, upper, ["up"], "left").select("node", F.coalesce("top", "up").alias("root")), f"{name}-j{k}")
        renamed = spread_join(links, jumped.select(F.col("node").alias("u"), F.col("root").alias("a")), ["u"], "inner")
        renamed = spread_join(renamed, jumped.select(F.col("node").alias("v"), F.col("root").alias("b")), ["v"], "inner").where("a <> b")
        links = ws.save(renamed.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), f"{name}-e{k + 1}")
        labels = spread_join(labels, jumped.select(F.col("node").alias("component"), "root"), ["component"], "left").select("node", F.coalesce("root", "component").alias("component"))
        ws.drop(f"{name}-e{k}", f"{name}-p{k}")
        held.append(f"{name}-j{k}")
        k += 1
        if len(held) == FOLDED:
            labels = ws.save(labels, f"{name}-l{k}")
            ws.drop(*held)
            held = []
    labels = ws.save(labels, f"{name}-labels")
    ws.drop(*held)
    return labels
