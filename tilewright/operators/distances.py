"""Sums of euclidean distances between all rows and all classes, block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tilewright.workspace import Workspace

#: Rows of a block at most, and its numbers at most; a task holds two blocks and a strip of their distances.
BLOCK_ROWS, BLOCK_NUMBERS = 2048, 1 << 19
#: Blocks that a table has at least, as far as they keep :data:`FEW_ROWS`, so that all cores have pairs of them.
BLOCKS, FEW_ROWS = 64, 512
#: Rows whose distances are made at once, so that they stay in the cache.
STRIP_ROWS = 128
#: Parts that the blocks are dealt to, and numbers of a part beyond which there are more. A task is a pair of parts and tells the sums of both, so
#: what is moved grows with the parts.
PARTS, PART_NUMBERS = 12, 1 << 22
#: Sums that a task holds before it hands them on.
HELD_SUMS = 1 << 21
#: Squares of distances under this share of both squared lengths are summed again from differences.
NEAR = 1e-6


def distances(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Euclidean distances of the rows of ``x`` from those of ``y``, some rows of ``x`` at a time, each with the first one's place, in one buffer.

    They come from a product of matrices, or from differences where that loses digits or isn't finite.
    """
    buffer, step = np.empty((min(STRIP_ROWS, len(x)), len(y))), max(1, BLOCK_NUMBERS // max(1, x.shape[1]))
    with np.errstate(all="ignore"):
        centre = np.median(x[:: max(1, len(x) // 16)], axis=0)  # a common shift keeps distances
        centre = np.where(np.isfinite(centre), centre, 0.0)
        a, b = x - centre, y - centre
        la, lb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        left = np.column_stack([a * -2, la, np.ones(len(a))])
        right = np.ascontiguousarray(np.column_stack([b, np.ones(len(b)), lb]).T)
        most = NEAR * (la.max() + lb.max())
    for row in range(0, len(x), STRIP_ROWS):
        with np.errstate(all="ignore"):
            part = left[row : row + STRIP_ROWS]
            strip = np.matmul(part, right, out=buffer[: len(part)])
            i = j = np.empty(0, np.int64)
            if not strip.min() > most:  # some may be near
                i, j = np.nonzero(~(strip > most))
                near = ~(strip[i, j] > NEAR * (la[row + i] + lb[j]))
                i, j = i[near], j[near]
            np.sqrt(strip, out=strip)
            for at in range(0, len(i), step):
                p, q = i[at : at + step], j[at : at + step]
                apart = x[row + p] - y[q]
                strip[p, q] = np.sqrt(np.einsum("ij,ij->i", apart, apart))
        yield row, strip


class _Block:
    """The rows of a packed block, by class."""

    def __init__(self, rows: pa.StructArray, width: int):
        at = {f.name: k for k, f in enumerate(rows.type)}
        ids, classes, vectors = (rows.flatten()[at[c]] for c in "ibv")
        coded = classes.dictionary_encode()
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        self.codes = codes[order]
        self.v = vectors.flatten().to_numpy().reshape(len(rows), width)[order]
        self.ids, self.classes = ids.take(pa.array(order)), classes.take(pa.array(order))
        self.names = coded.dictionary.to_pylist()
        self.counts = np.bincount(codes, minlength=len(self.names))
        self.starts = np.cumsum(self.counts) - self.counts

    def same_ids(self, other: _Block) -> np.ndarray | None:
        """Which rows of both have one id; None where none have."""
        if other is not self and not pc.any(pc.is_in(self.ids, value_set=other.ids)).as_py():
            return None
        code = pa.concat_arrays([self.ids, other.ids]).dictionary_encode().indices.to_numpy()
        return code[: len(self.ids), None] == code[None, len(self.ids) :]


def class_distances(ws: Workspace, rows: DataFrame) -> DataFrame:
    """``(i, b, c, n, s)`` from ``(i, v, b)``: the number and the sum of the distances of row ``i`` of class ``b`` to the rows of class ``c`` with another ``i``.

    A pair can be told in several rows, to be summed. Vectors of different widths have no distance, nor has a vector that is null or holds a
    null. Every pair of rows is measured once, in pairs of packed blocks that Spark deals out; the work is the square of the rows, what is
    moved is the rows times the classes.
    """
    whole = rows.where("i is not null and v is not null and not exists(v, x -> x is null)").withColumn("width", F.size("v"))
    n, widest = whole.agg(F.count("*"), F.max("width")).first()
    a_block = max(1, min(BLOCK_ROWS, max(FEW_ROWS, n // BLOCKS), BLOCK_NUMBERS // max(1, widest or 0)))
    blocks = max(1, -(-n // a_block))
    parts = min(blocks, max(PARTS, n * (widest or 0) // PART_NUMBERS))
    dealt = whole.withColumn("block", F.pmod(F.xxhash64("i", "v"), F.lit(blocks))).repartition(parts, "block", "width")
    grouped = dealt.groupBy("block", "width").agg(F.collect_list(F.struct("i", "b", "v")).alias("rows"))
    packed = ws.save(grouped.withColumn("part", F.spark_partition_id()), "blocks")
    other = packed.select(*[F.col(c).alias(f"{c}2") for c in packed.columns])
    once = "(part < part2 or part = part2 and block <= block2) and abs(width - width2) < 1"  # no equality, which would send all blocks of a width to one task
    pairs = packed.join(other, F.expr(once))
    schema = rows.select("i", "b", F.col("b").alias("c"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("s")).schema
    kinds = [to_arrow_type(f.dataType) for f in schema]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0

        def told() -> Iterator[pa.RecordBatch]:
            for (_, _, c), (ids, classes, n, s) in held.items():
                some = pa.array(n > 0)
                columns = [ids, classes, pa.array([c] * len(n), type=kinds[2]), pa.array(n, type=kinds[3]), pa.array(s, type=kinds[4])]
                yield pa.RecordBatch.from_arrays([x.cast(k).filter(some) for x, k in zip(columns, kinds, strict=True)], names=schema.names)
            held.clear()

        def add(of: tuple, block: _Block, names: list, n: np.ndarray, s: np.ndarray) -> int:
            new = 0
            for k, c in enumerate(names):
                known = held.get((*of, c))
                if known is None:
                    held[*of, c] = [block.ids, block.classes, n[:, k].copy(), s[:, k].copy()]
                    new += len(s)
                else:
                    known[2] += n[:, k]
                    known[3] += s[:, k]
            return new

        for batch in batches:
            part = {c: batch.column(c) for c in batch.schema.names}
            for r in range(batch.num_rows):
                p, q, width = part["block"][r].as_py(), part["block2"][r].as_py(), part["width"][r].as_py()
                x = _Block(part["rows"][r].values, width)
                y = x if p == q else _Block(part["rows2"][r].values, width)
                same = x.same_ids(y)
                n, m = np.tile(y.counts, (len(x.v), 1)), np.tile(x.counts, (len(y.v), 1))
                if same is not None:
                    n -= np.add.reduceat(same, y.starts, axis=1, dtype=np.int64)
                    m -= np.add.reduceat(same, x.starts, axis=0, dtype=np.int64).T
                to_y, to_x = np.empty((len(x.v), len(y.names))), np.zeros((len(x.names), len(y.v)))
                for at, d in distances(x.v, y.v):
                    end = at + len(d)
                    if same is not None:
                        d[same[at:end]] = 0.0
                    np.add.reduceat(d, y.starts, axis=1, out=to_y[at:end])
                    for k in range(x.codes[at], x.codes[end - 1] + 1) if p != q else ():  # faster than reduceat along this axis
                        to_x[k] += d[max(0, x.starts[k] - at) : x.starts[k] + x.counts[k] - at].sum(axis=0)
                size += add((p, width), x, y.names, n, to_y)
                if p != q:
                    size += add((q, width), y, x.names, m, to_x.T)
                if size > HELD_SUMS:
                    yield from told()
                    size = 0
        yield from told()

    return pairs.mapInArrow(measure, schema)
