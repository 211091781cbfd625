"""Packing of tokenised documents into sequences of bounded length.

A document gives full sequences and one shorter tail. Tails are packed by cutting stock over the histogram of their lengths, and the
tails of each length are ranked, so the plan says for every rank which sequence and place it has.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tilewright.llm.arrow_rows import with_made
from tilewright.llm.bpe_codec import slices
from tilewright.llm.cutting_stock import segments, solve
from tilewright.workspace import Workspace

#: Documents that are ranked by one task.
RANKED_TOGETHER = 50_000


def tokenised(docs: DataFrame, carry: list[str], tokenizer: str, end_id: int, capacity: int, text: str) -> DataFrame:
    """The columns ``carry`` as ``_c<i>``, ``n`` tokens with the end id, and ``crcs``: of each piece of ``capacity`` ids, then the tail."""

    def start():
        from tilewright.llm.library_coder import library_coder

        coder = library_coder(tokenizer)

        def make(texts):
            n, crcs = [], []
            for a, b in slices(texts):
                for ids in coder.encode(texts[a:b]):
                    raw = np.append(ids, end_id).astype("<u4")
                    n.append(len(raw))
                    crcs.append([zlib.crc32(raw[k : k + capacity].tobytes()) for k in range(0, len(raw), capacity)])
            return [n, crcs]

        return make

    held = docs.select(*[docs[f"`{c}`"].alias(f"_c{i}") for i, c in enumerate(carry)], F.coalesce(docs[text], F.lit("")).alias("_text"))
    return with_made(held, held.columns[:-1], [held["_text"]], "n long, crcs array<long>", start)


def pack(docs: DataFrame, carry: list[str], tokenizer: str, end_id: int = 0, capacity: int = 1024, text: str = "text") -> DataFrame:
    """The columns ``carry``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``: a row for each piece.

    Sequences are numbered from 0 without gaps: full ones first, then those of the plan. Null and empty texts are one piece, the end id.
    Ranks are counted in buckets of rows, so a length, or one text, that a third of all documents share is ranked by many tasks, and the
    plan's size depends on the capacity only. Tails of one length are alike to the plan: which gets which place follows the rows' order
    within a bucket. A very long text is many full pieces; a task holds its ids once. Repeated rows are packed each; an empty table
    gives an empty one. Carried columns go through unchanged, by place, so their names can't clash.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "packing")
    done = ws.save(tokenised(docs, carry, tokenizer, end_id, capacity, text).withColumn("_row", F.monotonically_increasing_id()), "tokenised").withColumns({"tail": F.col("n") % capacity, "full": F.expr(f"n div {capacity}")})
    histogram = {int(r["tail"]): int(r["count"]) for r in done.groupBy("tail").count().collect()}  # one row for each length under the capacity
    buckets = max(8, -(-sum(histogram.values()) // RANKED_TOGETHER))
    keys = [f"_c{i}" for i in range(len(carry))]
    done = done.withColumn("bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    counts = done.groupBy("bucket", "tail").agg(F.count("*").alias("docs"), F.sum("full").alias("fulls"))
    earlier = Window.partitionBy("tail").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = ws.save(counts.withColumn("rank_base", F.coalesce(F.sum("docs").over(earlier), F.lit(0))), "counts")
    sums = counts.groupBy("bucket").agg(F.sum("fulls").alias("fulls"))
    full_base = sums.withColumn("full_base", F.coalesce(F.sum("fulls").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("bucket", "full_base")
    full_count = counts.agg(F.coalesce(F.sum("fulls"), F.lit(0))).first()[0]
    in_bucket = Window.partitionBy("bucket").orderBy("tail", "_row")
    in_tail = Window.partitionBy("bucket", "tail").orderBy("_row")
    ranked = (
        done.withColumns({"rank": F.row_number().over(in_tail) - 1, "fulls_before": F.sum("full").over(in_bucket.rowsBetween(Window.unboundedPreceding, -1))})
        .join(counts.select("bucket", "tail", "rank_base"), ["bucket", "tail"])
        .join(full_base, "bucket")
        .select(*keys, "n", "crcs", "tail", (F.col("rank") + F.col("rank_base")).alias("rank"), (F.coalesce("fulls_before", F.lit(0)) + F.col("full_base")).alias("first_full"))
    )
    plan = segments(solve({length: count for length, count in histogram.items() if length}, capacity), int(full_count))
    if len(plan) > capacity * capacity:  # every length in every pattern of a basis
        raise ValueError("the plan is larger than its bound")
    by_length: dict[int, tuple[list[int], list[tuple[int, int, int, int]]]] = {}
    for length, first, times, sequence, offset in plan:
        firsts, where = by_length.setdefault(length, ([], []))
        firsts.append(first)
        where.append((first, times, sequence, offset))
    shared = spark.sparkContext.broadcast(by_length)
    added = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = shared.value
        for batch in batches:
            row_of, start, length, crc, sequence, offset, total = [], [], [], [], [], [], []
            values = (batch.column(k).to_pylist() for k in range(len(keys), batch.num_columns))
            for i, (n, crcs, tail, rank, full) in enumerate(zip(*values)):
                k = n // capacity
                row_of += [i] * len(crcs)
                total += [n] * len(crcs)
                start += range(0, n, capacity)
                crc += crcs
                length += [capacity] * k
                sequence += range(full, full + k)
                offset += [0] * k
                if tail:
                    firsts, where = by_length[tail]
                    first, times, base, at = where[bisect_right(firsts, rank) - 1]
                    length.append(tail)
                    sequence.append(base + (rank - first) // times)
                    offset.append(at + (rank - first) % times * tail)
            rows = pa.array(row_of, pa.int64())
            made = [pa.array(x, pa.int64()) for x in (start, length, crc, total, sequence, offset)]
            yield pa.RecordBatch.from_arrays([batch.column(k).take(rows) for k in range(len(keys))] + made, names=[*keys, *added])

    placed = ranked.mapInArrow(place, StructType([*ranked.schema[: len(carry)], *(StructField(x, LongType()) for x in added)]))
    return placed.select(*[placed[k].alias(c) for k, c in zip(keys, carry)], *added)


def sequences(pieces: DataFrame, capacity: int = 1024, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, ids, n_tokens)`` from ``pieces(sequence_id, offset, ids)``; padded to the capacity unless the length is a power of two."""
    joined = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"))  # capacity ids at most
    ids = F.flatten(F.transform("held", lambda x: x["ids"]))
    joined = joined.select("sequence_id", ids.alias("ids"), F.size(ids).alias("n_tokens"))
    power = F.expr("bit_count(n_tokens) = 1")
    padded = F.concat(F.col("ids"), F.array_repeat(F.lit(pad_id), F.lit(capacity) - F.col("n_tokens")))
    return joined.select("sequence_id", F.when(power, F.col("ids")).otherwise(padded).alias("ids"), "n_tokens")
