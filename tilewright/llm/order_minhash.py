"""Near-duplicates by Order MinHash.

A text is the sequence of its five-word shingles, each labelled with its occurrence number, so that the labelled shingles of a text are
distinct. One sketch takes the ``members`` labelled shingles with least hash and writes them in the order of the text; texts that share
a sketch share these shingles in that order, which tracks edit similarity rather than set overlap. Candidates share a sketch and are verified
by banded alignment of their shingle sequences. Short texts have too few shingles for sketches: they meet by each of the labelled shingles
that any similar text shares one of.

Copies are collapsed before anything is compared. The members of a bucket are not paired with each other: in each round a bucket is a star
around one centre, what the alignment joins becomes one class, and only classes that a bucket still holds apart are compared
further, until a bucket has one class or every pair of its classes' texts that shares a rare shingle has been compared.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.arrow_rows import with_made
from tilewright.operators.components import connected_components
from tilewright.operators.spread import SENT_ROWS, spread_join
from tilewright.workspace import Workspace, opened

WORD = re.compile(r"\w+")
#: Labelled shingles whose hashes for all sketches are held at once.
BLOCK = 1 << 13


@dataclass(frozen=True)
class Near:
    """``similarity`` is matched shingles over all distinct ones: ``s / (a + b - s)`` for an alignment that matches s."""

    words: int = 5
    similarity: float = 0.8
    sketches: int = 40
    members: int = 6
    #: A text of fewer shingles has no sketches but meets every text that is similar enough.
    sketched_from: int = 30
    seed: int = 20_240_229


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, in lower case."""
    return WORD.findall(text.lower()) if text else []


def shingle_hashes(words: list[str], k: int) -> np.ndarray:
    """64-bit hash of each run of ``k`` words; a shorter text is one shingle of all its words."""
    if not words:
        return np.zeros(0, np.uint64)
    known: dict[str, int] = {}
    for w in {*words}:
        known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - k + 1)
    out = np.full(n, len(words) if len(words) < k else k, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(min(k, len(words))):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Each shingle's hash mixed with how many equal ones stand before it."""
    if not len(shingles):
        return shingles
    order = np.argsort(shingles, kind="stable")
    held = shingles[order]
    new = np.r_[True, held[1:] != held[:-1]]
    place = np.arange(len(held))
    occurrence = np.empty(len(held), np.uint64)
    occurrence[order] = (place - np.maximum.accumulate(np.where(new, place, 0))).astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.where(occurrence == 0, shingles, mix(shingles + occurrence * np.uint64(0xD6E8FEB86659FD93)))


def sketch(shingles: np.ndarray, how: Near) -> np.ndarray:
    """Bucket keys of one text, none for a text without shingles: ``how.sketches`` of a long text, and its :func:`least_marks` if it
    or a text that is similar to it can be too short for sketches."""
    marks = labelled(shingles)
    n, m = len(marks), how.members
    if not n:
        return np.zeros(0, np.int64)
    single = least_marks(marks, how.similarity).view(np.int64) if how.similarity * n < how.sketched_from else np.zeros(0, np.int64)
    if n < how.sketched_from:
        return single
    salts = mix(np.arange(1, how.sketches + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(how.seed))
    if n <= m:
        picks = np.broadcast_to(np.arange(n), (how.sketches, n))
    else:
        picks = least_places(marks, salts, m)
    key = salts.copy()
    with np.errstate(over="ignore"):
        for j in range(picks.shape[1]):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + marks[picks[:, j]])
    return np.r_[key.view(np.int64), single]


def spare(n: int, similarity: float) -> int:
    """How many first of ``n`` labelled shingles, in an order that all texts use, any text as similar as that must share one of.

    Both texts must share ``similarity`` of the longer one's labelled shingles at least: before the first one that two texts share,
    neither can have more than it can do without.
    """
    return n - int(np.ceil(similarity * n - 1e-9)) + 1


def least_marks(marks: np.ndarray, similarity: float) -> np.ndarray:
    """The labelled shingles of least hash, so many that any text as similar as that has one of them among its own least."""
    return np.sort(marks)[: spare(len(marks), similarity)]


def least_places(marks: np.ndarray, salts: np.ndarray, m: int) -> np.ndarray:
    """For each salt the places of the ``m`` marks with least hash, in the order of the text.

    Only hashes under a bound that a few times ``m`` of them pass are looked at further; a salt for which too few pass sorts them all.
    """
    n = len(marks)
    bound = np.uint64(min(2**64 - 1, int((4 * m + 16) / n * 2**64)))
    rows, places, hashes = [], [], []
    with np.errstate(over="ignore"):
        for a in range(0, n, BLOCK):
            h = (marks[a : a + BLOCK][None, :] ^ salts[:, None]) * np.uint64(0x9E3779B97F4A7C15)
            r, c = np.nonzero(h <= bound)
            rows.append(r)
            places.append(c + a)
            hashes.append(h[r, c])
    row, place, value = np.concatenate(rows), np.concatenate(places), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, place = row[order], place[order]
    starts = np.searchsorted(row, np.arange(len(salts) + 1))
    short = np.flatnonzero(np.diff(starts) < m)
    at = np.minimum(starts[:-1, None] + np.arange(m), max(0, len(place) - 1))
    picks = place[at] if len(place) else np.zeros((len(salts), m), np.int64)
    with np.errstate(over="ignore"):
        for k in short:
            picks[k] = np.argpartition((marks ^ salts[k]) * np.uint64(0x9E3779B97F4A7C15), m - 1)[:m]
    return np.sort(picks, axis=1)


def aligned(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether an alignment of two sequences matches ``s`` places with ``s / (len(a) + len(b) - s) >= similarity``.

    Longest common subsequence by bit vectors, limited to the band of diagonals that such an alignment can touch. Common ends
    are matched first, which loses nothing.
    """
    n, m = len(a), len(b)
    need = similarity * (n + m) / (1 + similarity) - 1e-9  # least number of matches
    if min(n, m) < need:
        return False
    short = min(n, m)
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if len(differs) else short
    rest = short - head
    differs = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1])
    tail = int(differs[0]) if len(differs) else rest
    if head + tail >= need:
        return True
    x, y = a[head : n - tail], b[head : m - tail]
    need -= head + tail
    values, times_x = np.unique(x, return_counts=True)
    values_y, times_y = np.unique(y, return_counts=True)
    both, at_x, at_y = np.intersect1d(values, values_y, assume_unique=True, return_indices=True)
    if np.minimum(times_x[at_x], times_y[at_y]).sum() < need:  # no order matches more than this
        return False
    band = int(n + m - 2 * (need + head + tail)) + 1  # places that stay unmatched: no wider detour can reach the need
    places: dict[int, list[int]] = {}
    for i, v in enumerate(x.tolist()):
        places.setdefault(v, []).append(i)
    full: dict[int, int] = {}
    bits, all_ones = (1 << len(x)) - 1, (1 << len(x)) - 1
    for j, v in enumerate(y.tolist()):
        at = places.get(v)
        if not at:
            continue
        low, high = j - band, j + band
        if len(at) <= 32:
            mask = 0
            for i in at[bisect_left(at, low) :]:
                if i > high:
                    break
                mask |= 1 << i
        else:
            if v not in full:
                raw = np.zeros(-(-len(x) // 8) * 8, np.uint8)
                raw[at] = 1
                full[v] = int.from_bytes(np.packbits(raw, bitorder="little").tobytes(), "little")
            mask = full[v]
            if low > 0:
                mask = (mask >> low) << low
            if high + 1 < len(x):
                mask &= (1 << (high + 1)) - 1
        if mask:
            met = bits & mask
            bits = ((bits + met) | (bits - met)) & all_ones
    return len(x) - bits.bit_count() >= need


#: Lists of up to so many ids (64 MB) are sent to every task as a filter; longer ones are joined by a shuffle.
SENT_IDS = 4_000_000
#: Texts that one task aligns with one copy of their centre.
PAIRS_A_PART = 500


def only(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` is in ``ids(id)``."""
    small = ids.count() <= SENT_IDS
    return df.join(F.broadcast(ids) if small else ids, F.col(column) == F.col("id"), "left_semi")


def collapse(ws: Workspace, docs: DataFrame, how: Near) -> tuple[DataFrame, DataFrame]:
    """From ``docs(doc, text)`` every row's ``(doc, first)`` and one row ``(doc, n, keys)`` for each distinct text with words.

    ``first`` is the smallest id among copies, found by a 128-bit hash of the normalised words; a text without words is a copy of nothing
    and, like a row without id, has none. ``n`` counts shingles and ``keys`` are the sketches. No text is moved, and sketches are moved only
    where the list of texts with copies is too long to be sent.
    """

    def start():
        def make(texts):
            copies, counts, keys = [], [], []
            for t in texts:
                words = words_of(t)
                marks = shingle_hashes(words, how.words)
                copies.append(hashlib.blake2b("\n".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest() if words else None)
                counts.append(len(marks))
                keys.append(sketch(marks, how))
            return [copies, counts, keys]

        return make

    raw = ws.save(with_made(docs, ["doc"], [docs["text"]], "copy binary, n long, keys array<long>", start).where("doc is not null and copy is not null"), "hashed")
    repeats = raw.groupBy("copy").agg(F.min("doc").alias("first"), F.count("*").alias("times")).where("times > 1")
    repeats = ws.save(repeats.select("copy", "first"), "repeats")
    firsts = spread_join(raw.select("doc", "copy"), repeats, ["copy"], "left")
    copies = ws.save(firsts.where("doc <> first").select("doc", "first"), "copies")
    sketches = ws.save(spread_join(raw, repeats, ["copy"], "left").where("first is null or doc = first").select("doc", "n", "keys"), "sketches")
    ws.drop("hashed", "repeats")
    return copies, sketches


def shingled(ws: Workspace, docs: DataFrame, ids: DataFrame, how: Near) -> DataFrame:
    """``(doc, shingles)`` of the rows whose id is in ``ids(id)``: raw bytes of the 64-bit hashes, in the order of the text."""

    def start():
        return lambda texts: [[shingle_hashes(words_of(t), how.words).tobytes() for t in texts]]

    held = only(docs, ids, "doc")
    return ws.save(with_made(held, ["doc"], [held["text"]], "shingles binary", start), "texts")


def verify(ws: Workspace, pairs: DataFrame, texts: DataFrame, how: Near, name: str) -> DataFrame:
    """``(u, v)`` of the rows of ``pairs(centre, doc)`` whose texts align.

    Each text goes once to each of its centres; a centre with many texts is dealt to several tasks, with a copy of its text for each.
    """
    pairs = ws.save(pairs.select("centre", "doc").distinct(), f"{name}-pairs")
    many = pairs.groupBy("centre").agg(F.ceil(F.count("*") / PAIRS_A_PART).cast("int").alias("parts")).where("parts > 1")
    dealt = spread_join(pairs, ws.save(many, f"{name}-many"), ["centre"], "left")
    dealt = ws.save(dealt.select("centre", "doc", F.pmod(F.xxhash64("doc"), F.coalesce("parts", F.lit(1))).cast("int").alias("part")), f"{name}-dealt")
    centres = dealt.select("centre", "part").distinct()
    sent = lambda df: F.broadcast(df) if df.count() <= SENT_ROWS else df
    first = texts.withColumnRenamed("doc", "centre").join(sent(centres), "centre").select("centre", "part", F.lit(0).alias("role"), F.col("centre").alias("doc"), "shingles")
    others = texts.join(sent(dealt), "doc").select("centre", "part", F.lit(1).alias("role"), "doc", "shingles")
    rows = first.union(others).repartition("centre", "part").sortWithinPartitions("centre", "part", "role")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        middle = np.zeros(0, np.uint64)
        for pdf in batches:
            u, v = [], []
            for centre, role, doc, raw in zip(pdf["centre"], pdf["role"], pdf["doc"], pdf["shingles"]):
                shingles = np.frombuffer(raw, np.uint64)
                if role == 0:
                    middle = shingles
                elif aligned(middle, shingles, how.similarity):
                    u.append(centre)
                    v.append(doc)
            yield pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})

    found = ws.save(rows.mapInPandas(align, "u long, v long").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), name)
    ws.drop(f"{name}-pairs", f"{name}-many", f"{name}-dealt")
    return found


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Near = Near()) -> DataFrame:
    """``(key, class_id)``: a row for each row of ``docs``; the class is its smallest key among all rows that links join.

    Links join copies (equal words) and texts whose aligned similarity is ``how.similarity`` or more and that share a bucket: all pairs
    with a text of fewer than ``how.sketched_from`` shingles, and of longer ones, at 0.8, all but some in a million. Null, empty and wordless
    texts link with nothing and are their own class; rows with a null key link with nothing and get a null class. Rows that share a key share
    its class, and come back each; an empty table gives an empty one. A task holds two texts at a time, however long. Other columns
    aren't read, so their names can't clash.
    """
    ws = Workspace(docs.sparkSession, "near")
    held = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    copies, sketches = collapse(ws, held, how)
    slots = sketches.select("doc", "n", F.explode(F.array_distinct("keys")).alias("bucket"))
    shared = ws.save(slots.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    members = ws.save(spread_join(slots, shared, ["bucket"], "inner"), "members")
    ws.keep("copies", "members")
    # A text that many others resemble shares most buckets with them: it is the centre to try first.
    weight = members.groupBy("doc").agg(F.sum("size").alias("weight"))
    members = ws.save(members.drop("size").join(weight, "doc").withColumn("class", F.col("doc")), "members-0")
    ws.drop("members")
    texts = shingled(ws, held, members.select(F.col("doc").alias("id")).distinct(), how)
    edges, k = None, 0
    while True:
        # A class is tried by the member that this round's order puts first; texts of the centre's own class have no need to be compared.
        order = -F.col("weight") if k == 0 else F.xxhash64("doc", F.lit(k))
        lead = members.groupBy("bucket").agg(F.min(F.struct(order.alias("w"), F.col("doc").alias("doc"), F.col("class").alias("class"), F.col("n").alias("n"))).alias("c"))
        lead = ws.save(lead.select("bucket", F.col("c.doc").alias("centre"), F.col("c.class").alias("centre_class"), F.col("c.n").alias("centre_n")), f"lead-{k}")
        told = ws.save(spread_join(members, lead, ["bucket"], "inner").where("doc <> centre"), f"told-{k}")
        ws.drop(f"members-{k}", f"lead-{k}")
        fits = F.least("n", "centre_n") >= how.similarity * F.greatest("n", "centre_n")
        near = verify(ws, told.where((F.col("class") != F.col("centre_class")) & fits), texts, how, f"verified-{k}")
        edges = near if edges is None else edges.union(near)
        classes = connected_components(ws, edges, f"cc-{k}", most=CONTRACTIONS)  # a link that this leaves out costs comparisons only
        # The centre has met every text of its bucket: it leaves the bucket, and a bucket with one class left is settled.
        rest = spread_join(told.select("bucket", "doc", "n", "weight"), classes.select(F.col("node").alias("doc"), F.col("component").alias("class")), ["doc"], "left")
        rest = ws.save(rest.withColumn("class", F.coalesce("class", "doc")), f"rest-{k}")
        open_ = ws.save(rest.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("bucket"), f"open-{k}")
        members = ws.save(spread_join(rest, open_, ["bucket"], "left_semi"), f"members-{k + 1}")
        ws.drop(f"told-{k}", f"rest-{k}", f"open-{k}", f"cc-{k}-labels")
        k += 1
        if members.isEmpty() or k >= ROUNDS:
            break
    if not members.isEmpty():
        edges = edges.union(exact_rest(ws, members, texts, how))
    ws.drop("texts", f"members-{k}")
    classes = connected_components(ws, edges, "cc-all")
    # Of each distinct text that a link names, then of its copies; all other rows are their own class.
    linked = classes.where("node <> component").select(F.col("node").alias("first"), "component")
    moved = spread_join(copies, linked, ["first"], "left").select("doc", F.coalesce("component", "first").alias("class_id"))
    moved = ws.save(moved.union(linked.select("first", "component")).groupBy("doc").agg(F.min("class_id").alias("class_id")), "moved")
    ws.keep("moved")
    final = spread_join(docs.select(F.col(key).cast("long").alias("doc")), moved, ["doc"], "left")
    return final.select(F.col("doc").alias(key), F.coalesce("class_id", "doc").alias("class_id"))


#: Star rounds before what is still apart is compared by its rare shingles.
ROUNDS = 3
#: Contractions between star rounds: two join a star whatever the order of its ids.
CONTRACTIONS = 2


#: Slots in which labelled shingles are counted: the list of counts that every task gets has 8 MB at most.
SLOTS = 1 << 20


def slot_counts(ws: Workspace, texts: DataFrame) -> np.ndarray:
    """How many labelled shingles of ``texts(doc, shingles)`` fall into each of :data:`SLOTS` slots of their hash."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SLOTS, np.int64)
        for pdf in batches:
            for raw in pdf["shingles"]:
                np.add.at(total, slot_of(labelled(np.frombuffer(raw, np.uint64))), 1)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"slot": held, "n": total[held]})

    summed = ws.save(texts.mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1"), "slots").toArrow()
    counts = np.ones(SLOTS, np.int64)
    counts[summed["slot"].to_numpy()] = summed["n"].to_numpy()
    return counts


def slot_of(marks: np.ndarray) -> np.ndarray:
    return (marks % np.uint64(SLOTS)).astype(np.int64)


def rare_marks(marks: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The rarest labelled shingles of a text, so many that any text as similar as that has one of them among its own rarest.

    All texts rank by the same order: count, then hash.
    """
    return marks[np.lexsort((marks, counts[slot_of(marks)]))[: spare(len(marks), similarity)]]


def exact_rest(ws: Workspace, members: DataFrame, texts: DataFrame, how: Near) -> DataFrame:
    """Links among texts of different classes that buckets still hold apart.

    Texts that merely share a passage meet in a bucket by its shingles, which many texts have. So a pair is compared only if it shares one
    of both texts' rarest shingles too (:func:`rare_marks`), and so early in both that the rest of either can hold the matches that the
    threshold asks of this pair. Every pair at the threshold does; a passage stands so early only where it is eight ninths of two
    texts of one length.
    """
    rest = ws.save(members.groupBy("doc").agg(F.min("class").alias("class"), F.min("n").alias("n")), "rest")
    held = ws.save(only(texts, rest.select(F.col("doc").alias("id")), "doc"), "rest-texts")
    shared = ws.spark.sparkContext.broadcast(slot_counts(ws, held))

    def rarest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [rare_marks(labelled(np.frombuffer(raw, np.uint64)), shared.value, how.similarity) for raw in pdf["shingles"]]
            if found:
                lengths = [len(x) for x in found]
                after = np.concatenate([np.arange(n) for n in lengths])
                yield pd.DataFrame({"mark": np.concatenate(found).view(np.int64), "after": after, "doc": np.repeat(pdf["doc"].to_numpy(), lengths)})

    marks = ws.save(held.mapInPandas(rarest, "mark long, after long, doc long").join(rest, "doc"), "rare")
    several = ws.save(marks.groupBy("mark").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("mark"), "several")
    open_ = ws.save(spread_join(marks, several, ["mark"], "left_semi"), "rare-open")
    ws.drop("rare", "several")
    right = open_.select("mark", F.col("doc").alias("other"), F.col("n").alias("m"), F.col("after").alias("other_after"), F.col("class").alias("other_class"))
    need = (F.col("n") + F.col("m")) * (how.similarity / (1 + how.similarity)) - 1e-6
    fits = (F.col("n") - F.col("after") >= need) & (F.col("m") - F.col("other_after") >= need)
    met = open_.join(right, "mark").where((F.col("class") != F.col("other_class")) & (F.col("doc") < F.col("other")) & fits)
    found = verify(ws, met.select(F.col("doc").alias("centre"), F.col("other").alias("doc")), held, how, "verified-rest")
    ws.drop("rest", "rest-texts", "slots", "rare-open")
    return found


def saved(ws: Workspace, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, written; the workspaces that it was made in are closed."""
    with opened() as made:
        out = ws.save(make(), name)
    for other in made:
        other.close()
    return out


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Near = Near()) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the row with the smallest key, and of alike rows with that key one.

    Rows are compared as rows, so unlike texts with one key all stay. Rows that link with nothing stay too, also those with a null key, and
    null, empty or wordless texts. All columns come back in order, unchanged, whatever their names; an empty table gives an empty one.
    """
    ws = Workspace(docs.sparkSession, "near-keep")
    names = docs.columns
    held = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    at, words_at = f"_c{names.index(key)}", f"_c{names.index(text)}"
    number = F.col(at).cast("long")
    repeated = ws.save(held.select(number.alias("_key")).where("_key is not null").groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1"), "repeated")
    if repeated.isEmpty():
        gone = saved(ws, lambda: near_classes(docs, key, text, how).where(F.col("class_id") != F.col(key)).select(F.col(key).alias("_key")), "gone")
        gone = F.broadcast(gone) if gone.count() <= SENT_IDS else gone
        return held.join(gone, number == F.col("_key"), "left_anti").toDF(*names)
    rows = ws.save(held.withColumn("_row", F.when(number.isNotNull(), F.monotonically_increasing_id())), "rows")
    classes = saved(ws, lambda: near_classes(rows, "_row", words_at, how).where("class_id is not null").withColumnRenamed("class_id", "_class"), "row-classes")
    classes = ws.save(classes.join(rows.select("_row", number.alias("_key")), "_row"), "classes")
    first = classes.groupBy("_class").agg(F.min("_key").alias("_key"))
    least = ws.save(classes.join(first, ["_class", "_key"]), "least")
    several = least.groupBy("_class").agg(F.count("*").alias("_n")).where("_n > 1").select("_class")
    order = Window.partitionBy("_class").orderBy(words_at, *[c for c in held.columns if c not in (at, words_at)])
    picked = rows.join(least.join(several, "_class", "left_semi").select("_row", "_class"), "_row").withColumn("_r", F.row_number().over(order)).where("_r = 1")
    stay = ws.save(least.join(several, "_class", "left_anti").select("_row").union(picked.select("_row")), "stay")
    return rows.join(stay, "_row", "left_semi").unionByName(rows.where("_row is null")).drop("_row").toDF(*names)
