"""Byte-level BPE by numpy matrices.

Distinct pre-tokens are bucketed by byte length into padded matrices of token ids. In each round every row that still has a mergeable
pair merges its leftmost pair of least rank; ranks of pairs come from an open-addressing table probed for whole matrices at a time,
rows are compacted by one shift, and finished rows leave the matrix. After a merge only the two pairs at its place are looked up.
A very long row has a matrix of its own, in which a round takes all merges that single rounds would take one after another.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

from tilewright.llm.stretch_coder import REMEMBERED, StretchCoder, gather

NO_RANK = np.int32(2**31 - 1)
#: Cells of one padded matrix.
CELLS = 1 << 20
#: A row of so many bytes is merged alone, many pairs a round.
LONG = 1 << 10

class PairTable:
    """Ranks of pairs of ids in an open-addressing hash table; ids are ranks of byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NO_RANK, np.int32)
        slots, todo, values = self._slot(keys), np.arange(len(keys)), np.array(rank, np.int32)
        self.probes = 0
        while len(todo):  # all keys at once: the first claimant of a free slot gets it, the others move on
            at = slots[todo]
            free = self.keys[at] == -1
            claim = todo[free]
            _, first = np.unique(slots[claim], return_index=True)
            won = claim[first]
            self.keys[slots[won]], self.ranks[slots[won]] = keys[won], values[won]
            todo = todo[~np.isin(todo, won)]
            slots[todo] = (slots[todo] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, :data:`NO_RANK` where it doesn't merge; an id under 0 is padding and merges with nothing."""
        keys = (a.astype(np.int64) << 32) | (b.astype(np.int64) & 0xFFFFFFFF)
        flat = keys.ravel()
        out = np.full(flat.shape, NO_RANK, np.int32)
        left = np.flatnonzero((a.ravel() >= 0) & (b.ravel() >= 0))
        slots = self._slot(flat[left])
        while len(left):
            held = self.keys[slots]
            hit = held == flat[left]
            out[left[hit]] = self.ranks[slots[hit]]
            on = ~hit & (held != -1)
            left, slots = left[on], (slots[on] + 1) & self.mask
        return out.reshape(a.shape)


class ByteBpe(StretchCoder):
    """Encoder and decoder for the ranks of one vocabulary and the pattern that cuts pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.cut = regex.compile(pattern).findall
        self.whole = {token: rank for token, rank in ranks.items()}
        self.table = PairTable(ranks)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        parts = [b""] * size
        for token, rank in ranks.items():
            lengths[rank], parts[rank] = len(token), token
        self.lengths, self.blob = lengths, np.frombuffer(b"".join(parts), np.uint8)
        self.starts = np.cumsum(lengths) - lengths
        super().__init__()

    def forget(self) -> None:
        super().forget()
        self.merged: dict[bytes, np.ndarray] = {}

    def merge_rows(self, tokens: list[bytes]) -> list[np.ndarray]:
        """Ids of each byte string, in order. Rows of about the same length share a matrix of :data:`CELLS` cells at most (or one row)."""
        out: list[np.ndarray | None] = [None] * len(tokens)
        order = sorted(range(len(tokens)), key=lambda i: len(tokens[i]))
        at = 0
        while at < len(order):
            width = max(1, len(tokens[order[at]]))
            if width >= LONG:
                out[order[at]] = self._merge_long(tokens[order[at]])
                at += 1
                continue
            room = 1 << (width - 1).bit_length()  # the bucket: up to the next power of two
            stop = at + 1
            while stop < len(order) and len(tokens[order[stop]]) <= room and (stop - at + 1) * len(tokens[order[stop]]) <= CELLS:
                stop += 1
            rows = order[at:stop]
            for i, ids in zip(rows, self._merge_matrix([tokens[i] for i in rows])):
                out[i] = ids
            at = stop
        return out

    def _merge_matrix(self, tokens: list[bytes]) -> list[np.ndarray]:
        lengths = np.array([len(t) for t in tokens])
        width = int(lengths.max(initial=0))
        ids = np.full((len(tokens), width + 1), -1, np.int32)  # a last column of padding
        inside = np.arange(width + 1) < lengths[:, None]
        ids[inside] = self.byte_id[np.frombuffer(b"".join(tokens), np.uint8)]
        done: list[np.ndarray] = [ids[0, :0]] * len(tokens)
        rows, ranks = np.arange(len(tokens)), self.table.lookup(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if ranks.shape[1] == 0:
                best = np.zeros(len(rows), np.int64)
                least = np.full(len(rows), NO_RANK, np.int32)
            else:
                best = ranks.argmin(axis=1)  # the first of equals is the leftmost
                least = ranks[np.arange(len(rows)), best]
            over = least == NO_RANK
            if over.any():
                for k in np.flatnonzero(over):
                    done[rows[k]] = ids[k, : lengths[k]].copy()
                on = ~over
                rows, lengths, ids, ranks, best, least = rows[on], lengths[on], ids[on], ranks[on], best[on], least[on]
                if not len(rows):
                    break
                width = int(lengths.max())
                ids, ranks = ids[:, : width + 1], ranks[:, :width]
            line = np.arange(len(rows))
            ids[line, best] = least
            source = np.arange(ids.shape[1] - 1)[None, :]
            moved = np.minimum(source + (source > best[:, None]), ids.shape[1] - 1)
            ids = np.concatenate([np.take_along_axis(ids, moved, 1), np.full((len(rows), 1), -1, np.int32)], axis=1)
            lengths = lengths - 1
            source = source[:, : ranks.shape[1]]
            ranks = np.take_along_axis(ranks, np.minimum(source + (source >= best[:, None]), ranks.shape[1] - 1), 1)
            ranks[:, -1] = NO_RANK
            ranks[line, np.minimum(best, ranks.shape[1] - 1)] = self.table.lookup(ids[line, best], ids[line, best + 1])
            back = np.flatnonzero(best > 0)
            ranks[back, best[back] - 1] = self.table.lookup(ids[back, best[back] - 1], ids[back, best[back]])
        return done

    def _merge_long(self, token: bytes) -> np.ndarray:
        """Ids of one long byte string; the same as one merge a round gives.

        A round takes the least rank and its places from the left, none touching the one before. Single rounds would take these in this
        order, until a merge makes a pair of a still smaller rank with what then stands beside it: the round ends with that merge.
        """
        ids = self.byte_id[np.frombuffer(token, np.uint8)]
        ranks = self.table.lookup(ids[:-1], ids[1:])
        while len(ranks):
            least = ranks.min()
            if least == NO_RANK:
                break
            at = np.flatnonzero(ranks == least)
            breaks = np.r_[True, np.diff(at) > 1]  # runs of touching places: every second one merges
            first = np.maximum.accumulate(np.where(breaks, at, 0))
            at = at[(at - first) % 2 == 0]
            touching = np.r_[False, np.diff(at) == 2]
            left = np.where(touching, least, ids[np.maximum(at - 1, 0)])
            before = np.where(at > 0, self.table.lookup(left, np.full_like(left, least)), NO_RANK)
            right = ids[np.minimum(at + 2, len(ids) - 1)]
            after = np.where(at + 2 < len(ids), self.table.lookup(np.full_like(right, least), right), NO_RANK)
            smaller = np.flatnonzero((before < least) | (after < least))
            if len(smaller):
                at = at[: smaller[0] + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids[at] = least
            ids, ranks = ids[keep], np.append(ranks, NO_RANK)[keep][:-1]
            place = at - np.arange(len(at))
            touched = np.concatenate([place, place - 1])
            touched = touched[(touched >= 0) & (touched < len(ranks))]
            ranks[touched] = self.table.lookup(ids[touched], ids[touched + 1])
        return ids

    def encode_new(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cuts stretches into pre-tokens; those not met before go through the matrices together."""
        cuts = [[x.encode("utf-8", "surrogatepass") for x in self.cut(p)] for p in parts]
        if len(self.merged) > REMEMBERED:
            self.merged = {}
        merged = self.merged
        fresh = {x for cut in cuts for x in cut if x not in merged}
        short = {x for x in fresh if x in self.whole}
        merged.update((x, np.array([self.whole[x]], np.int32)) for x in short)
        fresh = list(fresh - short)
        merged.update(zip(fresh, self.merge_rows(fresh)))
        pieces = [merged[x] for cut in cuts for x in cut]
        lengths = np.fromiter((sum(len(merged[x]) for x in cut) for cut in cuts), np.int64, len(cuts))
        return np.concatenate([np.zeros(0, np.int32), *pieces]), lengths

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of ids."""
        if not len(ids):
            return b""
        return gather(self.blob, self.starts, self.lengths, np.asarray(ids, np.int64)).tobytes()


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> ByteBpe:
    """One encoder for each rank file and worker; the file has a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return ByteBpe(ranks, pattern)
