"""Cutting stock by column generation over a histogram of lengths.

The linear program chooses how often each pattern (a multiset of lengths that fits a sequence) is used. Its columns are priced by an
unbounded knapsack: dynamic programming over the capacity with the duals as values. Its size depends on the number of distinct
lengths, which is under the capacity, never on the number of documents.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np

#: A pattern as ascending (length, times) pairs.
Pattern = tuple[tuple[int, int], ...]


def knapsack(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best total value of a multiset of lengths that fits, and how often it holds each."""
    worth = np.full(capacity + 1, -1.0)
    item = np.full(capacity + 1, -1)
    worth[lengths], item[lengths] = values, np.arange(len(lengths))
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        total = best[c - 1 :: -1] + worth[1 : c + 1]  # a last piece of each length 1 .. c
        k = int(total.argmax())
        if total[k] > best[c - 1] + 1e-12:
            best[c], pick[c] = total[k], k + 1
        else:
            best[c], pick[c] = best[c - 1], 0
    times, c = np.zeros(len(lengths)), capacity
    while c > 0:
        if pick[c] <= 0:
            c -= 1
        else:
            times[item[pick[c]]] += 1
            c -= pick[c]
    return float(best[capacity]), times


def first_basis(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Patterns, uses and the order in which lengths are used up: a basis to start from: longest remaining length first, then always the longest that still fits, used until a length is used up.

    Each pattern holds only lengths that earlier ones have not used up and uses up the one that names its column, so the basis is triangular.
    """
    m, left, order = len(lengths), demand.copy(), []
    columns, uses = np.zeros((m, m)), np.zeros(m)
    for _ in range(m):
        alive = np.flatnonzero(left > 0)
        if not len(alive):
            break
        pattern, room, k = np.zeros(m), capacity, len(alive) - 1
        while k >= 0:
            i = alive[k]
            if pattern.any():  # the longest is taken once, others as often as they fit
                n = room // lengths[i]
            else:
                n = 1
            pattern[i] += n
            room -= n * lengths[i]
            k = int(np.searchsorted(lengths[alive], room, side="right")) - 1
        held = np.flatnonzero(pattern)
        times = left[held] / pattern[held]
        out = held[times.argmin()]
        columns[:, out], uses[out] = pattern, times.min()
        left -= uses[out] * pattern
        left[out] = 0.0
        order.append(int(out))
        left[left < 1e-9] = 0.0
    for i in np.flatnonzero(~columns.any(axis=0)):  # used up together with another
        columns[i, i] = capacity // lengths[i]
    order += sorted({*range(m)}.difference(order))
    return columns, uses, order


def triangular_inverse(columns: np.ndarray, order: list[int]) -> np.ndarray:
    """Inverse of a matrix that is lower triangular when rows and columns are put in ``order``, by forward substitution."""
    low = columns[np.ix_(order, order)]
    inverse = np.eye(len(order))
    for k in range(len(order)):
        inverse[k, : k + 1] /= low[k, k]
        below = np.flatnonzero(low[k + 1 :, k]) + k + 1
        inverse[below, : k + 1] -= np.multiply.outer(low[below, k], inverse[k, : k + 1])
    out = np.empty_like(inverse)
    out[np.ix_(order, order)] = inverse
    return out


@dataclass(frozen=True)
class Program:
    """The answer of :func:`linear_program`: one pattern a column, its uses, and how it ended."""

    patterns: np.ndarray
    uses: np.ndarray
    #: Knapsack calls, and the proven lower bound of the number of sequences.
    priced: int
    bound: float
    #: ``optimal`` (no column improves), ``whole`` (no whole number under the value is over the bound) or ``gap``.
    end: str

    @property
    def gap(self) -> float:
        return float(self.uses.sum()) / self.bound - 1 if self.bound else 0.0


def linear_program(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 2e-4, shift: float = 1e-4) -> Program:
    """Column generation until the answer is proven: ``patterns @ uses`` is ``demand`` plus under ``shift`` a length, and ``uses >= 0``.

    Revised simplex from a triangular basis; every entering column is priced by the knapsack. The objective over the value of the priced
    column, with the duals that it was priced by, is a lower bound (so are all ids over the capacity). It ends when no column improves,
    when the value is at or under the next whole number over the bound, or within ``gap`` of the bound. Demands are
    shifted by different tiny amounts, so that no two lengths are used up at once and every pivot makes progress.
    """
    m = len(lengths)
    shifted = demand + shift * (0.5 + 0.5 * np.modf((np.arange(m) + 1) * 0.6180339887498949)[0])
    columns, uses, order = first_basis(lengths, shifted, capacity)
    inverse = triangular_inverse(columns, order)
    bound, priced = float((lengths * demand).sum()) / capacity, 0
    while True:
        duals = np.maximum(inverse.sum(axis=0), 0.0)
        value, entering = knapsack(duals, lengths, capacity)
        priced += 1
        bound = max(bound, float(duals @ demand) / value)
        if value <= 1 + 1e-9:
            end = "optimal"
            break
        if uses.sum() <= np.ceil(bound - 1e-6) + 1e-6:
            end = "whole"
            break
        if uses.sum() <= bound * (1 + gap):
            end = "gap"
            break
        way = inverse @ entering
        rising = np.flatnonzero(way > 1e-9)  # never empty: the entering pattern holds a length whose demand is bounded
        leaving = rising[np.argmin(uses[rising] / way[rising])]
        step = uses[leaving] / way[leaving]
        uses = np.maximum(uses - step * way, 0.0)
        uses[leaving] = step
        row = inverse[leaving] / way[leaving]
        moved = np.flatnonzero(np.abs(way) > 1e-13)
        inverse[moved] -= np.multiply.outer(way[moved], row)
        inverse[leaving] = row
        columns[:, leaving] = entering
    return Program(columns, uses, priced, bound, end)


def best_fit(rest: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Packs what rounding left: longest first, into the fullest open sequence that has room."""
    rooms: dict[int, list[Counter]] = {}
    for length in sorted(rest, reverse=True):
        for _ in range(rest[length]):
            room = min((r for r in rooms if r >= length and rooms[r]), default=None)
            if room is None:
                held, room = Counter(), capacity
            else:
                held = rooms[room].pop()
            held[length] += 1
            rooms.setdefault(room - length, []).append(held)
    return Counter(tuple(sorted(held.items())) for open_ in rooms.values() for held in open_)


def solve(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns and whole numbers of uses that hold every piece of the histogram exactly once."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram))
    if lengths[0] < 1 or lengths[-1] > capacity:
        raise ValueError("lengths must be from 1 to the capacity")
    demand = np.array([histogram[int(n)] for n in lengths], float)
    program = linear_program(lengths, demand, capacity)
    columns, uses = program.patterns.astype(np.int64), program.uses
    whole = np.floor(uses + 1e-7).astype(np.int64)
    rest = demand.astype(np.int64) - columns @ whole
    for k in np.flatnonzero(rest < 0):  # a floor that the shift or numerical error has lifted
        for j in np.flatnonzero((columns[k] > 0) & (whole > 0)):
            while rest[k] < 0 and whole[j] > 0:
                whole[j] -= 1
                rest += columns[:, j]
    for j in np.argsort(-(uses - whole)):  # once more where what is left still fills the pattern
        if uses[j] - whole[j] > 1e-6 and (columns[:, j] <= rest).all():
            whole[j] += 1
            rest -= columns[:, j]
    found: Counter[Pattern] = Counter()
    for j in np.flatnonzero(whole):
        found[tuple((int(lengths[i]), int(columns[i, j])) for i in np.flatnonzero(columns[:, j]))] += int(whole[j])
    found.update(best_fit({int(n): int(r) for n, r in zip(lengths, rest) if r}, capacity))
    return sorted(found.items())


def segments(plan: list[tuple[Pattern, int]], first_sequence: int = 0) -> list[tuple[int, int, int, int, int]]:
    """``(length, first_rank, times, first_sequence, offset)`` by length and rank.

    The piece of a length with rank ``first_rank + i`` goes to sequence ``first_sequence + i // times``, at ``offset + (i % times) * length``.
    A segment ends where the next of its length begins.
    """
    rank: Counter[int] = Counter()
    out = []
    for pattern, uses in plan:
        offset = 0
        for length, times in pattern:
            out.append((length, rank[length], times, first_sequence, offset))
            rank[length] += uses * times
            offset += length * times
        first_sequence += uses
    return sorted(out)
