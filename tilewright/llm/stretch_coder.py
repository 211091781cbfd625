"""Encoders that remember the ids of stretches of text, so a repeated word costs one lookup."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Unicode white space (the property, which \s means in byte-level patterns).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNEVEN = re.compile(f"[{SPACE}] ")
RUNS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Distinct stretches whose ids a worker remembers before it starts anew.
REMEMBERED = 750_000


#: Before the key of a stretch that doesn't start with a space; no text of UTF-8 holds it.
BARE = "\ud800"


def stretch_keys(text: str) -> list[str]:
    """Cuts a text where no pre-token of a byte-level pattern can cross: between a character and white space after it.

    With single spaces, cutting at every space does; else white space goes with what follows it. The key of a stretch that starts with a space is what
    follows that space, so that most keys are cut out of the text as they are; that of another is marked by :data:`BARE`.
    """
    if UNEVEN.search(text):
        return [x[1:] if x[0] == " " else BARE + x for x in RUNS.findall(text)]
    keys = text.split(" ")
    if keys[0]:
        keys[0] = BARE + keys[0]
        return keys
    return keys[1:]


def stretch(key: str) -> str:
    """The stretch of a key."""
    return key[1:] if key[:1] == BARE else " " + key


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches ``which`` of ``flat``, one after another."""
    n = lengths[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[which] - (ends - n), n) + np.arange(total)]


class Numbered(dict):
    """Numbers strings in the order in which they are first asked for; ``new`` lists those since it was last emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        k = self[key] = len(self)
        self.new.append(key)
        return k


class IdStore:
    """The ids of strings, one after another in one array."""

    def __init__(self) -> None:
        self.seen = Numbered()
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.at, self.n, self.filled = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def numbers(self, strings: list[str]) -> np.ndarray:
        """The number of each string; what is new is then in ``seen.new`` and needs :meth:`put`."""
        return np.fromiter(map(self.seen.__getitem__, strings), np.int64, len(strings))

    def put(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The ids of all new strings, in their order."""
        need = self.filled + len(lengths)
        while len(self.at) < need:
            self.at, self.n = np.concatenate([self.at, self.at]), np.concatenate([self.n, self.n])
        while len(self.flat) < self.used + len(ids):
            self.flat = np.concatenate([self.flat, self.flat])
        self.flat[self.used : self.used + len(ids)] = ids
        self.n[self.filled : need] = lengths
        self.at[self.filled : need] = self.used + np.cumsum(lengths) - lengths
        self.filled, self.used = need, self.used + len(ids)
        self.seen.new = []

    def ids(self, which: np.ndarray) -> np.ndarray:
        return gather(self.flat, self.at, self.n, which)


class StretchCoder:
    """Base of the encoders: subclasses give the ids of new stretches in :meth:`encode_new`."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.store = IdStore()

    def encode_new(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all stretches, one after another, and how many each has."""
        raise NotImplementedError

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text as ``int32``; new stretches of all texts of the call are encoded together."""
        if len(self.store.seen) > REMEMBERED:
            self.forget()
        store = self.store
        held = [store.numbers(stretch_keys(t)) for t in texts]
        if store.seen.new:
            try:
                store.put(*self.encode_new([*map(stretch, store.seen.new)]))
            except BaseException:
                self.forget()  # numbers without ids must not stay
                raise
        yield from map(store.ids, held)
