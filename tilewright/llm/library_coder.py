"""Ids of the tokenizers library, with the ids of stretches and of words remembered."""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import compress

import numpy as np
import regex

from tilewright.llm.stretch_coder import REMEMBERED, IdStore, StretchCoder

#: Strings that are encoded as one text.
JOINED = 1000
#: The cut of the byte-level pre-tokenizer (fixed value of the public format).
CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Beyond these characters the Unicode versions of two libraries can differ in what a letter is.
FAR = re.compile("[^\t\n\r\x20-\u024f]")


class LibraryCoder(StretchCoder):
    """A tokenizer file with a byte-level pre-tokenizer; no special tokens are added, those in a text count as such."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, added.values())) or "(?!)")
        begins = {t[0] for t in added.values()}
        self.begin = begins.pop() if len(begins) == 1 else ""  # a character of every special token; "" is in every string
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(1 + max([*vocabulary.values(), *added]), np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)  # a character stands for a byte
        for i, token in added.items():
            self.n_bytes[i] = len(token.encode())
        super().__init__()

    def forget(self) -> None:
        super().forget()
        self.words = IdStore()

    def encode_new(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Stretches are cut into words, of which few are new: the same word stands with many marks.

        What the library may cut otherwise (special tokens, far characters) and what could merge with a neighbour goes to it whole.
        """
        if len(self.words.seen) > REMEMBERED:
            self.words = IdStore()
        far, special, begin = FAR.search, self.special.search, self.begin
        usual = [(p.isascii() and p.isprintable() or not far(p)) and p[0] == " " and not p[-1].isspace() and not (begin in p and special(p)) for p in parts]
        plain, held = np.array(usual, bool), [*compress(parts, usual)]
        cut = CUT.findall("".join(held))
        which = self.words.numbers(cut)
        if self.words.seen.new:
            self.words.put(*self.by_library(self.words.seen.new))
        ends = np.cumsum([*map(len, held)], dtype=np.int64)
        words_to = np.searchsorted(np.cumsum([*map(len, cut)], dtype=np.int64), ends, "right")  # no word crosses the end of a stretch
        ids_to = np.r_[0, np.cumsum(self.words.n[which])]
        rest, n_rest = self.by_library([*compress(parts, ~plain)])
        lengths = np.zeros(len(parts), np.int64)
        lengths[plain] = np.diff(ids_to[np.r_[0, words_to]])
        lengths[~plain] = n_rest
        out = np.empty(int(lengths.sum()), np.int32)
        own = np.repeat(plain, lengths)
        out[own], out[~own] = self.words.ids(which), rest
        return out, lengths

    def by_library(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings and how many each has.

        A call for each would cost several times as much, so they are put together: one that starts with a space after one that doesn't end
        with white space never merges with it. The bytes of the tokens tell whose they are.
        """
        joins = np.array([p[0] == " " and not p[-1].isspace() for p in parts], bool)
        joined, alone = [*compress(parts, joins)], [*compress(parts, ~joins)]
        blocks = ["".join(joined[k : k + JOINED]) for k in range(0, len(joined), JOINED)]
        encoded = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(blocks + alone, add_special_tokens=False)]
        flat = np.concatenate([np.zeros(0, np.int32), *encoded[: len(blocks)]])
        ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in joined], dtype=np.int64)
        lengths = np.zeros(len(parts), np.int64)
        lengths[joins] = np.diff(np.r_[0, np.searchsorted(np.cumsum(self.n_bytes[flat]), ends, "right")])
        lengths[~joins] = [len(x) for x in encoded[len(blocks) :]]
        out = np.empty(int(lengths.sum()), np.int32)
        own = np.repeat(joins, lengths)
        out[own], out[~own] = flat, np.concatenate([np.zeros(0, np.int32), *encoded[len(blocks) :]])
        return out, lengths


@lru_cache(maxsize=4)
def library_coder(path: str) -> LibraryCoder:
    """One encoder for each tokenizer file and worker."""
    return LibraryCoder(path)
