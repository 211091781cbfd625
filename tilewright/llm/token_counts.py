"""Token counts under a unigram vocabulary: Viterbi that keeps a score and a count, and no pieces.

An Aho-Corasick automaton enumerates all vocabulary matches of a word in one pass. Ties follow the tokenizers library's unigram model: a
path replaces another that ends at the same place only if its score is greater, and paths are offered by ascending start of their
last piece, so of equals the longest last piece stays. Unknown characters cost the least score minus 10, and neighbours are one piece,
or as many as they have bytes where the vocabulary has byte pieces. As in that library with a metaspace splitter, a text gets a
leading space, and every space starts a word; words are independent, so a worker counts each distinct word once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from tilewright.llm.arrow_rows import with_made

MARK = "▁"  # stands for a space in vocabularies
UNKNOWN_PENALTY = 10.0
#: Distinct words that a worker remembers before it starts anew.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores in id order, the id of the unknown piece, and whether unknown characters become byte pieces."""

    pieces: tuple[tuple[str, float], ...]
    unknown: int = 0
    byte_fallback: bool = True


@lru_cache(maxsize=4)
def vocabulary_from_sentencepiece(path: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece model file, read as a unigram vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return Vocabulary(tuple((model.id_to_piece(i), float(model.get_score(i))) for i in range(model.vocab_size())), model.unk_id(), True)


class Counter:
    """Counts the pieces of words under one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        known = set()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))  # of a repeated piece the last stays
                known.add(piece)
        self.empty = not len(self.automaton)
        self.automaton.make_automaton()
        self.unknown_score = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = vocabulary.byte_fallback
        self.byte_known = frozenset(b for b in range(256) if f"<0x{b:02X}>" in known)
        self.seen: dict[str, int] = {}

    def pieces(self, word: str) -> int:
        """Number of pieces of one word, ``▁`` included in it."""
        n = len(word)
        if not n:
            return 0
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        if not self.empty:
            for last, match in self.automaton.iter(word):
                ending[last + 1].append(match)
        best, count, start_unknown = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        sizes: list[tuple[int, bool]] = [(0, True)] * (n + 1)  # of the unknown run that ends there: bytes, and whether all are byte pieces
        for end in range(1, n + 1):
            score, pieces, run, single = None, 0, -1, False
            for length, own in sorted(ending[end], reverse=True):  # ascending start
                offered = own + best[end - length]
                if score is None or offered > score:
                    score, pieces, run = offered, count[end - length] + 1, -1
                single = single or length == 1
            if not single:
                offered = self.unknown_score + best[end - 1]
                if score is None or offered > score:
                    before = start_unknown[end - 1]
                    run = before if before >= 0 else end - 1  # neighbouring unknowns fuse
                    raw = word[end - 1].encode("utf-8", "surrogatepass")
                    n_bytes, known = sizes[end - 1] if before >= 0 else (0, True)
                    sizes[end] = n_bytes, known = n_bytes + len(raw), known and self.byte_known.issuperset(raw)
                    score, pieces = offered, count[run] + (n_bytes if known and self.byte_fallback else 1)
            best[end], count[end], start_unknown[end] = score, pieces, run
        return count[n]

    def text(self, text: str) -> int:
        """Number of pieces of a whole text."""
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if not words[0]:
            del words[0]  # a leading space is its own mark
        seen = self.seen
        if len(seen) > REMEMBERED:
            seen.clear()
        for word in {*words}.difference(seen):
            seen[word] = self.pieces(MARK + word)
        return sum(map(seen.__getitem__, words))


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """One counter for each vocabulary file and worker."""
    return Counter(vocabulary_from_sentencepiece(path))


def count_tokens(docs: DataFrame, carry: list[str], vocabulary_path: str, text: str = "text") -> DataFrame:
    """The columns ``carry`` and ``n_tokens long``, a row for each row, over whole texts.

    Null and empty texts have 0 tokens. A row depends on itself only; repeated rows each come back, an empty table gives an empty one.
    The memory of a worker is bounded by the automaton, :data:`REMEMBERED` words, and one Arrow batch; a very long text, or a very long word,
    takes time in proportion to it. Carried columns go through unchanged, by place.
    """

    def start():
        own = counter(vocabulary_path)
        return lambda texts: [[own.text(t) if t else 0 for t in texts]]

    return with_made(docs, carry, [docs[text]], "n_tokens long", start)
