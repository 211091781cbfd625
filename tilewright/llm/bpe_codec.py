"""Byte-level BPE encoding and decoding of a text column."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.arrow_rows import with_made

#: Characters of text whose distinct pre-tokens share the matrices.
BATCH_CHARS = 4_000_000


def slices(texts: list, most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    """Stretches of a list with about ``most`` characters each, one text at least."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode_column(docs: DataFrame, carry: list[str], path: str, pattern: str, text: str = "text") -> DataFrame:
    """The columns ``carry`` and ``ids array<int>``, a row for each row, over whole texts; null counts as empty, which has no ids.

    A row depends on itself only; repeated rows each come back and an empty table gives an empty one. A very long text takes memory in
    proportion to it, and time about in proportion, also where it is one pre-token. Carried columns go through unchanged, by place.
    """
    return _mapped(docs, carry, path, pattern, text, "ids array<int>", lambda coder, ids: (ids,))


def decode_column(docs: DataFrame, carry: list[str], path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The columns ``carry`` and ``decoded binary``; null ids count as none and give empty bytes."""

    def start():
        from tilewright.llm.byte_bpe import encoder

        coder = encoder(path, pattern)
        return lambda lists: [[b"" if x is None else coder.decode(x) for x in lists]]

    return with_made(docs, carry, [docs[ids]], "decoded binary", start)


def round_trip_digests(docs: DataFrame, carry: list[str], path: str, pattern: str, text: str = "text") -> DataFrame:
    """The columns ``carry``, ``n_tokens``, ``ids_sha256`` (ids as little-endian uint32) and ``decoded_sha256``.

    Encodes and decodes in one pass, so ids never leave the worker; conventions as in :func:`encode_column`.
    """

    def digests(coder, ids):
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(coder.decode(ids)).hexdigest()

    return _mapped(docs, carry, path, pattern, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def _mapped(docs: DataFrame, carry: list[str], path: str, pattern: str, text: str, added: str, row) -> DataFrame:
    def start():
        from tilewright.llm.byte_bpe import encoder

        coder = encoder(path, pattern)

        def make(texts):
            made = [row(coder, ids) for a, b in slices(texts) for ids in coder.encode(texts[a:b])]
            return [[m[k] for m in made] for k in range(added.count(",") + 1)]

        return make

    return with_made(docs, carry, [F.coalesce(docs[text], F.lit(""))], added, start)
