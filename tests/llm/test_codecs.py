import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer, models, pre_tokenizers

from tilewright.llm import bpe_codec, packing, token_counts, token_records
from tilewright.llm.byte_bpe import encoder
from tilewright.llm.cutting_stock import segments, solve
from tilewright.llm.library_coder import LibraryCoder
from tilewright.workspace import Workspace

RANKS = P.path("byte_bpe_50k.tiktoken")
random.seed(5)
TEXTS = ["", " ", "   a  b ", "a\n\n b\t\x1c!\x1c", "日本語　テキスト", "don't we'll", "aaaa" * 400, "🙂🙂 x", "<|endoftext|> y", "½ ١٢٣"]
TEXTS += ["".join(random.choice("ab .\n\t'sé日🙂1") for _ in range(random.randint(0, 50))) for _ in range(400)]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(9000, None), (9001, "same"), (9001, "same")]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(library):
    own = encoder(RANKS, P.PATTERN)
    for text, ids in zip(TEXTS, own.encode(TEXTS)):
        assert ids.tolist() == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_bpe_round_trip_query(spark, library):
    df = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, _text string")
    got = bpe_codec.round_trip_digests(df, ["doc_id", "_text"], RANKS, P.PATTERN).collect()
    assert len(got) == len(ROWS)
    want = {i: library.encode_ordinary(t or "") for i, t in ROWS}
    for r in got:
        ids = np.array(want[r["doc_id"]], "<u4")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((dict(ROWS)[r["doc_id"]] or "").encode()).hexdigest()
    assert bpe_codec.round_trip_digests(df.limit(0), ["doc_id"], RANKS, P.PATTERN).collect() == []
    encoded = bpe_codec.encode_column(df.where("doc_id < 50"), ["doc_id"], RANKS, P.PATTERN)
    decoded = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe_codec.decode_column(encoded, ["doc_id"], RANKS, P.PATTERN).collect()}
    assert decoded == {i: t for i, t in ROWS if i < 50}


def test_token_counts_equal_the_library(spark):
    path = P.path("piece_bpe_32k.model")
    v = token_counts.vocabulary_from_sentencepiece(path)
    t = Tokenizer(models.Unigram(list(v.pieces), unk_id=v.unknown, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = token_counts.count_tokens(df, ["doc_id", "text"], path).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert r["n_tokens"] == len(t.encode(r["text"] or "", add_special_tokens=False).ids), r


def test_unigram_ties_follow_the_library():
    pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("▁", -1.0), ("▁a", -2.0), ("aba", -3.0)]
    t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    own = token_counts.Counter(token_counts.Vocabulary(tuple(pieces), 0, False))
    for _ in range(300):
        text = "".join(random.choice("abx ") for _ in range(random.randint(0, 14)))
        assert own.text(text) == len(t.encode(text, add_special_tokens=False).ids), text


def test_records_round_trip(spark):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    df = spark.createDataFrame(ROWS + [(None, "no key")], "doc_id long, text string")
    ws = Workspace(spark, "t")
    index = ws.save(token_records.write_records(df, ws.path("f"), P.path("byte_bpe_50k.json"), 2), "index")
    got = token_records.read_records(index, ws.path("f")).collect()
    got.sort(key=lambda r: r["start"])
    assert len(got) == len(ROWS) + 1 and got[0]["doc_id"] is None
    at, texts = 0, dict(ROWS) | {None: "no key"}
    for r in got:
        ids = np.array(t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    some = token_records.read_at(index.where("doc_id % 7 = 0"), ws.path("f")).collect()
    assert {r["doc_id"] for r in some} == {i for i, _ in ROWS if i % 7 == 0}


def test_damaged_records_are_refused():
    import io

    data = bytearray(token_records.frame(b"abcdef"))
    assert token_records.read_frame(io.BytesIO(bytes(data))) == b"abcdef"
    for k in (0, 9, 13, len(data) - 1):
        broken = bytes(data[:k]) + bytes([data[k] ^ 1]) + bytes(data[k + 1 :])
        with pytest.raises(ValueError):
            token_records.read_frame(io.BytesIO(broken))
    assert token_records.crc32c(b"123456789") == 0xE3069283


def test_cutting_stock_holds_every_piece():
    for histogram in ({}, {5: 3}, {1024: 2, 1: 1}, {300: 7, 500: 9, 224: 40, 1: 11, 1023: 3}):
        got = {}
        for pattern, uses in solve(histogram, 1024):
            assert sum(n * k for n, k in pattern) <= 1024
            for n, k in pattern:
                got[n] = got.get(n, 0) + k * uses
        assert got == histogram
    plan = solve({512: 10, 256: 20}, 1024)
    assert sum(u for _, u in plan) == 10 and len(segments(plan)) <= 8


def test_packing_places_every_id_once(spark):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    df = spark.createDataFrame(ROWS + [(7777, "word " * 3000)], "doc_id long, text string")
    got = packing.pack(df, ["doc_id"], P.path("byte_bpe_50k.json")).collect()
    spans, texts = {}, dict(ROWS) | {7777: "word " * 3000}
    pieces = {}
    for r in got:
        ids = np.array(t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [0], "<u4")
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    for held in spans.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(spans) == list(range(len(spans)))
    assert sum(n for v in pieces.values() for _, n in v) == sum(len(t.encode(x or "", add_special_tokens=False).ids) + 1 for x in [x for _, x in ROWS] + ["word " * 3000])
    assert packing.pack(df.limit(0), ["doc_id"], P.path("byte_bpe_50k.json")).collect() == []


def test_library_coder_equals_the_library():
    alphabet = [*" \t\n\r\x85\xa0　ab's,1é½日😀́<|>", "<|endoftext|>", "  ", " x"]
    texts = TEXTS + ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    own = LibraryCoder(P.path("byte_bpe_50k.json"))
    for _ in range(2):  # the second time from memory
        for want, ids in zip(own.tokenizer.encode_batch_fast(texts, add_special_tokens=False), own.encode(texts), strict=True):
            assert want.ids == ids.tolist()
