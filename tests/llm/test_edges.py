"""Nulls, keys over the whole 64 bits, empty tables, clashing columns, repeated rows and very long texts, for every operator and stage."""

import random
import re
import time
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tilewright.llm import bpe_codec, cutting_stock, nn_descent, order_minhash, packing, quality_rules, secret_scan, token_counts, token_records, url_filter, warc
from tilewright.llm.byte_bpe import encoder
from tilewright.llm.library_coder import library_coder
from tilewright.operators import spread
from tilewright.workspace import Workspace

KEYS = [1234567890123456789, -(2**63), 2**63 - 1, None, 5, 10**18 + 1]
RANKS, JSON, MODEL = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, copy string, _row long, _c0 string, bucket int"


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Rows with clashing columns, a null in every column, 64-bit keys and a repeated row."""
    rng = np.random.default_rng(2)
    rows = [(k, words(rng, 30 + i) + ' password = "Xk9#mQ2$vL7p"', "en", "a", 1234567890123456789, i, "c", i, "x", 1) for i, k in enumerate(KEYS)]
    rows += [rows[-1], (7, None, None, None, None, None, None, None, None, None), (8, "", "en", "a", None, 0, "", 0, "", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def keys_of(df, name="doc_id"):
    return sorted((r[name] is None, r[name] or 0) for r in df.select(name).collect())


def test_carried_columns_are_exact(spark, docs):
    want = keys_of(docs)
    many = ["doc_id", "n_chars", "_c0", "copy"]
    for got in (
        bpe_codec.round_trip_digests(docs, many, RANKS, P.PATTERN), bpe_codec.encode_column(docs, many, RANKS, P.PATTERN), token_counts.count_tokens(docs, many, MODEL),
        secret_scan.span_digests(docs, many), secret_scan.redact_secrets(docs, length="n_chars"), quality_rules.quality_verdicts(docs, many), token_records.write_and_read(docs, JSON, 2),
        order_minhash.near_classes(docs), packing.pack(docs, many, JSON).where("start = 0"),
    ):
        assert keys_of(got) == want, got.columns
    clean = secret_scan.redact_secrets(docs, length="n_chars")
    assert clean.columns == docs.columns and {r["n_chars"] for r in clean.where("text = ''").collect()} == {None}
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {*KEYS}


def test_empty_tables_and_stages(spark, docs):
    none = docs.limit(0)
    for got in (
        token_counts.count_tokens(none, ["doc_id"], MODEL), secret_scan.span_digests(none, ["doc_id"]), secret_scan.redact_secrets(none), token_records.write_and_read(none, JSON, 2),
        order_minhash.keep_one(none), quality_rules.quality_verdicts(none, ["doc_id"]),
    ):
        assert got.collect() == []
    for held in (none, docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, held, "")
            if name != "pack":
                assert out.columns == docs.columns, name
            assert (out.count() == 0) == (held is none), name
    assert len(corpus_pipeline._left) == 1  # only the last stage's tables are still there


def test_long_texts(spark):
    letters = "".join(random.Random(3).choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    secret = " ".join(["password: "] * 60_000) + "a1=" * 100_000 + "'" * 1001
    t = time.time()
    assert len(encoder(RANKS, P.PATTERN).decode(next(encoder(RANKS, P.PATTERN).encode([letters])))) == len(letters)
    assert token_counts.counter(MODEL).text("㐀🧿" * 300_000) == 7 * 300_000 + 1
    secret_scan.all_spans(secret)
    assert time.time() - t < 40
    long = words(np.random.default_rng(4), 40_000)
    df = spark.createDataFrame([(1, long, "en", "a"), (2, long + " end", "en", "a"), (3, "short " * 4, "en", "a")], "doc_id long, text string, lang string, source string")
    assert {r["doc_id"]: r["class_id"] for r in order_minhash.near_classes(df).collect()} == {1: 1, 2: 1, 3: 3}
    got = {r["doc_id"]: r for r in quality_rules.quality_verdicts(df, ["doc_id"]).collect()}
    assert got[1]["n_words"] == 40_000 and got[2]["n_words"] == 40_001
    assert [r["n_tokens"] for r in token_records.write_and_read(df, JSON, 2).orderBy("doc_id").collect()][0] > 40_000


def test_long_pretokens_equal_short_rounds():
    own = encoder(RANKS, P.PATTERN)
    rng = random.Random(6)
    for _ in range(400):
        word = "".join(rng.choice(rng.choice(["ab", "aaab", "thequick", "é日à"])) for _ in range(rng.randint(2, 90))).encode()
        assert own._merge_long(word).tolist() == own._merge_matrix([word])[0].tolist()


def slow_measures(text):
    """The base columns of the quality rules, word by word."""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(ws) - 4):
        windows.setdefault(tuple(ws[i : i + 5]), []).append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len({*lines}), len(repeated)


def test_quality_measures_by_brute_force(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\t ", "a b c d e " * 300] + ["".join(rng.choice(["a ", "b ", "c ", "a b c d e ", "\n", "# ", "\t", "é", "日本 "]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in quality_rules.quality_verdicts(df, ["doc_id"]).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == slow_measures(texts[r["doc_id"]]), texts[r["doc_id"]]


def generated(rng):
    """A configuration or source text, and the literals that a sensitive name gets in it, as it was put together."""
    value = lambda: "".join(rng.choice("ABCDEFGHkmnpqrstuvwxyz23456789#!%") for _ in range(14)) + "x9Q#"
    lines, secret = [], []
    for k in range(rng.randint(1, 8)):
        v, hot = value(), rng.random() < 0.5
        name = rng.choice(["db_password", "apiKey", "client.secret", "SSH_PASSPHRASE"] if hot else ["title", "colour", "path_of_x", "width"]) + str(k)
        kind = rng.randrange(8)
        parts = [v]
        if kind == 0:
            line = f'{name} = "{v}"'
        elif kind == 1:
            line = f"{name}: '{v}',"
        elif kind == 2:
            line = f"{name} =" + " " * rng.randint(0, 90) + f'"""{v}"""'
        elif kind == 3:
            line = f"<{name}>{v}</{name}>"
        elif kind == 4:
            parts = [v[:9], v[9:]]
            line = f'{name} = "{parts[0]}"' + rng.choice([" + ", " "]) + f'"{parts[1]}"'
        elif kind == 5:
            line = f'c{k}_0 = "{v}"\n' + "".join(f"c{k}_{i + 1} = c{k}_{i}\n" for i in range(rng.randint(1, 9)))
            line += f"{name} = c{k}_{line.count('=') - 1}"
        elif kind == 6:
            line = f"{name}: |\n    {v}\nother{k}: 1"
        else:
            line = f'{{"{name}": "{v}"}}'
        lines.append(line)
        secret += parts if hot else []
    return "\n".join(lines) + "\n", secret


def test_named_literals_of_generated_texts():
    rng = random.Random(9)
    for _ in range(1500):
        text, secret = generated(rng)
        assert sorted(text[a:b] for a, b in secret_scan.named_spans(text)) == sorted(secret), text


def test_base_spans_of_all_documents(spark):
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    patterns = {
        "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, 2, 6), "access": (r"AKIA[A-Z0-9]+", 0, 0, 20), "hex": (r"[0-9a-f]+", 0, 0, 24),
    }
    for t in texts:
        want = [(m.start(), list(patterns).index(k), m.end(), k) for k, (p, flags, group, least) in patterns.items() for m in re.finditer(p, t, flags) if len(m.group(group)) >= least]
        assert [(a, b, k) for a, b, k in secret_scan.base_spans(t)] == [(a, b, k) for a, _, b, k in sorted(want)]


def test_packing_is_priced_and_padded(spark):
    rng = np.random.default_rng(5)
    for n in (3, 300, 4000):
        histogram = {int(k): int(c) for k, c in zip(*np.unique(rng.integers(1, 1024, n), return_counts=True))}
        lengths = np.array(sorted(histogram))
        program = cutting_stock.linear_program(lengths, np.array([histogram[int(k)] for k in lengths], float), 1024)
        assert program.priced > 0 and program.end in ("optimal", "whole", "gap") and (program.end != "gap" or program.gap <= 2e-4)
        used = sum(k for _, k in cutting_stock.solve(histogram, 1024))
        assert program.bound - 1e-6 <= used <= program.bound * 1.02 + 2
    df = spark.createDataFrame([(i, None if i < 3000 else "a b c " * (i - 2990), i) for i in range(3060)], "doc_id long, text string, sequence_id long")
    pieces = packing.pack(df, ["doc_id", "sequence_id"], JSON).toPandas()
    assert len(pieces.columns) == 8 and pieces["doc_id"].nunique() == 3060
    ws = Workspace(spark, "t")
    done = ws.save(packing.tokenised(df, ["doc_id"], JSON, 0, 1024, "text").withColumn("_row", F.monotonically_increasing_id()), "d")
    assert done.where("n = 1").select(F.pmod(F.xxhash64("_row"), F.lit(8)).alias("b")).groupBy("b").count().count() == 8
    parts = spark.createDataFrame([(0, 0, [1, 2, 3]), (0, 3, [4]), (1, 0, [5, 6, 7])], "sequence_id long, offset long, ids array<int>")
    got = {r["sequence_id"]: (r["ids"], r["n_tokens"]) for r in packing.sequences(parts, 8).collect()}
    assert got == {0: ([1, 2, 3, 4], 4), 1: ([5, 6, 7, 0, 0, 0, 0, 0], 3)}


def test_vectors_with_odd_rows(spark):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((40, 8))
    rows = [(i, (x[i] * s).tolist(), 1, "w") for i in range(40) for s in ([1e-200] if i % 3 == 0 else [1e200] if i % 3 == 1 else [1.0])]
    rows += [(100 + i, x[i].tolist(), 1, "w") for i in range(5)] + [(101, x[1].tolist(), 2, "v"), (None, x[0].tolist(), 1, "w"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id long, vec string")
    got = nn_descent.near_vectors(df).collect()
    by_id = {r["vec_id"]: r for r in got}
    assert len(got) == len(rows) and all(by_id[100 + i]["component_id"] == i and by_id[100 + i]["n_links"] >= 1 for i in range(5))
    assert [r["component_id"] for r in got if r["vec_id"] is None] == [None, None]
    one = nn_descent.unit_rows([r.tobytes() for r in x], "<f8")
    for a, b in ((one[:3], one[:3]), (one, one), (one[1:2], one)):
        s = nn_descent.cosines(a, b, float(one[1] @ one[2]))
        assert (s[1 if len(a) > 1 else 0, 2] == nn_descent.cosines(one[1:2], one[2:3], float(one[1] @ one[2]))[0, 0])


def test_hot_keys_are_split(spark):
    large = spark.createDataFrame([(i % 3 if i % 5 else 0, i) for i in range(400)] + [(None, 900)], "k long, v long")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c"), (8, "d"), (9, "e")], "k long, w string")
    plain = {how: sorted(map(tuple, large.join(small, ["k"], how).select("v").collect())) for how in ("inner", "left", "left_semi")}
    for how, want in plain.items():
        for most in (10, 4):
            got = spread.spread_join(large, small, ["k"], how, most=most, part_rows=20)
            assert sorted(map(tuple, got.select("v").collect())) == want


def test_urls_with_hubs_cycles_and_repeats(spark, monkeypatch):
    link = lambda *to: "".join(f'<a href="http://{t}/">x</a>' for t in to)
    rows = [("bad.org", "")] + [(f"h{i}.com", link("bad.org", f"h{(i + 1) % 9}.com")) for i in range(9)] + [("hub.com", link(*[f"h{i}.com" for i in range(9)]))] * 2 + [("good.org", link("fine.com") + "x" * 300_000), ("fine.com", None)]
    df = spark.createDataFrame([(i, f"http://{h}/x", t, "k", 0.0) for i, (h, t) in enumerate(rows)], "page_id long, url string, html string, host string, trust double")
    rules = [url_filter.Rule("block", "bad.org/"), url_filter.Rule("allow", "good.org/")]
    plain = sorted(map(str, url_filter.filter_urls(df, rules).withColumns({c: F.round(c, 9) for c in ("trust", "distrust")}).collect()))
    assert len(plain) == len(rows) and sum("'block'" in r for r in plain) >= 10
    monkeypatch.setattr(url_filter, "SENT_ROWS", 0)
    monkeypatch.setattr(url_filter, "ROWS_A_PART", 3)
    assert sorted(map(str, url_filter.filter_urls(df, rules).withColumns({c: F.round(c, 9) for c in ("trust", "distrust")}).collect())) == plain


def test_archives_of_several_blocks(spark):
    evil = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40
    rows = [(i, "u", ("é" * (i % 50) + evil) if i % 3 else f"page {i % 7}", "x", 1) for i in range(400)] + [(3, "u", "page 3", "x", 1)] * 2 + [(500, "u", "big " * 20_000, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string, bytes long").coalesce(2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = warc.archive_round_trip(df).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["page_id"] for r in got) == sorted(r[0] for r in rows)
    texts = {r[0]: r[2] for r in rows}
    last = {t: i for i, t in sorted(texts.items())}
    for r in got:
        assert r["payload_bytes"] == len(texts[r["page_id"]].encode())
        assert r["refers_to"] == (None if last[texts[r["page_id"]]] == r["page_id"] else last[texts[r["page_id"]]])


def test_crc_of_records_beside_nulls(spark):
    df = spark.createDataFrame([(k, f"text {i}", "x", 1) for i, k in enumerate(KEYS)], "doc_id long, text string, file string, offset long")
    got = {r["doc_id"]: r for r in token_records.write_and_read(df, JSON, 2).collect()}
    coder = library_coder(JSON)
    for i, k in enumerate(KEYS):
        ids = np.append(next(coder.encode([f"text {i}"])), 2).astype("<u4")
        assert got[k]["ids_crc32"] == zlib.crc32(ids.tobytes()) and got[k]["n_tokens"] == len(ids)
    assert got[None]["start"] == 0
