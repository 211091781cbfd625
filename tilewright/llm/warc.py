"""WARC archives: written by Spark's text writer, read back by verified boundary chains.

A reader task sees only a stretch of a file, where the record magic may also stand inside a payload. So every place with the magic
is a candidate, with the place that its header gives for its successor. Starting at each file's begin, pointer jumping keeps the
candidates that the chain reaches, in a number of rounds that is the logarithm of the records in a file; the others are payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilewright.operators.spread import spread_join
from tilewright.workspace import Workspace

MAGIC = "WARC/1.1\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
LENGTH = re.compile(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$")
ROOM = len(MAGIC)
#: The digits of base32 in order (fixed values).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ENTRY = "file string, block long, k long, rel long, size long, candidate boolean, head long, content long, whole boolean, record_type string, page_id long, refers_to long, payload_digest string, payload_bytes long"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary or string column."""
    digest = F.sha1(payload)
    part = lambda k: F.conv(F.substring(digest, 10 * k + 1, 10), 16, 10).cast("long")  # noqa: E731  40 bits
    digit = lambda x, i: F.substring(F.lit(BASE32), (F.shiftright(x, 35 - 5 * i).bitwiseAND(31) + 1).cast("int"), F.lit(1))
    return F.concat(*[digit(part(k), i) for k in range(4) for i in range(8)])


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0) -> None:
    """A record for each row of ``pages``, in uncompressed archives below ``folder``.

    Rows with equal payloads of ``least_bytes`` or more: those with the largest key are responses, the others revisits without payload, which refer
    to it; smaller payloads are all responses. A null payload is empty, a null url or key has no header line, and a null key is less
    than any other. Archives are text files whose line separator is the end of a record, so any store that Spark writes to will do.
    Repeated rows are records each; an empty table gives no record. A task holds one payload at a time, however long. Other columns aren't
    read, so their names can't clash. Payloads stay where they are unless the list of repeated digests is too long to be sent.
    """
    ws = Workspace(pages.sparkSession, "warc-write")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    rows = rows.withColumns({"digest": sha1_base32(F.col("payload")), "bytes": F.octet_length("payload").cast("long")})
    copies = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("key").alias("first_key"), F.count("*").alias("n")).where("n > 1")
    told = spread_join(rows, ws.save(copies.select("digest", "first_key"), "copies"), ["digest"], "left")
    revisit = (F.col("bytes") >= least_bytes) & F.col("first_key").isNotNull() & ~F.col("key").eqNullSafe(F.col("first_key"))
    told = told.withColumn("revisit", F.coalesce(revisit, F.lit(False)))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))
    uuid = lambda k: F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(k.cast("string")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    block = F.concat(F.lit(HTTP), F.when(F.col("revisit"), "").otherwise(F.col("payload")))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(uuid(F.col("key")), F.lit("<urn:uuid:00000000-0000-0000-0000-000000000000>"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20]", "%20")),
        line("WARC-Page-Key", F.col("key")),
        line("WARC-Refers-To", F.when(F.col("revisit"), uuid(F.col("first_key")))),
        line("WARC-Refers-To-Key", F.when(F.col("revisit"), F.col("first_key"))),
        line("WARC-Profile", F.when(F.col("revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )
    told.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").text(folder)
    ws.close()


def parse_header(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.split(b"\r\n"):
        name, sign, value = line.partition(b":")
        if sign:
            fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return fields


def parse_record(value: bytes) -> dict:
    """What follows a magic: header length, content length, whether the content is all there, and of the record its fields and digest."""
    cut = value.find(b"\r\n\r\n")
    found = LENGTH.search(value[: cut + 2]) if cut >= 0 else None
    if not found or len(found[1]) > 18:
        return {}
    head, content = cut + 4, int(found[1])
    out = {"head": head, "content": content, "whole": len(value) >= head + content}
    if not out["whole"]:
        return out
    fields = parse_header(value[:cut])
    block = value[head : head + content]
    if fields.get("content-type", "").startswith("application/http"):
        block = block[block.find(b"\r\n\r\n") + 4 :] if b"\r\n\r\n" in block else b""
    number = lambda x: int(x) if x and re.fullmatch(r"-?[0-9]{1,19}", x) and -(2**63) <= int(x) < 2**63 else None
    revisit = fields.get("warc-type") == "revisit"
    own = fields.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else base64.b32encode(hashlib.sha1(block).digest()).decode()
    return out | {
        "record_type": fields.get("warc-type"), "page_id": number(fields.get("warc-page-key")), "refers_to": number(fields.get("warc-refers-to-key")),
        "payload_digest": own, "payload_bytes": None if revisit else len(block),
    }


def stretches_of(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, block, value)``: what lies between two magics, in the order of each split of a file."""
    lines = spark.read.option("lineSep", MAGIC).text(folder)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[int], list[int]]]:
    """Each batch with the number and the relative offset of its stretches within their block."""
    held, k, rel = None, 0, 0
    for pdf in batches:
        ks, rels = [], []
        for file, block, value in zip(pdf["file"], pdf["block"], pdf["value"]):
            if held != (file, block):
                held, k, rel = (file, block), 0, 0
            ks.append(k)
            rels.append(rel)
            k, rel = k + 1, rel + len(value) + ROOM
        yield pdf, ks, rels


def candidates(ws: Workspace, folder: str) -> DataFrame:
    """:data:`ENTRY` with ``start``, ``succ`` (file offsets) for every stretch; only small fields leave the tasks."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in ENTRY.split(", ")]
        kinds = {c: "Int64" for c in ("head", "content", "page_id", "refers_to", "payload_bytes", "block", "k", "rel", "size")}
        for pdf, ks, rels in numbered(batches):
            rows = []
            for file, block, value, k, rel in zip(pdf["file"], pdf["block"], pdf["value"], ks, rels):
                candidate = k > 0 or block > 0
                rows.append({"file": file, "block": block, "k": k, "rel": rel, "size": len(value), "candidate": candidate} | (parse_record(value) if candidate else {}))
            yield pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype=kinds.get(c, object)) for c in names})

    entries = ws.save(stretches_of(ws.spark, folder).mapInPandas(emit, ENTRY), "entries")
    blocks = entries.groupBy("file", "block").agg(F.sum(F.col("size") + ROOM).alias("span"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("base", F.coalesce(F.sum("span").over(before), F.lit(0))).drop("span")
    placed = entries.join(blocks, ["file", "block"]).withColumn("start", F.col("base") + F.col("rel") - ROOM)
    placed = placed.withColumn("succ", F.when(F.col("candidate"), F.col("start") + ROOM + F.col("head") + F.col("content") + 4))
    placed = ws.save(placed.drop("base"), "placed")
    ws.drop("entries")
    return placed


def reachable(ws: Workspace, entries: DataFrame) -> DataFrame:
    """``(file, start)`` of the candidates on the chain from each file's begin.

    After round k a pointer spans ``2 ** k`` records and the first ``2 ** k`` records of each file are found, so both tables stay no
    longer than the list of candidates.
    """
    nodes = entries.where("candidate").select("file", "start", "succ")
    links = nodes.join(nodes.select("file", F.col("start").alias("succ")), ["file", "succ"]).select("file", "start", F.col("succ").alias("to"))
    roots = nodes.where("start = 0").select("file", "start", F.lit(None).cast("long").alias("to"))
    state = ws.save(roots.withColumn("found", F.lit(True)).unionByName(links.withColumn("found", F.lit(False))), "chain-0")
    k = 0
    while True:
        found, jumps = state.where("found").select("file", "start"), state.where("not found").select("file", "start", "to")
        if jumps.isEmpty():
            return found
        more = found.join(jumps, ["file", "start"]).select("file", F.col("to").alias("start"))
        far = jumps.join(jumps.select("file", F.col("start").alias("to"), F.col("to").alias("end")), ["file", "to"]).select("file", "start", F.col("end").alias("to"), F.lit(False).alias("found"))
        both = found.union(more).select("file", "start", F.lit(None).cast("long").alias("to"), F.lit(True).alias("found")).unionByName(far)
        state = ws.save(both, f"chain-{k + 1}")
        ws.drop(f"chain-{k}")
        k += 1


def stitched(ws: Workspace, folder: str, entries: DataFrame, records: DataFrame) -> DataFrame:
    """Records whose payload holds the magic: their stretches are read once more, put together and parsed, with the columns of ``records``."""
    split = records.where("not whole").select("file", F.col("start").alias("owner"), F.col("succ").alias("until"))
    blocks = entries.groupBy("file", "block").agg(F.min("start").alias("lo"), F.max("start").alias("hi"))  # a file has few
    owners = split.join(blocks, "file").where((F.col("hi") >= F.col("owner")) & (F.col("lo") < F.col("until")))
    owners = owners.select("file", "block", F.greatest("owner", "lo").alias("start"), F.lit(None).cast("long").alias("k"), F.struct("owner", "until").alias("held"))
    both = owners.unionByName(entries.select("file", "block", "start", "k", F.lit(None).cast("struct<owner:bigint,until:bigint>").alias("held")))
    # Records on a chain don't overlap, so the last one that began, here or before this block, is the only one that can own a stretch.
    so_far = Window.partitionBy("file", "block").orderBy("start", F.col("k").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    spans = both.withColumn("held", F.last("held", ignorenulls=True).over(so_far)).where(F.col("k").isNotNull() & (F.col("start") < F.col("held.until")))
    spans = spans.select("file", "block", "k", F.col("held.owner").alias("owner"), "start")
    needed = ws.save(spans, "needed")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, ks, _ in numbered(batches):
            yield pdf.assign(k=ks)

    values = stretches_of(ws.spark, folder).mapInPandas(number, "file string, block long, value binary, k long")
    parts = values.join(needed, ["file", "block", "k"]).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"))  # one record's payload

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = ("page_id", "refers_to", "payload_bytes")
        kept = ["record_type", "page_id", "refers_to", "payload_digest", "payload_bytes"]
        for pdf in batches:
            rows = [parse_record(MAGIC.encode().join(bytes(p["value"]) for p in parts)) for parts in pdf["parts"]]
            out = pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype="Int64" if c in numbers else object) for c in kept})
            yield out.assign(file=list(pdf["file"]), start=list(pdf["owner"]))

    return parts.mapInPandas(parse, "record_type string, page_id long, refers_to long, payload_digest string, payload_bytes long, file string, start long")


def read_archives(ws: Workspace, folder: str) -> DataFrame:
    """``(page_id, record_type, refers_to, payload_digest, payload_bytes)`` of every record on the chains; revisits have no bytes of their own.

    The last record on a file's chain must end the file, else the archive is damaged and the read fails. A number that is no signed 64-bit
    one is null, as is a header line that is missing. Every record comes back, repeated ones too; a folder without records gives an empty
    table. A record is parsed whole in one task, however long.
    """
    entries = candidates(ws, folder)
    records = entries.join(reachable(ws, entries), ["file", "start"])
    records = ws.save(records, "records")
    ws.drop(*[name for name in ws.names if name.startswith("chain-")])
    ends = entries.groupBy("file").agg(F.max(F.col("start") + ROOM + F.col("size")).alias("end"), F.max("size").alias("longest")).where("end > 0 and longest > 0")
    broken = ends.join(records.groupBy("file").agg(F.max("succ").alias("last")), "file", "left").where("last is null or last <> end").select("file").first()
    if broken:
        raise ValueError(f"the chain of records doesn't reach the end of {broken['file']}")
    columns = ["record_type", "page_id", "refers_to", "payload_digest", "payload_bytes"]
    whole = records.where("whole").select(*columns)
    if records.where("not whole").isEmpty():
        return whole
    return whole.unionByName(stitched(ws, folder, entries, records).select(*columns))


def archive_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` and reads the archives back: ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``.

    A revisit's bytes are those of the response that it refers to. Null payloads are empty, and rows with a null key are less than all
    others: of copies with null keys only, each is a response. Rows that share the largest key of a payload are responses each. An empty table
    gives an empty one. Other columns aren't read, so their names can't clash. The archives go once they are read.
    """
    ws = Workspace(pages.sparkSession, "warc")
    folder = ws.path("archives")
    write_archives(pages, folder, key, url, payload, least_bytes=least_bytes)
    found = ws.save(read_archives(ws, folder), "found")
    ws.keep("found")
    ws.drop("archives")
    referred = found.where("refers_to is not null").select("refers_to").distinct().withColumnRenamed("refers_to", "page_id")
    sizes = found.where("record_type = 'response' and page_id is not null").join(referred, "page_id", "left_semi").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("full_bytes"))
    full = spread_join(found, ws.save(sizes, "sizes"), ["refers_to", "payload_digest"], "left")
    return full.select(F.col("page_id").alias(key), F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
