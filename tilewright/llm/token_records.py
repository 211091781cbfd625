"""Token ids as length-delimited binary records with a separate index of offsets.

A frame is: length of the data (8 bytes, little-endian), masked CRC-32C of those 8 bytes (4), the data, masked CRC-32C of the data (4); readers
of that common record format can read the files. The data is: 1 byte for the version and whether an id is there, 8 bytes of document id, 1
byte with the width of an id, the ids little-endian. The index has the file, place and length of every frame, for reads in any order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.bpe_codec import slices
from tilewright.workspace import Workspace

HEAD = struct.Struct("<BqB")
INDEX = pa.schema([("part", pa.int32()), ("file", pa.string()), ("ordinal", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("doc_id", pa.int64()), ("n_ids", pa.int64())])
CHUNK = 1024


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32C of a byte followed by 0 .. CHUNK-1 zero bytes; the step over CHUNK zero bytes by byte of the register."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0x82F63B78), t >> 1).astype(np.uint32)
    step = lambda x: (x >> np.uint32(8)) ^ t[x & np.uint32(255)]
    after = np.empty((CHUNK, 256), np.uint32)
    after[0] = t
    for k in range(1, CHUNK):
        after[k] = step(after[k - 1])
    over = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(CHUNK):
        over = step(over)
    return t, np.ascontiguousarray(after[::-1]).ravel(), over


BYTE, AFTER, OVER = _tables()
PLACE = np.arange(CHUNK, dtype=np.int64) * 256


def crc32c(data: bytes) -> int:
    """CRC-32C (Castagnoli). Bytes are looked up by their distance from the end, chunks at a time, and folded."""
    n = len(data)
    if n < 4:
        r = 0xFFFFFFFF
        for b in data:
            r = (r >> 8) ^ int(BYTE[(r ^ b) & 255])
        return r ^ 0xFFFFFFFF
    rows = -(-n // CHUNK)
    padded = np.zeros(rows * CHUNK, np.uint8)  # zero bytes in front change nothing
    padded[-n:] = np.frombuffer(data, np.uint8)
    padded[-n : len(padded) - n + 4] ^= 255  # the initial register
    parts = np.bitwise_xor.reduce(AFTER[padded.reshape(rows, CHUNK) + PLACE], axis=1)
    r = 0
    for p in parts.tolist():
        r = int(OVER[0, r & 255] ^ OVER[1, (r >> 8) & 255] ^ OVER[2, (r >> 16) & 255] ^ OVER[3, r >> 24]) ^ p
    return r ^ 0xFFFFFFFF


def masked(crc: int) -> int:
    """Rotated by 15 bits plus a constant, so that a checksum of data with checksums in it isn't trivial."""
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    length = struct.pack("<Q", len(data))
    return b"".join((length, struct.pack("<I", masked(crc32c(length))), data, struct.pack("<I", masked(crc32c(data)))))


def serialise(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    return HEAD.pack(1 if doc_id is None else 3, doc_id or 0, wide) + ids.astype("<u2" if wide == 2 else "<u4").tobytes()


def deserialise(data: bytes) -> tuple[int | None, np.ndarray]:
    kind, doc_id, wide = HEAD.unpack_from(data)
    if kind not in (1, 3) or wide not in (2, 4):
        raise ValueError("unknown record version")
    return doc_id if kind == 3 else None, np.frombuffer(data, "<u2" if wide == 2 else "<u4", offset=HEAD.size)


def read_frame(stream) -> bytes | None:
    """The data of the next frame after both checks; null at the end of the stream."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(crc32c(head[:8])):
        raise ValueError("a record's length is damaged")
    n = struct.unpack("<Q", head[:8])[0]
    body = stream.read(n + 4)
    if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked(crc32c(body[:n])):
        raise ValueError("a record is damaged")
    return body[:n]


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=f.type) for k, f in enumerate(schema)], schema=schema)


def filesystem(uri: str):
    """The file system of a shared folder and the path there; a plain path is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encodes and writes whole texts in ascending ``key`` order; returns the index, to be saved by the caller at once.

    Index columns: ``part`` (files by ascending key), ``file``, ``ordinal``, ``offset``, ``length`` (of the frame), ``doc_id``, ``n_ids``. Rows are dealt out by
    ranges of the key before they are encoded, so no task sorts or holds more than its range. A task writes to a name of its own attempt
    and the index names the attempts that counted; files of lost or repeated attempts are never read. Null text is
    empty, a null key comes first, equal keys are in no set order, repeated rows are written each, and an empty table gives no file. A very
    long text is one frame, which a task holds whole, as it does its ids. Other columns of ``docs`` aren't read, so their names can't clash.
    """
    held = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = held.repartitionByRange("doc_id").sortWithinPartitions("doc_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from tilewright.llm.library_coder import library_coder

        coder, task = library_coder(tokenizer), TaskContext.get()
        name = f"records-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        system, path = filesystem(folder)
        out, ordinal, offset = None, 0, 0
        for batch in batches:
            keys, texts, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for a, b in slices(texts):
                for k, ids in zip(keys[a:b], coder.encode(texts[a:b])):
                    if out is None:
                        system.create_dir(path, recursive=True)
                        out = system.open_output_stream(f"{path}/{name}")
                    ids = np.append(ids, end_id)
                    data = frame(serialise(k, ids))
                    out.write(data)
                    rows.append((task.partitionId(), name, ordinal, offset, len(data), k, len(ids)))
                    ordinal, offset = ordinal + 1, offset + len(data)
            yield record_batch(rows, INDEX)
        if out is not None:
            out.close()

    return dealt.mapInArrow(write, "part int, file string, ordinal long, offset long, length long, doc_id long, n_ids long")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the files that the index names; checks every frame and every file's count.

    ``start`` counts the ids of all documents before, by part and place. Sums of files, a row each, are the only thing gathered.
    """
    files = index.groupBy("part", "file").agg(F.sum("n_ids").alias("ids"), F.count("*").alias("frames"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def numbers(rows: list[tuple]) -> pd.DataFrame:
        keys = pd.array([r[0] for r in rows], "Int64")  # from Python numbers, so exact beside nulls
        return pd.DataFrame([r[1:] for r in rows], columns=["start", "n_tokens", "ids_crc32"]).assign(doc_id=keys)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = filesystem(folder)
        for pdf in batches:
            for row in pdf.itertuples():
                at, rows = int(row.base), []
                with system.open_input_stream(f"{path}/{row.file}", buffer_size=1 << 20) as stream:
                    frames = 0
                    while (data := read_frame(stream)) is not None:
                        doc_id, ids = deserialise(data)
                        rows.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        at, frames = at + len(ids), frames + 1
                        if len(rows) == 20_000:
                            yield numbers(rows)
                            rows = []
                if frames != row.frames:
                    raise ValueError(f"{row.file} has {frames} records, the index has {row.frames}")
                yield numbers(rows)

    # By number: a list of files is small, and would be merged into one task, which would then read all of them.
    n = index.select("file").distinct().count()
    return files.repartition(max(1, n), "file").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_at(index: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, ids array<int>)`` of the frames that ``index`` lists, each read by its offset: reads in shuffled order or of a sample."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, path = filesystem(folder)
        for pdf in batches:
            rows = []
            for name, part in pdf.sort_values(["file", "offset"]).groupby("file"):
                with system.open_input_file(f"{path}/{name}") as stream:
                    for offset in part["offset"]:
                        stream.seek(int(offset))
                        doc_id, ids = deserialise(read_frame(stream))
                        rows.append((doc_id, ids.astype(np.int32).tolist()))
            yield pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "ids": [r[1] for r in rows]})

    return index.select("file", "offset").mapInPandas(read, "doc_id long, ids array<int>")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Writes the files below the shared folder, saves the index there, and reads everything back."""
    ws = Workspace(docs.sparkSession, "records")
    folder = ws.path("files")
    index = ws.save(write_records(docs, folder, tokenizer, end_id, text, key), "index")
    return read_records(index, folder)
