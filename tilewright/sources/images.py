"""Rasters in plain formats: uncompressed bitmaps are read, and PNG is written and read back; no other codec is here.

A reader for another format is a function from bytes to an (h, w, 3) or (h, w) array, registered by suffix.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.slides import slide_name


def read_bmp(data: bytes) -> np.ndarray:
    """An uncompressed bitmap of 8 bits (pixel values, as labels are kept) or 24 bits (RGB)."""
    if data[:2] != b"BM":
        raise ValueError("not a bitmap")
    start = struct.unpack_from("<I", data, 10)[0]
    width, height, _, bits, packed = struct.unpack_from("<iiHHI", data, 18)
    if packed or bits not in (8, 24):
        raise ValueError("only plain bitmaps of 8 or 24 bits are read")
    line = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, line * abs(height), start).reshape(abs(height), line)[:, : width * bits // 8]
    rows = rows[::-1] if height > 0 else rows
    return rows.copy() if bits == 8 else rows.reshape(abs(height), width, 3)[:, :, ::-1].copy()


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def write_png(image: np.ndarray) -> bytes:
    """An 8-bit grey or RGB image as PNG."""
    height, width = image.shape[:2]
    lines = np.ascontiguousarray(image, np.uint8).reshape(height, -1)
    raw = np.concatenate([np.zeros((height, 1), np.uint8), lines], axis=1).tobytes()  # no line is filtered
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """An 8-bit grey or RGB PNG without interlacing; all line filters of the format."""
    at, parts, head = 8, [], None
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + n]
        head = struct.unpack(">IIBBBBB", body) if kind == b"IHDR" else head
        parts += [body] if kind == b"IDAT" else []
        at += n + 12
    width, height, bits, colour, _, _, interlaced = head
    if bits != 8 or colour not in (0, 2) or interlaced:
        raise ValueError("only grey and RGB images of 8 bits are read")
    step = 3 if colour == 2 else 1
    lines = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, width * step + 1)
    out, above = np.zeros((height, width * step), np.uint8), np.zeros(width * step, np.int64)
    for y in range(height):
        kind, line = int(lines[y, 0]), lines[y, 1:].astype(np.int64)
        if kind == 2:
            line = (line + above) & 255
        elif kind in (1, 3, 4):
            for x in range(len(line)):
                left, up, corner = (line[x - step] if x >= step else 0), above[x], (above[x - step] if x >= step else 0)
                if kind == 4:
                    p = left + up - corner
                    guess = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
                else:
                    guess = left if kind == 1 else (left + up) // 2
                line[x] = (line[x] + guess) & 255
        out[y], above = line, line
    return out.reshape(height, width, 3) if step == 3 else out


_READERS: dict[str, Callable[[bytes], np.ndarray]] = {".bmp": read_bmp, ".png": read_png}


def register_reader(suffix: str, read: Callable[[bytes], np.ndarray]) -> None:
    """Adds a format by its suffix, in lower case."""
    _READERS[suffix.lower()] = read


def reader_of(path: str) -> Callable[[bytes], np.ndarray]:
    for suffix, read in _READERS.items():
        if path.lower().endswith(suffix):
            return read
    raise ValueError(f"no reader for {path}")


RASTERS = "slide_id string, path string, width int, height int, channels int, pixels binary, error string"


def read_rasters(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """:data:`RASTERS` of image files: a row a file; one that can't be read has its error and no pixels."""
    readers = dict(_READERS)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _READERS.update(readers)
        for pdf in batches:
            rows = []
            for path, slide, data in zip(pdf["path"], pdf["slide_id"], pdf["content"]):
                try:
                    image = reader_of(path)(bytes(data))
                    rows.append((slide, path, image.shape[1], image.shape[0], 1 if image.ndim == 2 else image.shape[2], np.ascontiguousarray(image, np.uint8).tobytes(), None))
                except MemoryError:
                    raise
                except Exception as problem:  # the file is noted, the others go on
                    rows.append((slide, path, None, None, None, None, f"{type(problem).__name__}: {problem}"))
            names = [x.split()[0] for x in RASTERS.split(", ")]
            yield pd.DataFrame({n: pd.Series([r[k] for r in rows], dtype=object) for k, n in enumerate(names)})

    files = spark.read.format("binaryFile").load(paths).select("path", slide_name(F.col("path")).alias("slide_id"), "content")
    return files.mapInPandas(decode, RASTERS)


def label_pixels(rasters: DataFrame) -> DataFrame:
    """``(slide_id, px, py, raw)`` of the pixels over 0 of grey rasters: what class areas are counted from."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for slide, width, height, pixels in zip(pdf["slide_id"], pdf["width"], pdf["height"], pdf["pixels"]):
                image = np.frombuffer(pixels, np.uint8).reshape(int(height), int(width))
                for a in range(0, int(height), 256):  # some rows at a time
                    y, x = np.nonzero(image[a : a + 256])
                    yield pd.DataFrame({"slide_id": slide, "px": x.astype("int64"), "py": (y + a).astype("int64"), "raw": image[a : a + 256][y, x].astype("int64")})

    return rasters.where("pixels is not null and channels = 1").mapInPandas(spread, "slide_id string, px long, py long, raw long")
