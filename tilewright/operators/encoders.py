"""Pluggable encoders: a name and a factory, called once in each worker, of a function from a batch of images to a matrix."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[list[np.ndarray]], np.ndarray]
_ENCODERS: dict[str, Callable[[], Encoder]] = {}
PRECISIONS = ("float32", "float16", "bfloat16")


def register_encoder(name: str, factory: Callable[[], Encoder]) -> None:
    """Adds an encoder; ``factory`` is called once in each worker that uses it."""
    _ENCODERS[name] = factory


def encoder_factory(name: str) -> Callable[[], Encoder]:
    if name not in _ENCODERS:
        raise ValueError(f"no encoder is registered as {name!r}")
    return _ENCODERS[name]


@lru_cache(maxsize=8)
def _loaded(factory: Callable[[], Encoder]) -> Encoder:
    return factory()


def quantised(x: np.ndarray, precision: str) -> np.ndarray:
    """Single precision numbers rounded to a shorter format, to the nearest, halves to even."""
    if precision not in PRECISIONS:
        raise ValueError(f"unknown precision {precision!r}")
    x = np.asarray(x, np.float32)
    if precision == "float16":
        with np.errstate(over="ignore"):
            return x.astype(np.float16).astype(np.float32)
    if precision == "bfloat16":
        bits = x.view(np.uint32).astype(np.uint64)
        rounded = ((bits + 0x7FFF + ((bits >> 16) & 1)) & 0xFFFF0000).astype(np.uint32)
        return np.where(np.isfinite(x), rounded.view(np.float32), x)
    return x


def encode_tiles(tiles: DataFrame, encoders: dict[str, Callable[[], Encoder]], batch: int = 64, precision: str = "float32", most_batches: int | None = None) -> DataFrame:
    """``(slide_id, tile_index, x, y, model, embedding)`` of ``tiles(slide_id, tile_index, x, y, width, height, pixels)``.

    An image is decoded once for all encoders. A tile without pixels, or whose pixels don't fit its size, is dropped with its place, as one that
    couldn't be read. ``most_batches`` ends a trial run early in each task. ``encoders`` are factories by name.
    """
    if precision not in PRECISIONS:
        raise ValueError(f"unknown precision {precision!r}")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = {name: _loaded(factory) for name, factory in encoders.items()}
        done = 0
        for pdf in batches:
            for a in range(0, len(pdf), batch):
                if most_batches is not None and done >= most_batches:
                    return
                part, done = pdf.iloc[a : a + batch], done + 1
                images, kept = [], []
                for i, (w, h, raw) in enumerate(zip(part["width"], part["height"], part["pixels"])):
                    if raw is not None and len(raw) == int(w) * int(h) * 3:
                        images.append(np.frombuffer(raw, np.uint8).reshape(int(h), int(w), 3))
                        kept.append(i)
                if images:
                    rows = part.iloc[kept][["slide_id", "tile_index", "x", "y"]]
                    for name, run in made.items():
                        yield rows.assign(model=name, embedding=list(quantised(run(images), precision)))

    kind = tiles.schema["slide_id"].dataType.simpleString()
    held = tiles.select("slide_id", *[F.col(c).cast("long").alias(c) for c in ("tile_index", "x", "y")], "width", "height", "pixels")
    return held.mapInPandas(encode, f"slide_id {kind}, tile_index long, x long, y long, model string, embedding array<float>")


def encode_slides(features: DataFrame, factory: Callable[[], Callable[..., np.ndarray]], precision: str = "float32") -> DataFrame:
    """``(slide_id, embedding)`` by a slide encoder ``(matrix, places) -> vector``; a slide's tiles meet in one task, as the encoder needs them all, in order."""
    kind = features.schema["slide_id"].dataType.simpleString()

    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tile_index")
        vector = _loaded(factory)(np.stack(pdf["embedding"].to_list()), pdf[["x", "y"]].to_numpy())
        return pd.DataFrame({"slide_id": pdf["slide_id"].iloc[:1].to_list(), "embedding": [quantised(vector, precision)]})

    return features.select("slide_id", "tile_index", "x", "y", "embedding").groupBy("slide_id").applyInPandas(encode, f"slide_id {kind}, embedding array<float>")
