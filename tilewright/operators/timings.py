"""Durations and counters of stages, as JSON lines."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps


class Timings:
    """Records of stages; ``summed`` adds the counters of each stage, seconds to three places."""

    def __init__(self) -> None:
        self.records: list[dict] = []

    @contextmanager
    def stage(self, name: str, **counters: float) -> Iterator[dict]:
        """Times a block; the block may add to the counters that it is given. A block that fails is recorded too."""
        began = time.time()
        try:
            yield counters
        finally:
            ended = time.time()
            self.records.append({"stage": name, "start": round(began, 3), "end": round(ended, 3), "seconds": round(ended - began, 3), **counters})

    def timed(self, call: Callable) -> Callable:
        """A function whose calls are stages of its name."""

        @wraps(call)
        def run(*args, **named):
            with self.stage(call.__name__):
                return call(*args, **named)

        return run

    def lines(self) -> str:
        return "".join(json.dumps(r) + "\n" for r in self.records)

    def summed(self) -> dict[str, dict[str, float]]:
        out: dict[str, dict[str, float]] = {}
        for r in self.records:
            held = out.setdefault(r["stage"], {})
            for k, v in r.items():
                if k not in ("stage", "start", "end"):
                    held[k] = round(held.get(k, 0) + v, 3)
        return out
