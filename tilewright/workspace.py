"""Intermediate tables in the folder that the driver and all executors share.

A table written here cuts the lineage of what follows: a lost executor costs the re-reading of files, never a recomputation of
all rounds of an iteration, and a written table is read by any executor.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, the context's checkpoint folder or, in local mode alone, a new local one."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="tilewright-")
    context.setCheckpointDir(root)
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


#: Lists that note the workspaces opened inside :func:`opened`, innermost last.
_noting: list[list[Workspace]] = []


@contextmanager
def opened() -> Iterator[list[Workspace]]:
    """Gives the list of the workspaces that are opened in the block, for a caller that knows when their tables are no longer read."""
    made: list[Workspace] = []
    _noting.append(made)
    try:
        yield made
    finally:
        _noting.remove(made)


class Workspace:
    """A folder of its own below :func:`shared_root`; it goes when it is closed, or when the driver's process ends."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
        self.names: set[str] = set()
        atexit.register(self.close)
        for made in _noting:
            made.append(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes ``df`` as Parquet and returns what reads it back."""
        self.names.add(name)
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(self.path(name))
            self.names.discard(name)

    def keep(self, *names: str) -> None:
        """Drops every saved table but these."""
        self.drop(*sorted(self.names.difference(names)))

    def close(self) -> None:
        """Deletes the folder; tables that were read from it can't be read again."""
        atexit.unregister(self.close)
        try:
            self._delete(self.root)
        except Exception:  # the session has ended before the process
            pass

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
