"""Folders of batches that are merged in tiers.

A batch writes its own folder and replaces it when it is run again, so every row is stored once whatever fails in between.
Every WIDTH batches their folders are merged into one, every WIDTH of those into one again, and so on: a row is
written once for each tier, a logarithmic number of times, and a table of n batches has about WIDTH * log(n) folders.

Only batches before the running one are merged: a running batch may fail and be run again. Folders that a merge has made
needless are deleted one batch later, so that who has listed them can still read them; until then they count as part of the
merged one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

WIDTH = 8
_NAME = re.compile(r"b(\d+)-(\d+)")


def due(batch_id: int, width: int) -> tuple[int, int] | None:
    """The batches to merge before `batch_id` is stored: the largest full tier that ends there."""
    size = width
    if not batch_id or batch_id % size:
        return None
    while batch_id % (size * width) == 0:
        size *= width
    return batch_id - size, batch_id - 1


def cover(folders: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The folders that are no part of a larger one."""
    return sorted(f for f in folders if not any(g != f and g[0] <= f[0] and f[1] <= g[1] for g in folders))


@dataclass(frozen=True)
class Tiers:
    """The folders below `path`; `combine` makes the rows of a merged folder from those of its parts."""

    spark: SparkSession
    path: str
    combine: Callable[[DataFrame], DataFrame] = lambda rows: rows.hint("rebalance")
    width: int = WIDTH

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def finished(self) -> list[tuple[int, int]]:
        """First and last batch of every folder that is complete."""
        at, fs = self._fs(f"{self.path}/b*/_SUCCESS")
        names = [_NAME.fullmatch(f.getPath().getParent().getName()) for f in fs.globStatus(at) or []]
        return sorted((int(m[1]), int(m[2])) for m in names if m)

    def folder(self, first: int, last: int) -> str:
        return f"{self.path}/b{first:010d}-{last:010d}"

    def read(self, schema, before: int | None = None) -> DataFrame:
        """The rows of all batches, or of those before one."""
        found = cover([f for f in self.finished() if before is None or f[1] < before])
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.folder(*f) for f in found])

    def write(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Stores a batch and returns it as stored."""
        path = self.folder(batch_id, batch_id)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def settle(self, schema, batch_id: int) -> None:
        """Before a batch is stored: deletes what earlier merges made needless, merges what is due."""
        self.clean()
        span = due(batch_id, self.width)
        if span and span not in self.finished():
            self.merge(schema, *span)

    def clean(self) -> None:
        found = self.finished()
        for needless in set(found) - set(cover(found)):
            at, fs = self._fs(self.folder(*needless))
            fs.delete(at, True)

    def merge(self, schema, first: int, last: int) -> None:
        """Writes the batches from `first` to `last` into one folder."""
        parts = cover([f for f in self.finished() if first <= f[0] and f[1] <= last])
        if parts:
            rows = self.spark.read.schema(schema).parquet(*[self.folder(*f) for f in parts])
            self.combine(rows).write.mode("overwrite").parquet(self.folder(first, last))
