"""Feeds as a Spark data source, for batches and streams.

A feed is the caller's: it names its items (symbols, companies), says how far each has come, and fetches the answers between
two marks. `register_feed` makes it a format of the session; every item is a partition that a task fetches, and a
stream keeps the marks of all items as its offset, so that a restart goes on where it stopped. The rows hold the raw
answers for `feeds.normalize`.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator, Sequence
from typing import Protocol
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

log = logging.getLogger(__name__)


class Feed(Protocol):
    """What a source of answers has to have. It is sent to the tasks, so it opens its connections when it fetches."""

    def items(self) -> Sequence[str]:
        """What answers can be asked for."""

    def reached(self, item: str) -> int:
        """How many answers the item has so far; never less than before."""

    def fetch(self, item: str, first: int, last: int) -> Iterable[str]:
        """The answers of an item from number `first` up to `last`, without it."""


class _Part(InputPartition):
    def __init__(self, item: str, first: int, last: int):
        self.item, self.first, self.last = item, first, last


def _read(feed: Feed, part: _Part) -> Iterator[tuple]:
    """A feed that fails for an item is logged and gives one row with the message, not a failed task."""
    number = part.first
    try:
        for payload in feed.fetch(part.item, part.first, part.last):
            yield part.item, number, payload, None
            number += 1
    except Exception as e:
        log.error("%s: %s", part.item, e)
        yield part.item, number, None, f"{type(e).__name__}: {e}"


class _Reader(DataSourceReader):
    def __init__(self, feed: Feed):
        self.feed = feed

    def partitions(self) -> list[_Part]:
        return [_Part(i, 0, n) for i in self.feed.items() if (n := self.feed.reached(i))]

    def read(self, partition: _Part) -> Iterator[tuple]:
        return _read(self.feed, partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, feed: Feed):
        self.feed = feed

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {item: self.feed.reached(item) for item in self.feed.items()}

    def partitions(self, start: dict, end: dict) -> list[_Part]:
        return [_Part(i, start.get(i, 0), n) for i, n in end.items() if n > start.get(i, 0)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        return _read(self.feed, partition)

    def commit(self, end: dict) -> None:
        """Answers stay where they are: a batch may be fetched again."""


def register_feed(spark: SparkSession, name: str, feed: Feed, item: str = "symbol") -> None:
    """Makes a feed the format `name` of the session: rows (`item`, seq, payload, error), one per answer."""

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"`{item}` string, seq bigint, payload string, error string"

        def reader(self, schema) -> DataSourceReader:
            return _Reader(feed)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _StreamReader(feed)

    spark.dataSource.register(Source)


class FileFeed:
    """Answers in files: a folder per item, in it or below one file per answer; later answers have later names.

    The folder names the item, alone or as `column=item`. The path is opened by pyarrow (a local folder, HDFS, S3).
    """

    def __init__(self, path: str):
        self.path = path

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def _folders(self) -> dict[str, str]:
        system, root = self._open()
        found = [f for f in system.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.Directory]
        return {unquote(f.base_name.split("=", 1)[-1]): f.path for f in found if not f.base_name.startswith(("_", "."))}

    def _files(self, folder: str) -> list[str]:
        found = self._open()[0].get_file_info(fs.FileSelector(folder, recursive=True))
        return sorted(f.path for f in found if f.is_file and not f.base_name.startswith(("_", ".")))

    def items(self) -> list[str]:
        return sorted(self._folders())

    def reached(self, item: str) -> int:
        return len(self._files(self._folders()[item]))

    def fetch(self, item: str, first: int, last: int) -> Iterator[str]:
        for path in self._files(self._folders()[item])[first:last]:
            with self._open()[0].open_input_stream(path) as stream:
                yield stream.read().decode()
