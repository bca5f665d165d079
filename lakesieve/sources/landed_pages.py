"""Landed API responses as a data source of its own, read in parallel or as a stream.

A feed's responses lie under ``path/feed=<feed>/page=<number>/``, one or several text
files a page, which is how Spark's writers lay them out. A feed's pages land in ascending
order, so a stream's place is the last page of every feed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "feed string, page bigint, body string"
#: Bytes of pages that one task reads, or one page.
PARTITION_BYTES = 32 << 20


@dataclass
class Pages(InputPartition):
    """Whole pages: ``(feed, page, files)``."""

    pages: list[tuple[str, int, list[str]]]


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it; a path without a scheme is a local one."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" and rest.startswith("/"):
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _value(folder: str, name: str) -> str | None:
    """What a folder named ``name=value`` stands for."""
    return unquote(folder[len(name) + 1 :]) if folder.startswith(f"{name}=") else None


def landed(path: str, after: dict[str, int] | None = None, until: dict[str, int] | None = None) -> list[tuple[str, int, int, list[str]]]:
    """``(feed, page, bytes, files)`` of pages by feed and number: later than ``after``, up to ``until``.

    Only folders are listed that hold such pages.
    """
    system, root = _file_system(path)
    found = []
    for feed_folder in system.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        feed = _value(feed_folder.base_name, "feed")
        if feed is None or (until is not None and feed not in until):
            continue
        for folder in system.get_file_info(pafs.FileSelector(feed_folder.path)):
            number = _value(folder.base_name, "page")
            if number is None or not number.lstrip("-").isdigit():
                continue
            page = int(number)
            if (after and page <= after.get(feed, page - 1)) or (until is not None and page > until[feed]):
                continue
            files = [f for f in system.get_file_info(pafs.FileSelector(folder.path)) if f.is_file and f.base_name[:1] not in "._"]
            if files:
                found.append((feed, page, sum(f.size for f in files), sorted(f.path for f in files)))
    return sorted(found)


def _dealt(pages: list[tuple[str, int, int, list[str]]], most: int) -> list[Pages]:
    parts, held = [], 0
    for feed, page, size, files in pages:
        if not parts or held + size > most:
            parts.append(Pages([]))
            held = 0
        parts[-1].pages.append((feed, page, files))
        held += size
    return parts


def _bodies(path: str, part: Pages) -> Iterator[pa.RecordBatch]:
    system, _ = _file_system(path)
    for feed, page, files in part.pages:
        texts = []
        for file in files:
            with system.open_input_stream(file) as stream:
                texts.append(stream.read().decode("utf-8", "replace"))
        body = "".join(texts).rstrip("\n")
        yield pa.RecordBatch.from_arrays([pa.array([feed]), pa.array([page], pa.int64()), pa.array([body])], ["feed", "page", "body"])


class _Batch(DataSourceReader):
    def __init__(self, path: str, most: int) -> None:
        self.path, self.most = path, most

    def partitions(self) -> list[Pages]:
        # without a partition Spark asks for one that is None
        return _dealt(landed(self.path), self.most) or [Pages([])]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return _bodies(self.path, partition)


class _Stream(DataSourceStreamReader):
    """Offsets are ``{feed: last page}``; a feed that lands later is read from its first page."""

    def __init__(self, path: str, most: int) -> None:
        self.path, self.most = path, most

    def initialOffset(self) -> dict[str, int]:
        return {}

    def latestOffset(self) -> dict[str, int]:
        last: dict[str, int] = {}
        for feed, page, _, _ in landed(self.path):
            last[feed] = max(page, last.get(feed, page))
        return last

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Pages]:
        return _dealt(landed(self.path, start, end), self.most)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return _bodies(self.path, partition)


class LandedPages(DataSource):
    """``spark.read.format("landed_pages").load(path)``, and ``readStream`` alike.

    One row for each page: its ``feed``, number and whole ``body``. The option
    ``partitionBytes`` bounds what a task reads beyond one page.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return SCHEMA

    def _settings(self) -> tuple[str, int]:
        if "path" not in self.options:
            raise ValueError("landed_pages needs a path")
        return self.options["path"], int(self.options.get("partitionBytes", PARTITION_BYTES))

    def reader(self, schema) -> _Batch:
        return _Batch(*self._settings())

    def streamReader(self, schema) -> _Stream:
        return _Stream(*self._settings())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandedPages)


def page_folder(path: str, feed: str, page: int) -> str:
    """Where a page of a feed is to land."""
    return f"{path.rstrip('/')}/feed={quote(feed, safe='')}/page={page}"
