"""Listings of object keys as a data source: folders are listed by the tasks, names never gather in one place.

    spark.dataSource.register(KeyListing)
    spark.read.format("keys").option("prefix", "2024/").load("s3://corpus/in")

Folders are dealt to tasks, each of which streams the files under its own. A
``prefix`` and a ``start_after`` also tell which folders need not be entered.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import unquote, urlsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "key string, length bigint, modified timestamp"
LOCAL = ("", "file")
#: Stores that a listing task opens by itself, with the name their library knows them by.
STORES = {"s3": "s3", "s3a": "s3", "gs": "gs", "hdfs": "hdfs"}


def can_list(folder: str) -> bool:
    return urlsplit(folder).scheme in (*LOCAL, *STORES)


def _hidden(name: str) -> bool:
    """Names that Spark's own sources pass over too."""
    return name.startswith((".", "_"))


def entries(folder: str) -> Iterator[tuple[str, bool, int, datetime | None]]:
    """``(name, is a folder, length, modified)`` of what lies right in a folder; a missing folder has nothing."""
    scheme = urlsplit(folder).scheme
    if scheme in LOCAL:
        path = unquote(urlsplit(folder).path) if scheme else folder
        try:
            found = os.scandir(path)
        except (FileNotFoundError, NotADirectoryError):
            return
        with found:
            for one in found:
                if not _hidden(one.name):
                    stat = one.stat()
                    yield one.name, one.is_dir(), stat.st_size, datetime.fromtimestamp(stat.st_mtime, timezone.utc)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(STORES[scheme] + folder[len(scheme) :])
    for one in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if not _hidden(one.base_name):
            yield one.base_name, one.type == fs.FileType.Directory, one.size or 0, one.mtime


class Folder(InputPartition):
    """Files under ``below`` (a key that is empty or ends in a slash), with those of its folders if ``deep``."""

    def __init__(self, below: str, deep: bool):
        self.below, self.deep = below, deep


class KeyReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"].rstrip("/")
        self.prefix, self.after = options.get("prefix", ""), options.get("start_after", "")
        self.deep = options.get("recursive", "true").lower() == "true"
        self.tasks = int(options.get("tasks", "64"))

    def wanted(self, below: str) -> bool:
        """Whether keys that begin with ``below`` may be in the listing."""
        return (below.startswith(self.prefix) or self.prefix.startswith(below)) and (
            below > self.after[: len(below)] or self.after.startswith(below)
        )

    def folders(self, below: str) -> list[str]:
        inner = (f"{below}{name}/" for name, folder, _, _ in entries(f"{self.root}/{below}") if folder)
        return sorted(x for x in inner if self.wanted(x))

    def partitions(self) -> list[Folder]:
        """Folders are opened, the uppermost first, until there are enough of them for all tasks."""
        start = self.prefix[: self.prefix.rfind("/") + 1]
        if not self.deep:
            return [Folder(start, False)]
        done, todo = [], [start]
        while todo and len(done) + len(todo) < self.tasks:
            below = todo.pop(0)
            done.append(Folder(below, False))
            todo += self.folders(below)
        return done + [Folder(below, True) for below in todo]

    def read(self, partition: Folder) -> Iterator[tuple]:
        todo = [partition.below]
        while todo:
            below = todo.pop()
            for name, folder, length, modified in entries(f"{self.root}/{below}"):
                key = below + name
                if folder:
                    if partition.deep and self.wanted(f"{key}/"):
                        todo.append(f"{key}/")
                elif key.startswith(self.prefix) and key > self.after:
                    yield key, length, modified


class KeyListing(DataSource):
    """``(key, length, modified)`` of the files under a folder, by keys relative to it."""

    @classmethod
    def name(cls) -> str:
        return "keys"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> KeyReader:
        return KeyReader(self.options)
