"""The files below a folder as a table, listed by tasks, folder by folder; empty files are listed too."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Folders are opened level by level until there are as many to deal out.
FOLDERS = 64


@dataclass
class Folder(InputPartition):
    path: str
    below: bool


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.glob = options["path"], options.get("glob", "*")

    def partitions(self) -> list[Folder]:
        store, root = fs.FileSystem.from_uri(self.path)
        level, done = [root], []
        while level and len(level) < FOLDERS:
            done += [Folder(p, False) for p in level]
            level = [f.path for p in level for f in store.get_file_info(fs.FileSelector(p)) if not f.is_file]
        return done + [Folder(p, True) for p in level]

    def read(self, folder: Folder) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        scheme = self.path.split("://")[0] + "://" if "://" in self.path and not self.path.startswith("file:") else ""
        found = [f for f in store.get_file_info(fs.FileSelector(folder.path, recursive=folder.below)) if f.is_file and fnmatch(f.base_name, self.glob)]
        yield pa.RecordBatch.from_arrays([pa.array([scheme + f.path for f in found], pa.string()), pa.array([f.size for f in found], pa.int64())], names=["path", "length"])


class Listing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return "path string, length long"

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)
