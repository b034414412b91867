"""A Python data source over a list of chunk files, one partition a file, whose day filter keeps other files unread."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition


class Chunk(InputPartition):
    def __init__(self, path: str, day: str):
        self.path, self.day = path, day


class ChunkReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder, self.day = folder, None

    def pushFilters(self, filters: list[Filter]):
        """A day named in the query decides which files are opened; what else is asked is left to Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("day",):
                self.day = f.value
            else:
                yield f

    def partitions(self) -> list[Chunk]:
        found = []
        for name in sorted(os.listdir(self.folder)):
            stem, ext = os.path.splitext(name)
            parts = stem.rsplit("_", 2)
            if ext == ".csv" and len(parts) == 3 and self.day in (None, parts[1]):
                found.append(Chunk(os.path.join(self.folder, name), parts[1]))
        return found or [Chunk("", "")]

    def read(self, partition: Chunk) -> Iterator[tuple]:
        if partition.path:
            with open(partition.path, encoding="utf-8") as f:
                for n, line in enumerate(f):
                    if n and line.strip():
                        yield (partition.day, n, line.rstrip("\n"))


class ChunkFolder(DataSource):
    """``spark.dataSource.register(ChunkFolder)``, then ``spark.read.format("chunks").load(folder)``: day, line number, line.

    The folder is one that every executor mounts at the same path; object stores are read with ``ingest.read_detections``.
    """

    @classmethod
    def name(cls) -> str:
        return "chunks"

    def schema(self) -> str:
        return "day string, line int, value string"

    def reader(self, schema) -> ChunkReader:
        return ChunkReader(self.options["path"])
