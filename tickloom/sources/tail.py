"""``spark.readStream.format("tail")``: the lines of text files that are still being written.

Files under ``path`` follow each other by name, numbers in it by value (``hourly/20260703/9`` before ``.../10``).  An offset is a
file and a byte: files before it are done.  A last line without its end waits until the rest has
come, or until a later file shows that none will.  The stream begins with the file that was written to last
(``start`` newest) or with the first one (``start`` oldest).  A missing or empty folder has no lines yet.  Files and
folders whose names begin with a dot are passed over.

``path`` has to be one that the driver and all executors see.  Long stretches are cut at ``splitBytes``
into parts that are read in parallel; a line belongs to the part it begins in.  Invalid UTF-8 is replaced.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file string, byte long, raw string"
_ARROW = pa.schema([("file", pa.string()), ("byte", pa.int64()), ("raw", pa.string())])
READ_BYTES = 4 << 20


def natural(name: str) -> list:
    return [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", name)]


def listed(root: str) -> list[str]:
    """Files under ``root`` in their order."""
    found = []
    for folder, folders, names in os.walk(root):
        folders[:] = [f for f in folders if not f.startswith(".")]
        found += [os.path.join(folder, n) for n in names if not n.startswith(".")]
    return sorted(found, key=natural)


def whole_lines(path: str) -> int:
    """The byte after the last line that has its end."""
    with open(path, "rb") as f:
        end = f.seek(0, os.SEEK_END)
        while end > 0:
            size = min(READ_BYTES, end)
            f.seek(end - size)
            at = f.read(size).rfind(b"\n")
            if at >= 0:
                return end - size + at + 1
            end -= size
    return 0


@dataclass
class Stretch(InputPartition):
    """Lines of ``path`` that begin in [start, stop); ``first`` if one begins at ``start``."""

    path: str
    start: int
    stop: int
    first: bool


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.root = options["path"]
        self.oldest = options.get("start", "newest") == "oldest"
        self.split = int(options.get("splitBytes", 64 << 20))

    def initialOffset(self) -> dict:
        files = listed(self.root)
        if not files or self.oldest:
            return {"file": "", "byte": 0}
        return {"file": max(files, key=lambda f: (os.stat(f).st_mtime, natural(f))), "byte": 0}

    def latestOffset(self) -> dict:
        files = listed(self.root)
        return {"file": files[-1], "byte": whole_lines(files[-1])} if files else {"file": "", "byte": 0}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        out = []
        for f in listed(self.root):
            if not natural(start["file"]) <= natural(f) <= natural(end["file"]):
                continue
            at, stop = start["byte"] if f == start["file"] else 0, end["byte"] if f == end["file"] else os.stat(f).st_size
            cuts = [*range(at, stop, self.split), stop]
            out += [Stretch(f, a, b, a == at) for a, b in zip(cuts, cuts[1:])]
        return out

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as f:
            at = partition.start
            if not partition.first:
                # the line that the part before this one began
                f.seek(at - 1)
                at += len(f.readline()) - 1
            f.seek(at)
            while at < partition.stop:
                lines = f.readlines(min(READ_BYTES, partition.stop - at))
                if not lines:
                    return
                places = []
                for line in lines:
                    places.append(at)
                    at += len(line)
                texts = [x.rstrip(b"\r\n").decode("utf-8", "replace") for x in lines]
                keep = sum(p < partition.stop for p in places)
                yield pa.RecordBatch.from_arrays([pa.array([partition.path] * keep, pa.string()), pa.array(places[:keep], pa.int64()), pa.array(texts[:keep], pa.string())], schema=_ARROW)

    def commit(self, end: dict) -> None:
        pass


class Tail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(Tail)
    return spark
