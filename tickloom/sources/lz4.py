"""Lines of LZ4-frame files, cut into runs of blocks that many tasks read.

A first job walks over the block headers of each file, a seek per block, and cuts it where decoding can
start: at frames, and, in frames whose blocks are independent, at blocks.  A second one decodes the runs.  A
line belongs to the run it begins in; the end of a run's last line is read from the blocks behind it.  A frame of
linked blocks is one run, decoded as a stream.

Files are opened with pyarrow's file systems, by the paths Spark lists.  Empty files have no lines; skippable
frames are skipped; what is no LZ4 frame, or is cut off, is an error.  Invalid UTF-8 is replaced.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator
from functools import partial
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixed values of the frame format
MAGIC, SKIPPABLE, END = 0x184D2204, range(0x184D2A50, 0x184D2A60), 0
RUN_BYTES, READ_BYTES = 16 << 20, 4 << 20


def opened(path: str):
    if path.startswith("file:"):
        return pa.OSFile(unquote(path.removeprefix("file:").replace("///", "/", 1)), "rb")
    system, name = pyarrow.fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def _word(f) -> int:
    raw = f.read(4)
    if len(raw) < 4:
        raise ValueError("an LZ4 file that is cut off")
    return struct.unpack("<I", raw)[0]


def blocks(f, at: int, flags: tuple[int, int] | None, size: int) -> Iterator[tuple[int, int, int, int, bool]]:
    """``start, stop, flg, bd, free`` of the blocks from ``at`` on: of a frame of ``flags``, or of the one that begins there.

    ``free`` blocks can be decoded without those before them.
    """
    first = flags is None
    while True:
        f.seek(at)
        if flags is None:
            if at >= size:
                return
            magic = _word(f)
            if magic in SKIPPABLE:
                at += 8 + _word(f)
                continue
            if magic != MAGIC:
                raise ValueError(f"no LZ4 frame at byte {at}")
            flg, bd = f.read(2)
            flags, first = (flg, bd), True
            at += 7 + 8 * (flg >> 3 & 1) + 4 * (flg & 1)
            f.seek(at)
        flg, bd = flags
        stored = _word(f)
        if stored == END:
            at, flags = at + 4 + 4 * (flg >> 2 & 1), None
            continue
        stop = at + 4 + (stored & 0x7FFFFFFF) + 4 * (flg >> 4 & 1)
        if stop > size:
            raise ValueError("an LZ4 file that is cut off")
        yield at, stop, flg, bd, first or bool(flg >> 5 & 1)
        at, first = stop, False


_RUN = pa.schema([("path", pa.string()), *((c, pa.int64()) for c in ("run", "start", "flg", "bd", "stop", "last_flg", "last_bd"))])
_RUN_DDL = "path string, run long, start long, flg long, bd long, stop long, last_flg long, last_bd long"


def _cut(batches: Iterator[pa.RecordBatch], run_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            runs, ends = [], []
            with opened(path) as f:
                size = f.size()
                for start, stop, flg, bd, free in blocks(f, 0, None, size):
                    if not runs or (free and start - runs[-1][0] >= run_bytes):
                        runs.append((start, flg, bd))
                        ends.append(None)
                    ends[-1] = (stop, flg, bd)
            rows = [(path, k, *r, *e) for k, (r, e) in enumerate(zip(runs, ends))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_RUN)], schema=_RUN)


class _Frames(io.RawIOBase):
    """The blocks of a file from one on, as a stream of frames without content sizes and checksums."""

    def __init__(self, f, size: int, start: int, stop: int, flags: tuple[int, int]) -> None:
        self.f, self.stop = f, stop
        self.blocks, self.frame = blocks(f, start, flags, size), None
        self.held, self.at = b"", 0

    def readable(self) -> bool:
        return True

    def _next(self) -> bytes:
        block = next(self.blocks, None)
        if block is None or block[0] >= self.stop:
            self.blocks, open_, self.frame = iter(()), self.frame, None
            return struct.pack("<I", END) if open_ else b""
        start, stop, flg, bd, free = block
        self.f.seek(start)
        raw = self.f.read(stop - start)
        if self.frame == (flg, bd) and (not free or flg >> 5 & 1):
            return raw
        shape = bytes([flg & ~0b1101, bd])
        head = struct.pack("<I", MAGIC) + shape + bytes([xxhash.xxh32(shape).intdigest() >> 8 & 255])
        end, self.frame = struct.pack("<I", END) if self.frame else b"", (flg, bd)
        return end + head + raw

    def read(self, n: int = -1) -> bytes:
        if self.at == len(self.held):
            self.held, self.at = self._next(), 0
        out = self.held[self.at :] if n < 0 else self.held[self.at : self.at + n]
        self.at += len(out)
        return out


def _decoded(f, size: int, start: int, stop: int, flags: tuple[int, int]) -> Iterator[bytes]:
    with pa.CompressedInputStream(pa.PythonFile(_Frames(f, size, start, stop, flags), mode="r"), "lz4") as stream:
        while block := stream.read(READ_BYTES):
            yield block


def _rest(f, size: int, start: int, flags: tuple[int, int]) -> bytes:
    """The bytes from block ``start`` on up to the end of a line, newline included."""
    out = b""
    for block in _decoded(f, size, start, size, flags):
        at = block.find(b"\n")
        out += block if at < 0 else block[: at + 1]
        if at >= 0:
            break
    return out


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, run, start, flg, bd, stop, last_flg, last_bd in zip(*(c.to_pylist() for c in batch.columns)):
            with opened(path) as f:
                size, n, rest = f.size(), 0, b""
                begun = run > 0  # the first line began before this run
                for block in _decoded(f, size, start, stop, (flg, bd)):
                    *lines, rest = (rest + block).split(b"\n")
                    if begun and lines:
                        lines, begun = lines[1:], False
                    if lines:
                        yield _numbered(path, run, n, lines)
                        n += len(lines)
                if begun:
                    continue  # one line began before this run and ends behind it
                following = next(blocks(f, stop, (last_flg, last_bd), size), None)
                if following:
                    # a run's first line is the rest of this one, even if this one ended with a newline
                    rest += _rest(f, size, following[0], following[2:4])
                    yield _numbered(path, run, n, rest.removesuffix(b"\n").split(b"\n"))
                elif rest:
                    yield _numbered(path, run, n, [rest])


def _numbered(path: str, run: int, n: int, lines: list[bytes]) -> pa.RecordBatch:
    at = (run << 32) + n
    return pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array(range(at, at + len(lines)), pa.int64()), pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())], ["file", "ordinal", "raw"])


def files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of all files that are not empty, in folders of any depth."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where("length > 0").select("path")


def runs(listed: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Where the runs of blocks of all files begin and stop, with the flags of their first and last frame."""
    return listed.select("path").mapInArrow(partial(_cut, run_bytes=run_bytes), _RUN_DDL)


def lines(listed: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """``file, ordinal, raw`` of all lines of ``listed`` files; ordinals rise within a file, from 0 on by one within a run."""
    dealt = runs(listed, run_bytes).repartition(F.col("path"), F.col("run"))
    return dealt.mapInArrow(_lines, "file string, ordinal long, raw string")
