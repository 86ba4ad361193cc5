"""Line dedup over the whole corpus by range partitions and a streamed first occurrence.

Each document gives one row per distinct line key: a 128-bit hash and the line numbers.  The rows
are range-partitioned by (key, doc_id) and sorted by key, then doc_id downwards, then row: a key of a
third of all rows spreads over many partitions.  Each task streams its rows; the first document of a
key keeps its lines, the others lose them once a third document has been seen.  Only a partition's
first and last key can reach into a neighbour; their rows are settled by a second, pre-aggregated
count over at most two keys per partition.  Dropped line numbers come back as one compressed keep
bitmap per document, and no text is shuffled until the bitmaps are applied.

A key is a line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased; keys of fewer
than ``min_chars`` code points are never dropped.  A null or empty text is one empty line and comes
back empty.  Rows with a null doc_id keep their lines and count nowhere.  Rows with the same doc_id
are one holder; equal rows get equal results.  Very long texts and lines count whole.  An empty table
gives an empty one.  All other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._bytes import LOWER, NOT_SPACE, binaries, buffers, chunks, hash_spans, row_of, spans, unvarints, varints
from ._shared import release, settle, shuffle_partitions

#: rows of about 40 bytes that one range partition has about
RANGE_ROWS = 1 << 20
#: rows of about 40 bytes
BROADCAST_KEYS = 200_000

_KEYS = pa.schema([("doc_id", pa.int64()), ("body", pa.int64()), ("n_lines", pa.int64()), ("key", pa.binary()), ("lines", pa.binary())])


def line_keys(data: np.ndarray, offsets: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys by row: row, 128-bit hash (as two numbers), how many lines have it, and their numbers."""
    low = LOWER[data]
    starts, ends, counts = spans(low, offsets, NOT_SPACE)
    rows, breaks = row_of(counts), np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, starts)
    place = before + rows  # another number for each line of each row
    first = np.flatnonzero(np.diff(place, prepend=-1))
    begin, end, row = starts[first], ends[np.append(first[1:], len(ends)) - 1 if len(first) else first], rows[first]
    line = before[first] - np.searchsorted(breaks, offsets[:-1])[row]
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    long = points[end] - points[begin] >= min_chars
    begin, end, row, line = begin[long], end[long], row[long], line[long]
    a, b = hash_spans(low, begin, end), hash_spans(low, begin, end, 1)
    order = np.lexsort((line, b, a, row))
    row, a, b, line = row[order], a[order], b[order], line[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(fresh)
    return row[at], np.stack((a[at], b[at]), 1), np.diff(at, append=len(row)), line, np.diff(np.searchsorted(breaks, offsets)) + 1


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, body = batch.column("doc_id").to_numpy(), batch.column("body").to_numpy()
            data, offsets = buffers(batch.column("text"))
            for p, q in chunks(offsets):
                row, key, times, line, n_lines = line_keys(data[offsets[p] : offsets[q]], offsets[p : q + 1] - offsets[p], min_chars)
                lines = binaries(*varints(line, times))
                keys = binaries(np.ascontiguousarray(key).view(np.uint8).ravel(), np.full(len(row), 16))
                yield pa.RecordBatch.from_arrays([pa.array(doc[p + row]), pa.array(body[p + row]), pa.array(n_lines[row].astype(np.int64)), keys, lines], schema=_KEYS)

    return run


def _decide(least: int):
    """Streamed decision: rows with a null key are dropped lines, rows with a key are undecided."""

    def runs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Of each row: its run of equal keys, and how many documents came before it in the run."""
        raw = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint64).reshape(-1, 2)
        doc = table.column("doc_id").to_numpy()
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (raw[1:] != raw[:-1]).any(1)
        other = fresh.copy()
        other[1:] |= doc[1:] != doc[:-1]
        run, seen = np.cumsum(fresh) - 1, np.cumsum(other)
        return run, seen - seen[np.flatnonzero(fresh)][run]

    def out(table: pa.Table, take: np.ndarray, decided: bool) -> list[pa.RecordBatch]:
        table = table.filter(pa.array(take))
        if decided:
            table = table.set_column(table.schema.get_field_index("key"), "key", pa.nulls(len(table), pa.binary()))
        return table.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, head = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if head is None:
                head = batch.column("key")[0].as_py()
            edge = pc.equal(table.column("key"), pa.scalar(head, table.schema.field("key").type)).to_numpy()
            yield from out(table, edge, False)
            table = table.filter(pa.array(~edge))
            if held is not None:
                table = pa.concat_tables([held, table])
            if not len(table):
                continue
            run_of, before = runs(table)
            docs = np.zeros(run_of[-1] + 1, np.int64)
            np.maximum.at(docs, run_of, before + 1)
            last = run_of == run_of[-1]
            yield from out(table, (before > 0) & np.where(last, before >= least, docs[run_of] >= least), True)
            held = table.filter(pa.array(last & (before < least))).combine_chunks()
        if held is not None:
            yield from held.to_batches()

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps, dropped = [], []
        for n, lists in zip(batch.column("n_lines").to_pylist(), batch.column("lines").to_pylist()):
            keep = np.ones(n, bool)
            keep[unvarints(lists)[0].astype(np.int64)] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
            dropped.append(int(n - keep.sum()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("body"), batch.column("n_lines"), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())], ["doc_id", "body", "n_lines", "n_dropped", "keep"])


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, body, n_lines, n_dropped, keep`` of the documents that lose lines.

    ``body`` is ``xxhash64`` of the text, ``keep`` a zlib-compressed bit per line, first line first.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("body"), F.col(text_col).alias("text")).where("doc_id is not null")
    keys = settle(own.mapInArrow(_keys(min_chars), "doc_id long, body long, n_lines long, key binary, lines binary"))
    parts = max(shuffle_partitions(docs.sparkSession), keys.count() // RANGE_ROWS)
    dealt = keys.repartitionByRange(parts, "key", F.desc("doc_id")).sortWithinPartitions("key", F.desc("doc_id"), "body")
    told = settle(dealt.mapInArrow(_decide(min_docs), keys.schema))
    release(keys)
    open_ = told.where("key is not null")
    # at most two keys per partition
    totals = settle(open_.groupBy("key").agg(F.countDistinct("doc_id").alias("docs"), F.max("doc_id").alias("keeper")).where(F.col("docs") >= min_docs))
    small = totals.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    late = open_.join(F.broadcast(totals) if small else totals, "key").where("doc_id <> keeper").select("doc_id", "body", "n_lines", "lines")
    drops = told.where("key is null").select("doc_id", "body", "n_lines", "lines").unionByName(late).distinct()
    per = drops.groupBy("doc_id", "body", "n_lines").agg(F.collect_list("lines").alias("lines"))
    return per.mapInArrow(_bitmaps, "doc_id long, body long, n_lines long, n_dropped long, keep binary")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for text, keep in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()):
            lines = (text or "").split("\n")
            counts.append(len(lines))
            if keep is not None:
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
                lines = [x for x, k in zip(lines, bits) if k]
            texts.append("\n".join(lines))
        at = {c: batch.column(c) for c in batch.schema.names} | {"text": pa.array(texts, pa.string()), "n_lines": pa.array(counts, pa.int64())}
        yield pa.RecordBatch.from_arrays([at[c] for c in ("row", "text", "n_lines", "n_dropped")], ["row", "text", "n_lines", "n_dropped"])


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the kept lines as text, and a column ``line_counts`` struct<n_lines, n_dropped>."""
    maps = line_bitmaps(docs, id_col, text_col, min_chars, min_docs).select("doc_id", "body", "n_dropped", "keep")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    left = docs.select(F.struct(*rest).alias("row"), F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("body"))
    met = left.join(maps.hint("shuffle_hash"), ["doc_id", "body"], "left").select("row", "text", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep")
    schema = T.StructType([met.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    done = met.mapInArrow(_apply, schema)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns], F.struct("n_lines", "n_dropped").alias("line_counts"))
