"""Token ids as compact binary blocks.

Documents are range-partitioned and sorted by doc_id before they are tokenized, so the ids come out
in file order and only text is shuffled, once.  A block holds whole documents and about
``BLOCK_TOKENS`` ids.  Ids are ranked by their frequency in the block; ranks are written in one to
four bytes each, lengths apart from data: a control byte has the lengths of four ranks.  A block
carries its own rank table, so it decodes by itself, with numpy table lookups.  Blocks are rows of a
Parquet table, committed by Spark: a lost executor leaves no half-written block.

A block: ``TLB1``, then little-endian u32 documents, ids and table size; i64 doc_ids, u8 null marks,
u32 lengths; the u32 table; control bytes; data bytes.

Null and empty texts have the end id only.  A very long text is one document of one block, which may
then be longer.  Repeated doc_ids are a document each, in the order of their texts' hashes; null
doc_ids come first; ids of equal frequency rank by their number.  An empty table gives an empty one.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._bytes import buffers, chunks, hash_spans, ragged
from ._shared import passing, shared_path, shuffle_partitions

BLOCK_TOKENS = 1 << 20
#: text of one range partition, about
RANGE_BYTES = 64 << 20
CACHE_UNITS = 1 << 21
#: rows of 24 bytes
BROADCAST_BLOCKS = 1 << 20
MAGIC = b"TLB1"

_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.int64)


def pack_ids(ids: np.ndarray) -> bytes:
    """Table size, table, control and data bytes of an array of ids."""
    values, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((values, -counts))
    rank = np.empty(len(values), np.uint32)
    rank[order] = np.arange(len(values))
    code = rank[inverse]
    size = 1 + (code >= 1 << 8).astype(np.int64) + (code >= 1 << 16) + (code >= 1 << 24)
    quads = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    quads[: len(ids)] = size - 1
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    at = np.cumsum(size) - size
    data = np.empty(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        live = size > k
        data[at[live] + k] = code[live] >> 8 * k & 255
    return b"".join((np.uint32(len(values)).tobytes(), values[order].astype("<u4").tobytes(), control.astype(np.uint8).tobytes(), data.tobytes()))


def unpack_ids(raw: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of ``pack_ids``."""
    m = int(raw[:4].view("<u4")[0])
    table = np.frombuffer(raw[4 : 4 + 4 * m].tobytes(), "<u4")
    quads = -(-n // 4)
    control, data = raw[4 + 4 * m : 4 + 4 * m + quads], raw[4 + 4 * m + quads :]
    size = _LENGTHS[control].ravel()[:n]
    at = np.cumsum(size) - size
    code = data[at].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        live = size > k
        code[live] |= data[at[live] + k].astype(np.uint32) << np.uint32(8 * k)
    return table[code]


def write_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    head = np.array([len(doc_ids), len(ids)], "<u4").tobytes()
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join((MAGIC, head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(), lengths.astype("<u4").tobytes(), pack_ids(ids)))


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    if block[:4] != MAGIC:
        raise ValueError("not a token block")
    docs, n = np.frombuffer(block, "<u4", 2, 4).tolist()
    at = 12
    ids = np.frombuffer(block, "<i8", docs, at)
    null = np.frombuffer(block, np.uint8, docs, at + 8 * docs)
    lengths = np.frombuffer(block, "<u4", docs, at + 9 * docs).astype(np.int64)
    tokens = unpack_ids(np.frombuffer(block, np.uint8, offset=at + 13 * docs), n)
    return [None if z else d for d, z in zip(ids.tolist(), null.tolist())], lengths, tokens


_OTHER, _LETTER, _DIGIT, _SIGN, _QUOTE = range(5)
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[0x27] = _QUOTE
_SPLIT = np.zeros((5, 5), bool)
_SPLIT[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = _SPLIT[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = _SPLIT[_SIGN, [_LETTER, _DIGIT]] = True


class Units:
    """The library's ids of a text, put together from units between which it never merges.

    Byte-level pre-tokens end between letters, digits and signs, before a space or line break that
    follows anything visible, and after a single line break.  Only such places that ASCII shows beyond
    doubt are used.  A text with the string of a special token is one unit.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.size, self.ids = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def starts(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        kind = _CLASS[x]
        cut = np.zeros(len(x) + 1, bool)
        if len(x) > 1:
            before, here = kind[:-1], kind[1:]
            nxt, prior = np.append(here[1:], 0), np.append(0, before[:-1])
            space, newline = x[1:] == 0x20, x[1:] == 10
            cut[1:-1] = _SPLIT[before, here] | ((space | newline) & (before > 0)) | (space & (x[:-1] >= 0x80) & ((nxt == _LETTER) | (nxt == _DIGIT))) | ((x[:-1] == 10) & (here > 0) & (prior > 0))
        raw = x.tobytes()
        for s in self.special:
            if s in raw:
                for a, b in zip(own[:-1].tolist(), own[1:].tolist()):
                    if s in raw[a:b]:
                        cut[a:b] = False
        cut[own[:-1][own[:-1] < own[1:]]] = True
        return np.flatnonzero(cut[:-1])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, spans, per = [], [], []
        for a, b in chunks(offsets):
            own = offsets[a : b + 1] - offsets[a]
            x = data[offsets[a] : offsets[b]]
            starts = self.starts(x, own)
            ends = np.append(starts[1:], len(x)) if len(starts) else starts
            per.append(np.diff(np.searchsorted(starts, own)))
            hashes.append(hash_spans(x, starts, ends))
            spans.append(np.stack((starts, ends), 1) + offsets[a])
        h, span, per = np.concatenate(hashes), np.concatenate(spans), np.concatenate(per)
        unique, index, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > CACHE_UNITS:
            self.clear()
        place = np.minimum(np.searchsorted(self.keys, unique), max(0, len(self.keys) - 1))
        new = self.keys[place] != unique if len(self.keys) else np.ones(len(unique), bool)
        if new.any():
            raw = data.tobytes()
            texts = [raw[s:e].decode() for s, e in span[index[new]].tolist()]
            got = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            size = np.array([len(g) for g in got], np.int64)
            keys = np.concatenate((self.keys, unique[new]))
            order = np.argsort(keys, kind="stable")
            self.at = np.concatenate((self.at, len(self.ids) + np.cumsum(size) - size))[order]
            self.size = np.concatenate((self.size, size))[order]
            self.ids = np.concatenate((self.ids, np.array([i for g in got for i in g], np.uint32)))
            self.keys = keys[order]
            place = np.searchsorted(self.keys, unique)
        at, size = self.at[place][inverse], self.size[place][inverse]
        ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(per)))]
        return self.ids[ragged(at, size)], np.diff(ends)


@lru_cache(maxsize=2)
def units(path: str) -> Units:
    return Units(path)


_BLOCK = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("block", pa.binary())])


def _write(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seq = units(path), TaskContext.get().partitionId(), 0
        docs: list = []
        sizes: list = []
        held: list = []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, total
            ids = np.concatenate(held)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([write_block(docs, np.concatenate(sizes), ids)], pa.binary())], schema=_BLOCK)
            for x in (docs, sizes, held):
                x.clear()
            seq, total = seq + 1, 0
            return row

        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for a, b in chunks(offsets, BLOCK_TOKENS * 2):
                ids, counts = coder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                out = np.full(len(ids) + len(counts), end_id, np.uint32)
                stay = np.ones(len(out), bool)
                stay[np.cumsum(counts + 1) - 1] = False
                out[stay] = ids
                docs += batch.column("doc_id").slice(a, b - a).to_pylist()
                sizes.append(counts + 1)
                held.append(out)
                total += len(out)
                if total >= BLOCK_TOKENS:
                    yield flush()
        if held:
            yield flush()

    return run


def write_token_blocks(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> None:
    """Write the blocks of all texts in ascending doc_id order to the table at ``path``."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(shuffle_partitions(docs.sparkSession), size // RANGE_BYTES)
    dealt = own.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    blocks = dealt.select("doc_id", "text").mapInArrow(_write(tokenizer, end_id), "part int, seq int, n_tokens long, block binary")
    blocks.write.option("compression", "none").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, block in zip(batch.column("start").to_pylist(), batch.column("block")):
            docs, lengths, ids = read_block(block.as_py())
            ends = np.cumsum(lengths)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document of a block table."""
    blocks = spark.read.parquet(path)
    sizes = blocks.select("part", "seq", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part").select("part", "seq", (F.col("base") + F.col("inner")).alias("start"))
    small = sizes.count() <= BROADCAST_BLOCKS
    met = blocks.join(F.broadcast(starts) if small else starts, ["part", "seq"])
    return met.select("start", "block").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digest(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the blocks to the shared folder and read them back; they go with the application."""
    path = shared_path(docs.sparkSession)
    write_token_blocks(docs, tokenizer, path, **options)
    passing(docs.sparkSession, path)
    return read_token_blocks(docs.sparkSession, path)
