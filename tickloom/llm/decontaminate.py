"""Benchmark decontamination by winnowing.

Both sides are cut into hashes of ``k`` consecutive words; of every ``width - k + 1`` neighbouring
hashes the smallest is kept.  Every shared span of ``width`` words contains a whole window, whose
smallest hash is the same on both sides, so joining the kept hashes finds every such span.  Each
fingerprint carries the word hashes around it, so a joined pair is extended word by word without
going back to the text.  Items shorter than ``width`` words are one window each; they meet the
documents by the hash of their whole word sequence.

A document's fingerprints are looked up in a bit table of the benchmark's (sized by their number, 32 MB
at most) before they leave the task; what passes is joined exactly.  The join is a
broadcast only while the benchmark has at most ``BROADCAST_ROWS`` fingerprints.

Null or empty texts have no words and are clean.  Texts are scanned whole, however long.  Rows equal in doc_id and text give one result
row.  Items with a null id or without words are ignored; equal items all count.  An empty benchmark hits
nothing.  A null doc_id is an id like any other.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import ALNUM, LOWER, U64, buffers, chunks, grams, hash_spans, in_table, row_of, spans
from ._shared import bit_table, settle

#: rows of about 250 bytes
BROADCAST_ROWS = 100_000


def winnow(g: np.ndarray, valid: np.ndarray, window: int) -> np.ndarray:
    """Which of ``g`` are smallest in a run of ``window`` neighbours that are all ``valid``."""
    n = len(g) - window + 1
    if n <= 0:
        return np.zeros(len(g), bool)
    low = np.lib.stride_tricks.sliding_window_view(g, window).min(1)
    bad = np.concatenate(([0], np.cumsum(~valid)))
    low[bad[window:] > bad[:-window]] = 0
    high = np.zeros(len(g) + window - 1, np.uint64)
    high[window - 1 : window - 1 + n] = low
    return valid & (np.lib.stride_tricks.sliding_window_view(high, window).max(1) == g)


def _fingerprints(data: np.ndarray, offsets: np.ndarray, width: int, k: int, short: list[int], table: np.ndarray | None):
    """Word counts of the rows; and row, position, kind, hash and surroundings of the fingerprints.

    Kind 0 is a winnowed hash, kind m the hash of m words.  Without ``table`` this is the benchmark
    side, where kind m comes only from texts of m words.
    """
    low = LOWER[data]
    starts, ends, counts = spans(low, offsets, ALNUM)
    words, rows = hash_spans(low, starts, ends), row_of(counts)
    found = []
    for kind in (0, *short):
        m = kind or k
        g = grams(words, m)
        if not len(g):
            continue
        valid = rows[: len(g)] == rows[m - 1 :]
        take = winnow(g, valid, width - k + 1) if not kind else valid
        if table is None:
            take &= (counts[rows[: len(g)]] == m) if kind else (counts[rows[: len(g)]] >= width)
        else:
            take &= in_table(table, g)
        at = np.flatnonzero(take)
        found.append((rows[at], at, np.full(len(at), kind), g[at]))
    row, at, kind, g = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    order = np.lexsort((at, row))
    row, at, kind, g = row[order], at[order], kind[order], g[order]
    near = at[:, None] + np.arange(k - width, width)
    inside = (near >= 0) & (near < len(words))
    near = np.clip(near, 0, max(0, len(words) - 1))
    around = np.where(inside & (rows[near] == row[:, None]), words[near], U64(table is None)) if len(at) else np.empty((0, 2 * width - k), np.uint64)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    return counts, row, at - first[row], kind, g, around


_CAND = pa.struct([("pos", pa.int32()), ("kind", pa.int32()), ("fp", pa.int64()), ("around", pa.binary())])
_CAND_DDL = "array<struct<pos int, kind int, fp long, around binary>>"


def _scan(batches: Iterator[pa.RecordBatch], width: int, k: int, short: list[int], table) -> Iterator[pa.RecordBatch]:
    table = table and table.value
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for a, b in chunks(offsets):
            counts, row, pos, kind, g, around = _fingerprints(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width, k, short, table)
            size = around.shape[1] * 8
            blob = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer((np.arange(len(row) + 1) * size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(around))])
            flat = pa.StructArray.from_arrays([pa.array(pos, pa.int32()), pa.array(kind, pa.int32()), pa.array(g.view(np.int64)), blob], fields=list(_CAND))
            each = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(counts))))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(each), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(counts.astype(np.int64)), lists], ["id", "key", "n_words", "cands"])


def _extend(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    """Longest runs of equal words around each joined fingerprint, where they reach ``width``."""
    for batch in batches:
        kind, pos = batch.column("kind").to_numpy(), batch.column("pos").to_numpy().astype(np.int64)
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, 2 * width - k) for c in ("around", "item_around"))
        same = x == y
        left = np.logical_and.accumulate(same[:, : width - k][:, ::-1], 1).sum(1)
        right = np.logical_and.accumulate(same[:, width - k :], 1).sum(1)
        start, end = np.where(kind > 0, pos, pos - left), np.where(kind > 0, pos + kind, pos + right)
        keep = pa.array((kind > 0) | (left + right >= width))
        out = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), batch.column("item_id"), pa.array(start), pa.array(end)], ["id", "key", "item_id", "start", "end"])
        yield out.filter(keep)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 13, k: int = 5, share: int = 20) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, body``.

    A word is hit if a window of ``width`` item words (or a whole shorter item) occurs over it; a
    document is contaminated if ``n_hit > 0 and share * n_hit >= n_words``.  ``body`` is ``xxhash64`` of the text.
    """
    spark = docs.sparkSession
    of = items.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text"), F.lit(0).cast("long").alias("key")).where(F.col(item_col).isNotNull())
    kinds = f"key long, n_words long, cands {_CAND_DDL}"
    scanned = settle(of.mapInArrow(partial(_scan, width=width, k=k, short=list(range(1, width)), table=None), f"id {dict(of.dtypes)['id']}, {kinds}"))
    marks = scanned.select("id", F.explode("cands").alias("c")).select(F.col("id").alias("item_id"), "c.kind", "c.fp", F.col("c.around").alias("item_around"))
    short = sorted(r[0] for r in marks.where("kind > 0").select("kind").distinct().collect())
    n = marks.count()
    table = spark.sparkContext.broadcast(bit_table(marks, "fp", n))
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    base = settle(own.mapInArrow(partial(_scan, width=width, k=k, short=short, table=table), f"id {dict(own.dtypes)['id']}, {kinds}"))
    cands = base.select("id", "key", F.explode("cands").alias("c")).select("id", "key", "c.*")
    small = n <= BROADCAST_ROWS
    met = cands.join(F.broadcast(marks) if small else marks, ["kind", "fp"])
    hits = met.select("id", "key", "item_id", "kind", "pos", "around", "item_around").mapInArrow(partial(_extend, width=width, k=k), f"id {dict(own.dtypes)['id']}, key long, item_id {dict(of.dtypes)['id']}, start long, end long").distinct()
    per = hits.groupBy("id", "key").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(F.greatest(a["end"], s["end"]).alias("end"), (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["end"], s["start"]))).alias("n")),
        lambda a: a["n"],
    )
    per = per.select("id", "key", covered.alias("n_hit"), "items")
    everyone = base.select("id", "key", "n_words").distinct()
    n_hit, names = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    joined = everyone.join(per, everyone.id.eqNullSafe(per.id) & (everyone.key == per.key), "left").select(everyone.id, everyone.key, "n_words", n_hit.alias("n_hit"), names.alias("items"))
    return joined.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "items", F.col("key").alias("body"),
    )
