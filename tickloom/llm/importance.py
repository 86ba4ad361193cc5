"""Importance resampling towards a target corpus, over hashed word features.

A text's features are all runs of 1 to ``most`` consecutive words, repeats counted; a feature's bucket
is the CRC-32 of its UTF-8 bytes modulo ``buckets``.  Each distinct feature of a block of texts is
hashed once: features of equal length become the columns of one two-dimensional byte array, all CRCs
of the array advance together, a byte of every feature at a time, and the results are scattered back to
the occurrences.  Spark adds the blocks' histograms; the log ratio of the two corpora is a bucket's
gain, a document's weight its mean gain.  Gumbel noise from a hash of the id makes the highest scores a draw
without replacement in proportion to ``exp(weight / 1000)``.

Only the ``buckets`` gains come to the driver and go to the tasks.  Ranks come from range partitions
of the scores, numbered inside and shifted by the partitions' sizes; rows of equal score spread by id.

Null and empty texts have no words, no features and weight 0.  Texts count whole, however long.
Repeated rows are documents of their own.  A null doc_id is hashed as the empty string and is the last of
equal scores; of equal scores and ids the one with fewer features, then the smaller weight, comes first.
An empty target or table of documents has no features; the empty table gives an empty one.  Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._bytes import ALNUM, LOWER, buffers, chunks, hash_spans, ragged, row_of, spans
from ._shared import settle, shuffle_partitions

#: rows of about 40 bytes that one range partition has about
RANGE_ROWS = 1 << 20


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def crc32_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte spans of ``data``, a matrix for each length, a column of bytes at a time."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    size, first = np.unique(lengths[order], return_index=True)
    for n, a, b in zip(size.tolist(), first, np.append(first[1:], len(order))):
        own = order[a:b]
        matrix = data[np.arange(n)[:, None] + starts[own]]
        crc = np.full(b - a, 0xFFFFFFFF, np.uint32)
        for byte in matrix:
            crc = _CRC[(crc ^ byte) & np.uint32(255)] ^ crc >> np.uint32(8)
        out[own] = ~crc
    return out


def feature_buckets(data: np.ndarray, offsets: np.ndarray, most: int, buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Word counts of the rows; and, for runs of 1 to ``most`` words, row and bucket of each occurrence in order."""
    low = LOWER[data]
    starts, ends, counts = spans(low, offsets, ALNUM)
    rows, found = row_of(counts), []
    # a distinct run is known by the distinct run before its last word, and that word
    _, at, word = np.unique(hash_spans(low, starts, ends), return_index=True, return_inverse=True)
    text, begin, size = low, starts[at], (ends - starts)[at]
    word_begin, word_size, run = begin, size, word
    for k in range(1, most + 1):
        if k > 1:
            same = rows[: len(rows) - k + 1] == rows[k - 1 :]
            ids, run_all = np.unique(run[: len(same)] * np.int64(len(word_size)) + word[k - 1 :], return_inverse=True)
            left, right = np.divmod(ids, len(word_size)) if len(ids) else (ids, ids)
            new = size[left] + 1 + word_size[right]
            at = np.cumsum(new) - new
            flat = np.full(int(new.sum()), 32, np.uint8)
            flat[ragged(at, size[left])] = text[ragged(begin[left], size[left])]
            flat[ragged(at + size[left] + 1, word_size[right])] = low[ragged(word_begin[right], word_size[right])]
            text, begin, size, run = flat, at, new, run_all
            keep = np.flatnonzero(same)
        else:
            keep = np.arange(len(rows))
        found.append((rows[keep], (crc32_spans(text, begin, size) % np.uint32(buckets)).astype(np.int64)[run[keep]]))
    return counts, found


def _histogram(batches: Iterator[pa.RecordBatch], most: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        data, offsets = buffers(batch.column(0))
        for a, b in chunks(offsets):
            for _, bucket in feature_buckets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], most, buckets)[1]:
                total += np.bincount(bucket, minlength=buckets)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])


def histogram(docs: DataFrame, text_col: str = "text", most: int = 2, buckets: int = 10_000) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket that has some."""
    told = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(partial(_histogram, most=most, buckets=buckets), "bucket long, n long")
    return told.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_text_col: str = "text", most: int = 2, buckets: int = 10_000) -> np.ndarray:
    """The gain of each bucket: thousandths of the log ratio of its share in ``target`` and in ``docs``, each count plus one."""
    both = histogram(docs, text_col, most, buckets).withColumn("of", F.lit("s")).unionByName(histogram(target, target_text_col, most, buckets).withColumn("of", F.lit("t")))
    per = both.groupBy("bucket").pivot("of", ["s", "t"]).agg(F.sum("n")).na.fill(0)
    got = per.toPandas()  # as many rows as buckets, at most
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    s[got["bucket"].to_numpy(np.int64)] = got["s"].to_numpy(np.int64)
    t[got["bucket"].to_numpy(np.int64)] = got["t"].to_numpy(np.int64)
    one = lambda n: (n + 1).astype(np.float64)
    share = one(t) * float(int(s.sum()) + buckets) / (one(s) * float(int(t.sum()) + buckets))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], most: int, gain) -> Iterator[pa.RecordBatch]:
    gain = gain.value
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for a, b in chunks(offsets):
            counts, found = feature_buckets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], most, len(gain))
            n, total = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
            for rows, bucket in found:
                ends = np.searchsorted(rows, np.arange(b - a + 1))
                n += np.diff(ends)
                total += np.diff(np.concatenate(([0], np.cumsum(gain[bucket])))[ends])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts.astype(np.int64)), pa.array(n), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", most: int = 2, seed: int = 7) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    done = own.mapInArrow(partial(_weigh, most=most, gain=docs.sparkSession.sparkContext.broadcast(gain)), f"doc_id {own.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return done.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long"))


def draw(scored: DataFrame, percent: int = 25, least_words: int = 20) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... by falling score over ``percent`` of the rows with ``least_words``; others null."""
    scored = settle(scored)
    enough = scored.where(F.col("n_words") >= least_words)
    n = enough.count()
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    parts = max(shuffle_partitions(scored.sparkSession), n // RANGE_ROWS)
    dealt = settle(enough.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row for each range partition
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = dealt.withColumn("_part", part).join(F.broadcast(before), "_part").select(*scored.columns, F.when(rank <= n * percent // 100, rank).alias("rank"))
    return ranked.unionByName(scored.where(F.coalesce(F.col("n_words") < least_words, F.lit(True))).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", most: int = 2, buckets: int = 10_000, percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``, drawn towards ``target``."""
    gain = gains(docs, target, text_col, target_text_col, most, buckets)
    return draw(weights(docs, gain, id_col, text_col, most, seed), percent, least_words)


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws; rows that share an id come and go together."""
    ids = resample(docs, target, id_col, **options).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, F.col(f"`{id_col}`").eqNullSafe(F.col("_drawn")), "left_semi")
