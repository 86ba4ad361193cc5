"""Quality rules with an n-gram language model.

The model is a modified Kneser-Ney model of order ``ORDER`` over code points, case and all.  Tasks count
their texts' n-grams, Spark sums the counts of all documents and derives everything else by groupings
and joins: continuation counts of the lower orders, counts of counts and discounts, weights of the
contexts, interpolated probabilities.  What is counted grows with the corpus; nothing is cut off.
The corpus has two halves by the hash of the text, each with a model of its own, and a document is
scored by that of the other half: no document, and no exact copy of it, makes itself likely.

The model is a table of shards, each a range of n-gram hashes as sorted arrays: hash, log-probability,
and the log-weight that the n-gram gives to the next lower order as a context.  A scorer searches them:
the longest n-gram known decides, and each longer context that is known adds its weight.  Up to
``BROADCAST_ENTRIES`` entries are broadcast.  A larger model stays where it is: blocks of documents send
the distinct hashes they need to the shards, and are scored with what comes back.

The verdict compares a document's mean negative log-probability per code point (log-perplexity) with
its language's band: the median plus and minus ``WIDTH`` robust standard deviations (from the median
absolute deviation, at least ``LEAST``) over all documents of that language that pass the base rules.

Null and empty texts have no words, no perplexity and fail the base rules.  Very long texts are scored
whole.  A null language is a language of its own, apart from the empty one.  Rows are independent:
repeated doc_ids give a row each.  An empty table gives none.  Only the three named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._bytes import NOT_SPACE, U64, buffers, chunks, grams, hash_spans, mix, row_of, run_hashes, run_prefix, spans
from ._shared import grouped, release, settle, shuffle_partitions

ORDER = 5
#: width of a language's band in robust standard deviations, and the least deviation, in nats
WIDTH, LEAST = 6.0, 0.02
#: log-perplexities are counted in steps of this size
STEP = 0.001
BROADCAST_LANGUAGES = 10_000
#: entries of 16 bytes that are broadcast at most
BROADCAST_ENTRIES = 3_000_000
#: entries of a shard, and bytes of text that a block of documents has, where the model is not broadcast
SHARD_ENTRIES, BLOCK_BYTES = 1 << 21, 8 << 20
#: blocks whose questions (about 4 MB each) a shard of the model meets at a time, times the number of shards
SHARE_BLOCKS = 16
#: distinct n-grams that a counting task holds, and bytes of text that one pass has
HELD, PASS_BYTES = 1 << 17, 1 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def symbols(data: np.ndarray, offsets: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the rows with ``ORDER - 1`` zeros before each, where the rows' own are, and how many each has.

    The number of the half whose model is meant stands above the bits of a code point.
    """
    counts = np.diff(np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(points) != counts.sum():  # bytes that are no UTF-8
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
        counts = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    at = np.arange(len(points)) + (ORDER - 1) * (row_of(counts) + 1)
    padded = np.repeat(half.astype(np.uint64) << U64(32), counts + ORDER - 1)
    padded[at] |= points
    return padded, at, counts


def _prefix(padded: np.ndarray) -> np.ndarray:
    return run_prefix(mix(padded + U64(1)))


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each item its class, and the place of each class's first item."""
    code, _ = pd.factorize(h)
    first = np.empty(int(code.max(initial=-1)) + 1, np.int64)
    first[code[::-1]] = np.arange(len(h))[::-1]
    return code, first


def _texts(rows: np.ndarray) -> list[str]:
    """Rows of code points as strings."""
    flat, k = rows.astype("<u4").tobytes().decode("utf-32-le", "replace"), rows.shape[1]
    return [flat[i : i + k] for i in range(0, len(flat), k)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []

    def merged() -> tuple[np.ndarray, ...]:
        h, n, half, rows = (np.concatenate(c) for c in zip(*held))
        code, first = _distinct(h)
        return h[first], np.bincount(code, n, len(first)).astype(np.int64), half[first], rows[first]

    def out() -> pa.RecordBatch:
        _, n, half, rows = merged()
        return pa.RecordBatch.from_arrays([pa.array(half), pa.array(_texts(rows), pa.string()), pa.array(n)], ["half", "gram", "n"])

    for batch in batches:
        (data, offsets), half = buffers(batch.column("text")), batch.column("half").to_numpy()
        for a, b in chunks(offsets, PASS_BYTES):
            padded, at, _ = symbols(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], half[a:b])
            if not len(at):
                continue
            h = run_hashes(_prefix(padded), at - ORDER + 1, ORDER)
            code, first = _distinct(h)
            end = at[first][:, None]
            held.append((h[first], np.bincount(code), (padded[end[:, 0]] >> U64(32)).astype(np.int32), padded[end + np.arange(1 - ORDER, 1)].astype(np.uint32)))
            if sum(len(x[0]) for x in held) > 2 * HELD:
                held = [merged()]
                if len(held[0][0]) > HELD:
                    yield out()
                    held = []
    if held:
        yield out()


def count_grams(own: DataFrame) -> DataFrame:
    """``half, k, gram, c`` of ``half, text``: counts at the highest order, distinct left neighbours below it."""
    top = settle(own.mapInArrow(_count, "half int, gram string, n long").groupBy("half", "gram").agg(F.sum("n").alias("c")))
    levels, below = top.select("half", F.lit(ORDER).alias("k"), "gram", "c"), top
    for k in range(ORDER - 1, 0, -1):
        below = below.groupBy("half", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("c"))
        levels = levels.unionByName(below.select("half", F.lit(k).alias("k"), "gram", "c"))
    levels = settle(levels)
    release(top)
    return levels


def discounts(levels: DataFrame) -> dict[tuple[int, int], list[float]]:
    """By half and order: what a count of 1, of 2, and of 3 or more gives away."""
    of = [F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5)]
    out = {}
    for r in levels.groupBy("half", "k").agg(*of).collect():  # a row per half and order
        n = [max(1, r[f"n{i}"]) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        cut = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
        out[r["half"], r["k"]] = [min(max(d, 0.1), 0.9 * (i + 1)) for i, d in enumerate(cut)]
    return out


def probabilities(levels: DataFrame) -> tuple[DataFrame, dict[int, float]]:
    """``half, gram, logp, logw`` of the n-grams and contexts, and the probability of a symbol never seen, by half.

    ``logp`` is the last symbol's interpolated log-probability (null for what is a context only), ``logw``
    the log-weight of the next lower order after this context (null for what is none).
    """
    given = F.lit(0.0)
    for (half, k), d in discounts(levels).items():
        given = F.when((F.col("half") == half) & (F.col("k") == k), F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])).otherwise(given)
    levels = levels.withColumn("cut", F.least(given, F.col("c").cast("double"))).withColumn("head", F.expr("substring(gram, 1, k - 1)"))
    heads = settle(levels.groupBy("half", (F.col("k") - 1).alias("k"), F.col("head").alias("gram")).agg(F.sum("c").alias("total"), F.sum("cut").alias("spare"), F.count("*").alias("types")))
    weight = (F.col("spare") / F.col("total")).alias("weight")
    unseen = {r["half"]: r["weight"] / (r["types"] + 1) for r in heads.where("k = 0").select("half", "types", weight).collect()}  # a row per half
    known, lower = None, None
    for k in range(1, ORDER + 1):
        own = levels.where(F.col("k") == k).join(heads.where(F.col("k") == k - 1).select("half", F.col("gram").alias("head"), "total", "types", weight), ["half", "head"])
        share = (F.col("c") - F.col("cut")) / F.col("total")
        if lower is None:
            own = own.select("half", "gram", (share + F.col("weight") / (F.col("types") + 1)).alias("p"))
        else:
            own = own.withColumn("tail", F.substring("gram", 2, k - 1)).join(lower.select("half", F.col("gram").alias("tail"), F.col("p").alias("less")), ["half", "tail"])
            own = own.select("half", "gram", (share + F.col("weight") * F.col("less")).alias("p"))
        lower = settle(own)
        known = lower if known is None else known.unionByName(lower)
    out = known.join(heads.where("k > 0").select("half", "gram", weight), ["half", "gram"], "full_outer")
    return out.select("half", "gram", F.log("p").alias("logp"), F.log("weight").alias("logw")), unseen


_ENTRY = pa.schema([("h", pa.int64()), ("logp", pa.float32()), ("logw", pa.float32())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams by the hash that scoring computes of them."""
    for batch in batches:
        h = np.zeros(batch.num_rows, np.uint64)
        each = batch.column("gram").to_pylist()
        order = np.array([len(g) for g in each], np.int64)
        points = np.frombuffer("".join(each).encode("utf-32-le"), np.uint32)
        prefix, start = _prefix(np.repeat(batch.column("half").to_numpy().astype(np.uint64) << U64(32), order) | points), np.cumsum(order) - order
        for k in np.unique(order):
            own = order == k
            h[own] = run_hashes(prefix, start[own], int(k))
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column("logp").cast(pa.float32()), batch.column("logw").cast(pa.float32())], schema=_ENTRY)


def _arrays(table: pa.Table) -> pa.Table:
    """One shard: its entries as arrays sorted by hash; what is missing is NaN."""
    h = table.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    cols = [h[order], *(table.column(c).to_numpy().astype(np.float32)[order] for c in ("logp", "logw"))]
    return pa.table({"shard": table.column("shard")[:1], **{c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(("h", "logp", "logw"), cols)}})


def _shard(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> U64(40)) * U64(n) >> U64(24)).astype(np.int64)


class Model:
    """``shards`` holds the sorted hash arrays (``shard, h, logp, logw``) of ``entries`` entries of both halves."""

    def __init__(self, shards: DataFrame, n: int, entries: int, unseen: dict[int, float]):
        self.shards, self.n, self.entries = shards, n, entries
        #: log-probability of a symbol that a half never saw; a half without texts knows nothing
        self.unseen = np.log([unseen.get(half, 1.0) for half in (0, 1)])


def fit(own: DataFrame) -> Model:
    """A model of each half of ``half, text``."""
    levels = count_grams(own)
    known, unseen = probabilities(levels)
    entries = settle(known.mapInArrow(_hashed, "h long, logp float, logw float"))
    size = entries.count()
    n = max(1, size // SHARD_ENTRIES)
    # the shard by the upper 24 bits of the hash, as in _shard
    shard = F.shiftright(F.shiftrightunsigned("h", 40) * n, 24).cast("int")
    shards = grouped(entries.withColumn("shard", shard), "shard", _arrays, "shard int, h binary, logp binary, logw binary")
    shards = settle(shards)
    release(levels, entries)
    return Model(shards, n, size, unseen)


def _stack(shards: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted arrays ``h, logp, logw`` of the shards, in order, as one; those of a single one are not copied."""
    out = []
    for c, kind in (("h", np.uint64), ("logp", np.float32), ("logw", np.float32)):
        parts = [np.frombuffer(x.as_buffer(), kind) for x in shards.column(c)]
        out.append(parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, kind), *parts]))
    return tuple(out)


def look(arrays: tuple[np.ndarray, np.ndarray, np.ndarray], h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``logp`` and ``logw`` by hash; NaN where there is none."""
    keys, logp, logw = arrays
    if not len(keys):
        return (np.full(len(h), np.nan, np.float32),) * 2
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    miss = keys[at] != h
    return np.where(miss, np.float32(np.nan), logp[at]), np.where(miss, np.float32(np.nan), logw[at])


def nats(look: Callable, unseen: np.ndarray, padded: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Negative log-probability of each row."""
    if not len(at):
        return np.zeros(len(counts))
    prefix = _prefix(padded)
    code, first = _distinct(run_hashes(prefix, at - ORDER + 1, ORDER))
    end = at[first]
    total, open_ = np.zeros(len(end)), np.arange(len(end))
    for k in range(ORDER, 0, -1):
        logp, _ = look(run_hashes(prefix, end[open_] - k + 1, k))
        hit = ~np.isnan(logp)
        total[open_[hit]] += logp[hit]
        open_ = open_[~hit]
        if k > 1 and len(open_):
            _, logw = look(run_hashes(prefix, end[open_] - k + 1, k - 1))
            total[open_] += np.nan_to_num(logw)  # a context never seen leaves all to the lower order
    total[open_] += unseen[(padded[end[open_]] >> U64(32)).astype(np.int64)]
    return -np.diff(np.concatenate(([0.0], np.cumsum(total[code])))[np.concatenate(([0], np.cumsum(counts)))])


def _needed(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of all n-grams and contexts that scoring may ask for."""
    prefix = _prefix(padded)
    _, first = _distinct(run_hashes(prefix, at - ORDER + 1, ORDER))
    end = at[first]
    return np.unique(np.concatenate([run_hashes(prefix, end - k + 1, j) for k in range(1, ORDER + 1) for j in (k, k - 1) if j]))


def _features(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Words, code points in words, symbols, repeated lines and words of repeated windows per row."""
    n = len(offsets) - 1
    starts, ends, counts = spans(data, offsets, NOT_SPACE)
    points = NOT_SPACE[data] & ((data & 0xC0) != 0x80)
    run = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])
    rows = row_of(counts)
    words = hash_spans(data, starts, ends)
    covered = np.zeros(len(words), bool)
    if len(words) >= 3:
        g = grams(words, 3)
        same = rows[: len(g)] == rows[2:]
        at = np.flatnonzero(same)
        own = mix(g[at] + rows[at].astype(np.uint64) * U64(0x9E3779B97F4A7C15))
        _, inverse, times = np.unique(own, return_inverse=True, return_counts=True)
        at = at[times[inverse] > 1]
        for k in range(3):
            covered[at + k] = True
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate((offsets[:-1][offsets[:-1] < offsets[1:]], breaks + 1)))
    line_start = line_start[line_start < len(data)]
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    stop = np.minimum(np.append(line_start[1:], len(data)), offsets[line_row + 1])
    stop = stop - ((stop > line_start) & (data[np.maximum(stop - 1, 0)] == 10)) if len(stop) else stop
    letters = np.concatenate(([0], np.cumsum(NOT_SPACE[data])))
    full = letters[stop] > letters[line_start] if len(stop) else np.zeros(0, bool)
    line_row, h = line_row[full], hash_spans(data, line_start[full], stop[full])
    own = mix(h + line_row.astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    _, first = np.unique(own, return_index=True)
    again = np.ones(len(own), bool)
    again[first] = False
    return [counts, run(points), run(_SYMBOL[data]), np.bincount(line_row[again], minlength=n), np.bincount(rows[covered], minlength=n)]


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _scored(batch: pa.RecordBatch, look: Callable, unseen: np.ndarray) -> Iterator[pa.RecordBatch]:
    (data, offsets), other = buffers(batch.column("text")), 1 - batch.column("half").to_numpy()
    for a, b in chunks(offsets, PASS_BYTES):
        x, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        got = [pa.array(v.astype(np.int64)) for v in _features(x, own)]
        padded, at, counts = symbols(x, own, other[a:b])
        mean = nats(look, unseen, padded, at, counts) / np.maximum(counts, 1)
        each = [batch.column(c).slice(a, b - a) for c in ("doc_id", "lang")]
        yield pa.RecordBatch.from_arrays([*each, *got, pa.array(mean, mask=counts == 0)], ["doc_id", "lang", *_NAMES, "nats"])


def score(own: DataFrame, model: Model, most: int = BROADCAST_ENTRIES) -> DataFrame:
    """Base figures and ``nats`` of ``doc_id, lang, half, text``."""
    spark, unseen = own.sparkSession, model.unseen
    schema = f"doc_id {dict(own.dtypes)['doc_id']}, lang string, {', '.join(f'{c} long' for c in _NAMES)}, nats double"
    if model.entries <= most:
        shared = spark.sparkContext.broadcast(_stack(model.shards.orderBy("shard").select("h", "logp", "logw").toArrow()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _scored(batch, lambda h: look(shared.value, h), unseen)

        return own.mapInArrow(run, schema)

    n = model.n
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(shuffle_partitions(spark), size // BLOCK_BYTES)
    dealt = own.withColumn("block", F.pmod(F.xxhash64("doc_id", "lang", "text"), F.lit(blocks)))

    def ask(table: pa.Table) -> pa.Table:
        rows = []
        for batch in table.combine_chunks().to_batches():
            (data, offsets), other = buffers(batch.column("text")), 1 - batch.column("half").to_numpy()
            found = [_needed(*symbols(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], other[a:b])[:2]) for a, b in chunks(offsets, PASS_BYTES)]
            h = np.unique(np.concatenate(found))
            edges = np.searchsorted(_shard(h, n), np.arange(n + 1))
            rows += [(batch.column("block")[0].as_py(), int(k), h[edges[k] : edges[k + 1]].tobytes()) for k in np.flatnonzero(np.diff(edges))]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["block", "shard", "h"])

    def answer(asked: pa.Table, shard: pa.Table) -> pa.Table:
        arrays = _stack(shard)
        told = [look(arrays, np.frombuffer(h.as_py(), np.uint64)) for h in asked.column("h")]
        return pa.table({"block": asked.column("block"), "shard": asked.column("shard"), "h": asked.column("h"), **{c: pa.array([t[i].tobytes() for t in told], pa.binary()) for i, c in enumerate(("logp", "logw"))}})

    def finish(docs: pa.Table, told: pa.Table) -> pa.Table:
        arrays = _stack(told.sort_by("shard"))
        return pa.Table.from_batches([out for batch in docs.combine_chunks().to_batches() for out in _scored(batch, lambda h: look(arrays, h), unseen)])

    # a block asks each of n shards about one in n of its n-grams, so a share has about SHARE_BLOCKS blocks' questions
    shares = -(-blocks // (SHARE_BLOCKS * n))
    asked = dealt.groupBy("block").applyInArrow(ask, "block long, shard int, h binary").withColumn("share", F.pmod("block", F.lit(shares)))
    shards = model.shards.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))
    told = asked.groupBy("shard", "share").cogroup(shards.groupBy("shard", "share")).applyInArrow(answer, "block long, shard int, h binary, logp binary, logw binary")
    return dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(finish, schema)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: base figures, ``base_failed``, ``kept``, ``log_perplexity`` and its band."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.pmod(F.xxhash64(F.col(text_col)), F.lit(2)).cast("int").alias("half"), F.col(text_col).alias("text"))
    scored = settle(score(own, fit(own.select("half", "text"))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    bins = scored.where(~failed & F.col("nats").isNotNull()).groupBy("lang", F.floor(F.col("nats") / STEP).alias("bin")).agg(F.count("*").alias("n"))
    middle = _weighted_median(bins, "bin").select(F.col("lang").alias("of"), F.col("m").alias("median"))
    far = bins.join(middle, F.col("lang").eqNullSafe(F.col("of"))).groupBy("lang", F.abs(F.col("bin") - F.col("median")).alias("bin")).agg(F.sum("n").alias("n"))
    half = WIDTH * F.greatest(F.lit(LEAST), 1.4826 * STEP * F.col("m"))
    bands = middle.join(_weighted_median(far, "bin"), F.col("of").eqNullSafe(F.col("lang"))).select("of", (STEP * (F.col("median") + 0.5)).alias("center"), half.alias("half"))
    bands = settle(bands.select("of", (F.col("center") - F.col("half")).alias("lower"), (F.col("center") + F.col("half")).alias("upper")))
    small = bands.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES
    out = scored.join(F.broadcast(bands) if small else bands, F.col("lang").eqNullSafe(F.col("of")), "left")
    inside = F.coalesce(F.col("nats").between(F.col("lower"), F.col("upper")), F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & inside).alias("kept"), F.col("nats").alias("log_perplexity"), "lower", "upper")


def _weighted_median(bins: DataFrame, col: str) -> DataFrame:
    w = Window.partitionBy("lang")
    ranked = bins.select("lang", col, F.sum("n").over(w.orderBy(col)).alias("upto"), F.sum("n").over(w).alias("total"))
    return ranked.where("2 * upto >= total").groupBy("lang").agg(F.min(col).alias("m"))
