"""Near-duplicate passages by bottom-k compact windows.

A document is its sequence of 5-word shingles.  Two documents are linked where each has a stretch of ``least``
shingles (``words`` words) or more, of which at least 6/7, the first and the last among them, are in the other's and whose
Jaccard is enough.  Nothing is left to chance:

1. The distinct shingles of each block of documents are dealt out and counted.  A stretch of which more than ten (at 50 words) are in
   no other document has no near copy, and is dropped.  Ten is a seventh and four more, for words that were inserted.
2. All others order their shingles alike, rare ones first.  Of ``least`` shingles that may lack m more in a near copy the
   first m + 1 count, so the first one that two near copies have in common is among them in both.  Nor may a near copy lack more than
   a third of the different ones; so those of a stretch that nearly is one shingle over and over do not count before that one does.
   The stretches in which a shingle counts are its windows (l, c, r), and windows of one shingle meet.
3. Windows of equal shingles are copies: each is paired with their leader.  Leaders of one shingle are paired with one another, or,
   if they are many, with ``FEW`` of them.
4. Pairs are verified on the shingle sequences of both documents: longest stretches in which at
   least 6/7 of the shingles also occur in the partner, then exact Jaccard of the two stretches.
5. Of the many, those are compared with all others of their shingle whose windows do not all touch a passage that was found, or whose
   document is not in the class (connected component) that most of them are in.  The others are in one class already.  A window
   marks its shingles in bits; windows of which more bits differ than those of near copies can are not verified.

So documents with a link are in one class, and each such stretch touches a passage, as far as the verification of a pair tells.

Where very many hold a shingle in stretches that are no near copies, the comparison of bits in 5. is quadratic in them; Spark joins
these windows in parts, and only those that pass are verified.  A block ships one of its windows of equal shingles, so a passage that is in very many documents
reaches its bucket once per block.  Shingle sequences are shipped for documents of candidate pairs only; a bit table sized by
their number (32 MB at most) tells the tasks which those are; a wrong bit ships a sequence in vain.
Blocks are cut twice, so a frame must give its rows in the same partitions and order each time, as stored tables do.

Null, empty and short texts have no passage.  Texts are worked on whole, however long.  Rows that share a doc_id are
compared under that id; a document is never paired with itself.  Null ids are left out.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._bytes import _INVERSES, _power, LOWER, NOT_SPACE, U64, buffers, chunks, grams, hash_spans, in_table, mix, row_of, run_prefix, spans
from ._shared import bit_table, components, grouped, release, settle, shuffle_partitions

K = 5
#: Of the shingles in which two passages of 50 words and Jaccard 0.75 differ or agree, the share USABLE
#: are common ones with eight equal shingles on a side, where the edit splits the common run worst
#: (11 and 29 of 52: 6 of the 11 and all 29).  Two hash functions must have their minimum there;
#: ``functions`` gives how many functions reach RECALL.
RECALL, USABLE = 0.98, 35 / 52
#: bytes of text that make a block, and whose shingles make one bucket
CHUNK, FRAGMENT_BYTES = 2 << 20, 32 << 20
#: bytes of a shingle, with how many others a window is paired at once, and stretches whose shingles are ordered in one go
WIDTH, FEW, STARTS = 5, 8, 50_000
#: words of 64 bits in which the shingles of a window are marked
WORDS = 8
#: share of a stretch's shingles that the partner must have: two equally long stretches of
#: Jaccard 3/4 have 6/7 of theirs in common
SHARE = 6 / 7


def functions(recall: float = RECALL, usable: float = USABLE) -> int:
    """The fewest hash functions, 6 at least, of which two or more are usable with probability ``recall``."""
    n = 6
    while (1 - usable) ** n + n * usable * (1 - usable) ** (n - 1) > 1 - recall:
        n += 1
    return n


HASHES = functions()


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words, in order, and how many each row has."""
    low = LOWER[data]
    starts, ends, counts = spans(low, offsets, NOT_SPACE)
    words, rows = hash_spans(low, starts, ends), row_of(counts)
    if len(words) < K:
        return np.empty(0, np.uint64), np.zeros(len(counts), np.int64)
    same = rows[: len(words) - K + 1] == rows[K - 1 :]
    return grams(words, K)[same], np.maximum(counts - K + 1, 0)


def compact_windows(value: np.ndarray, low: np.ndarray, high: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All compact windows of at least ``least`` items of the ranges [low, high), which are apart and in order.

    The Cartesian trees of all ranges grow together, one level at a time; equal minima of a range are
    split at in one go, the leftmost first.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    low, high = low.astype(np.int32), high.astype(np.int32)
    fits = high - low >= least
    low, high = low[fits], high[fits]
    while len(low):
        size = high - low
        first = (np.cumsum(size) - size).astype(np.int32)
        at = np.repeat(low - first, size)
        at += np.arange(len(at), dtype=np.int32)
        v = value[at]
        hit = np.flatnonzero(v == np.repeat(np.minimum.reduceat(v, first), size))
        own = np.searchsorted(first, hit, "right") - 1
        center = at[hit]
        fresh = _changed(own)
        left = low[own]
        left[~fresh] = center[np.flatnonzero(~fresh) - 1] + 1
        right = high[own]
        fits = right - left >= least
        out.append((left[fits], center[fits], right[fits]))
        last = np.append(fresh[1:], True)
        low, high = np.concatenate((left, center[last] + 1)), np.concatenate((center, right[last]))
        fits = high - low >= least
        low, high = low[fits], high[fits]
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3


def _changed(*cols: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before; the first does."""
    out = np.ones(len(cols[0]), bool)
    out[1:] = cols[0][1:] != cols[0][:-1]
    for c in cols[1:]:
        out[1:] |= c[1:] != c[:-1]
    return out


def _misses(least: int) -> int:
    """How many shingles of a stretch its near copy may lack, up to ``K - 1`` of them for words that were inserted."""
    return least - math.ceil(least * SHARE) + K - 1


_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())])
_BLOCK_DDL = "block long, ids binary, counts binary, tokens binary"


def _blocks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The shingles of ``CHUNK`` bytes of text a row; documents too short for a passage are left out."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column(0)))
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy()
        data, offsets = buffers(batch.column(1))
        for a, b in chunks(offsets, CHUNK):
            token, counts = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            fits = counts >= least
            if not fits.any():
                continue
            token = token[np.repeat(fits, counts)]
            row = [block], [ids[a:b][fits].astype("<i8").tobytes()], [counts[fits].astype("<i8").tobytes()], [_bytes(token, WIDTH)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _BLOCK)], schema=_BLOCK)
            block += 1


def _bytes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _ints(raw: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = raw.reshape(-1, width)
    return out.view("<u8").ravel()


def _rank(doc: np.ndarray) -> np.ndarray:
    """The order of leaders: pseudo-random, and the same everywhere."""
    return mix(doc.astype(np.uint64) + U64(1))


def _opened(table: pa.Table | pa.RecordBatch, i: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Number, ids, counts and shingles of a block."""
    block, *raw = (table.column(f.name)[i] for f in _BLOCK)
    ids, counts, token = (np.frombuffer(r.as_buffer(), np.uint8) for r in raw)
    return block.as_py(), ids.view("<i8"), counts.view("<i8"), _ints(token, WIDTH)


def _deal(batches: Iterator[pa.RecordBatch], n: int, least: int) -> Iterator[pa.RecordBatch]:
    """The distinct shingles of a block and how many of its documents have each, by ranges of shingles."""
    for batch in _blocks(batches, least):
        for i in range(batch.num_rows):
            block, ids, counts, token = _opened(batch, i)
            own = np.unique(ids, return_inverse=True)[1].astype(np.uint64)
            pair = np.unique((token << U64(24)) | np.repeat(own, counts))
            token = pair >> U64(24)
            first = np.flatnonzero(_changed(token))
            held = np.minimum(np.diff(np.append(first, len(token))), 255).astype(np.uint8)
            token = token[first]
            edges = np.searchsorted((token * U64(n)) >> U64(8 * WIDTH), np.arange(n + 1))
            keys = np.flatnonzero(np.diff(edges))
            data = [_bytes(token[edges[k] : edges[k + 1]], WIDTH) for k in keys]
            held = [held[edges[k] : edges[k + 1]].tobytes() for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(np.full(len(keys), block)), pa.array(data, pa.binary()), pa.array(held, pa.binary())], ["bucket", "block", "data", "held"])


_TIMES = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("times", pa.binary())])
_TIMES_DDL = "block long, bucket int, times binary"


def _count(table: pa.Table) -> pa.Table:
    """How many documents have each shingle, as a power of two, for each block that has it; 0: no other document."""
    tokens = [_ints(np.frombuffer(r.as_buffer(), np.uint8), WIDTH) for r in table.column("data")]
    held = np.frombuffer(b"".join(r.as_py() for r in table.column("held")), np.uint8)
    ends = np.cumsum([len(t) for t in tokens])
    token = np.concatenate(tokens)
    order = np.argsort(token)
    fresh = _changed(token[order])
    total = np.add.reduceat(held[order].astype(np.int64), np.flatnonzero(fresh))
    times = np.empty(len(token), np.uint8)
    times[order] = np.minimum(np.log2(total), 15).astype(np.uint8)[np.cumsum(fresh) - 1]
    own = [times[a:b].tobytes() for a, b in zip(np.append(0, ends[:-1]), ends)]
    return pa.Table.from_arrays([table.column("block").combine_chunks(), table.column("bucket").combine_chunks(), pa.array(own, pa.binary())], schema=_TIMES)


_WINDOW = pa.schema([("token", pa.int64()), ("doc", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("context", pa.int64())])
_WINDOW_DDL = "token long, doc long, low int, high int, context long"


def _different(token: np.ndarray, which: np.ndarray, least: int) -> np.ndarray:
    """How many different shingles of ``which`` each stretch of ``least`` has."""
    order = np.argsort(token, kind="stable")
    last = np.full(len(token), -1)
    same = token[order[1:]] == token[order[:-1]]
    last[order[1:][same]] = order[:-1][same]
    # a shingle is a new one in stretches that begin after its last place
    at = np.flatnonzero(which)
    first = np.maximum(last[at] + 1, at - least + 1)
    first, at = np.maximum(first, 0)[first <= at], at[first <= at]
    edges = np.bincount(first, minlength=len(token) + 1) - np.bincount(at + 1, minlength=len(token) + 1)
    return np.cumsum(edges)[: len(token) - least + 1]


def bottom_windows(token: np.ndarray, times: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bottom-k compact windows: centers, and the range of the stretches of ``least`` shingles that have the center among their first ones.

    ``times`` tells how frequent a shingle is, 0 that no other document has it.  A stretch of which more than ``_misses``
    are in no other document has no near copy.  Of another one, which may lack m more, the m + 1 first count: rare ones come
    first, and all documents order them alike, so the first shingle that two near copies have in common is among them in both.
    Of the different shingles of a stretch its near copy may lack a third: those before a center, and those in no other document, are no more.
    """
    most, n = _misses(least), len(token) - least + 1
    rows, alone = row_of(counts), times == 0
    lacks = np.concatenate(([0], np.cumsum(alone)))
    lacks = lacks[least:] - lacks[:-least]
    different, only = _different(token, np.ones(len(token), bool), least), _different(token, alone, least)
    start = np.flatnonzero((lacks <= most) & (3 * only <= different) & (rows[:n] == rows[least - 1 :]))
    order = (times.astype(np.uint64) << U64(60)) | (mix(token ^ U64(0x5BD1E995)) >> U64(4))
    order[alone] = ~U64(0)
    keys = []
    for k in range(0, len(start), STARTS):
        own = start[k : k + STARTS]
        value = np.lib.stride_tricks.sliding_window_view(order, least)[own]
        at = np.argpartition(value, most, axis=1)[:, : most + 1]
        value = np.take_along_axis(value, at, 1)
        by = np.argsort(value, axis=1)
        at, value = np.take_along_axis(at, by, 1), np.take_along_axis(value, by, 1)
        before = np.cumsum(np.diff(value, axis=1, prepend=value[:, :1]) != 0, axis=1)
        used = (np.arange(most + 1) <= (most - lacks[own])[:, None]) & (3 * (before + only[own, None]) <= different[own, None])
        center = (own[:, None] + at)[used]
        # runs of starts of one center have consecutive keys
        keys.append(center * (least + 2) + np.broadcast_to(own[:, None], at.shape)[used] - center + least)
    if not start.size:
        return (np.empty(0, np.int64),) * 3
    key = np.sort(np.concatenate(keys))
    first = np.flatnonzero(np.diff(key, prepend=-9) != 1)
    last = np.append(first[1:], len(key))[: len(first)] - 1
    center = key[first] // (least + 2)
    low, high = (key[k] % (least + 2) + center - least for k in (first, last))
    return center, low, high + least


def _windows(blocks: pa.Table, times: pa.Table, least: int) -> pa.Table:
    """Bottom-k compact windows of one block, one of each kind of equal ones; the others as pairs with it (see ``_meet``)."""
    _, ids, counts, token = _opened(blocks, 0)
    distinct, inverse = np.unique(token, return_inverse=True)
    times = times.sort_by("bucket").column("times")
    times = np.frombuffer(b"".join(t.as_py() for t in times), np.uint8)
    if len(times) != len(distinct):
        raise ValueError("the documents came in another order the second time; store them first")
    times = times[inverse]
    center, low, high = bottom_windows(token, times, counts, least)
    prefix = run_prefix(token)
    # equal for windows of equal shingles
    context = prefix[high] - prefix[low]
    context *= _power(_INVERSES[0], len(prefix))[low]
    context = mix(context ^ ((high - low) * 1024 + center - low).astype(np.uint64))
    row = row_of(counts)[center]
    first = (np.cumsum(counts) - counts)[row]
    token, doc, low, high = token[center], ids[row], low - first, high - first
    order = np.lexsort((_rank(doc), context, token))
    token, doc, low, high, context = (v[order] for v in (token, doc, low, high, context))
    fresh = _changed(token, context) if len(token) else np.empty(0, bool)
    pair = np.stack((doc[fresh][np.cumsum(fresh) - 1], doc), 1)[~fresh] if len(token) else np.empty((0, 2), np.int64)
    pair = np.unique(pair[pair[:, 0] != pair[:, 1]], axis=0)
    none = np.full(len(pair), -1)
    cols = (token[fresh].astype(np.int64), doc[fresh], low[fresh], high[fresh], context[fresh].view(np.int64)), (pair[:, 1] & (1 << 40) - 1, pair[:, 0], none, none, pair[:, 1])
    cols = [np.concatenate(c) for c in zip(*cols)]
    return pa.Table.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(cols, _WINDOW)], schema=_WINDOW)


_MET = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("token", pa.int64()), ("low", pa.int32()), ("high", pa.int32())])
_MET_DDL = "x long, y long, token long, low int, high int"


def _meet(table: pa.Table) -> pa.Table:
    """Pairs of documents that have windows of one shingle.

    Windows of equal shingles are paired with their leader, all leaders of a shingle with one another.  Of more than ``FEW`` each
    is paired with ``FEW`` of them, and all follow as rows without ``y``.  Rows without a range are pairs already.
    """
    token, doc, low, high, context = (table.column(f.name).to_numpy() for f in _WINDOW)
    rank = _rank(doc)
    own = np.flatnonzero(low < 0)
    pairs = [np.stack((doc[own], context[own]), 1)]
    order = np.lexsort((rank, context, token))
    order = order[low[order] >= 0]
    token, doc, low, high, context, rank = (v[order] for v in (token, doc, low, high, context, rank))
    fresh = _changed(token, context)
    lead = np.flatnonzero(fresh)
    pairs.append(np.stack((doc[lead][np.cumsum(fresh) - 1], doc), 1)[~fresh])
    lead = lead[np.lexsort((rank[lead], token[lead]))]
    token, doc, low, high = (v[lead] for v in (token, doc, low, high))
    first = np.flatnonzero(_changed(token))
    size = np.diff(np.append(first, len(token)))
    begin, many = np.repeat(first, size), np.repeat(size, size)
    for k in range(FEW):
        own = np.flatnonzero((np.arange(len(token)) - begin > k) & (many > k))
        pairs.append(np.stack((doc[begin[own] + k], doc[own]), 1))
    pair = np.concatenate(pairs)
    pair = np.unique(np.sort(pair[pair[:, 0] != pair[:, 1]], axis=1), axis=0)
    crowd = np.flatnonzero(many > FEW + 1)
    none = [pa.nulls(len(pair), f.type) for f in list(_MET)[2:]]
    left = pa.Table.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), *none], schema=_MET)
    right = [pa.array(doc[crowd]), pa.nulls(len(crowd), pa.int64()), *(pa.array(v[crowd]) for v in (token, low, high))]
    return pa.concat_tables([left, pa.Table.from_arrays(right, schema=_MET)])


def _sequences(batches: Iterator[pa.RecordBatch], table) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        batch = batch.filter(pa.array(in_table(table.value, batch.column("h").to_numpy())))
        if not batch.num_rows:
            continue
        data, offsets = buffers(batch.column(1))
        for a, b in chunks(offsets):
            token, counts = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            raw = np.ascontiguousarray(token.view(np.uint8).reshape(-1, 8)[:, :5]) if len(token) else np.empty((0, 5), np.uint8)
            ends = np.concatenate(([0], np.cumsum(counts) * 5)).astype(np.int32)
            blobs = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), blobs], ["doc_id", "tokens"])


def _tokens(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view(np.uint64).ravel()


def _longest(inside: np.ndarray, share: float) -> tuple[int, int]:
    """The longest stretch whose mean reaches ``share``, leftmost on ties."""
    total = np.concatenate(([0.0], np.cumsum(inside - share)))
    low = np.minimum.accumulate(total)
    best = (0, 0)
    # first place whose running minimum is at most the value at each end
    first = len(low) - np.searchsorted(low[::-1], total + 1e-9, "right")
    size = np.arange(len(total)) - first
    end = int(size.argmax())
    if size[end] > 0:
        best = (int(first[end]), end)
    return best


def _occurrence(order: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many equal items stand before each item; ``order`` sorts ``x`` stably."""
    v = x[order]
    fresh = np.ones(len(v), bool)
    fresh[1:] = v[1:] != v[:-1]
    at = np.arange(len(v))
    rank = np.empty(len(v), np.int64)
    rank[order] = at - at[fresh][np.cumsum(fresh) - 1]
    return rank


def _place(y: list[int], x: list[int], where: np.ndarray, free: np.ndarray, a: int, b: int, least: int, percent: int) -> tuple[int, int, int, int, float] | None:
    """[a, b) of ``y`` with the stretch of ``x`` around its middle match, if their Jaccard is enough."""
    at = free[a:b].nonzero()[0]
    own = where[a:b][at]
    # the stretch of x around the middle match, as long as that of y and an edit more
    near = np.sort(own)
    middle = int(near[len(near) // 2])
    p, q = int(near[near.searchsorted(middle - (b - a))]), int(near[near.searchsorted(middle + (b - a), "right") - 1]) + 1
    if q - p < least:  # an edit at an end
        p = min(max(0, p - int(at[0])), len(x) - least)
        q = max(q, p + least)
    mine, other = set(y[a:b]), set(x[p:q])
    common = len(mine & other)
    union = len(mine) + len(other) - common
    return (a, b, p, q, common / union) if 100 * common >= percent * union else None


def _inner(y: list[int], x: list[int], where: np.ndarray, free: np.ndarray, a: int, b: int, least: int, percent: int) -> list[tuple[int, int, int, int, float]]:
    """Passages inside [a, b), which is none as a whole: each start in turn, as far as it reaches."""
    total = np.concatenate(([0], np.cumsum(free[a:b])))
    out, i = [], a
    while i + least <= b:
        best = None
        if total[i - a + least] - total[i - a] >= SHARE * least:
            best = _place(y, x, where, free, i, i + least, least, percent)
        step = least
        while best and step and best[1] < b:  # grow by halving steps
            more = _place(y, x, where, free, i, min(b, best[1] + step), least, percent)
            best, step = (more, step) if more else (best, step // 2)
        if best:
            out.append(best)
        i = best[1] if best else i + 1
    return out


def stretches(y: np.ndarray, x: np.ndarray, least: int, percent: int) -> list[tuple[int, int, int, int, float]]:
    """Passages of ``y`` and where ``x`` has them: start, end, start, end (shingles) and Jaccard.

    First equal runs along the diagonals on which shingles meet, then, in what these leave, longest
    stretches with enough shingles in common, until no part has one of ``least`` shingles.
    """
    if len(x) < least or len(y) < least:
        return []
    order = np.argsort(x, kind="stable")
    v = x[order]
    begin, stop = np.searchsorted(v, y), np.searchsorted(v, y, "right")
    inside = stop > begin
    hit = np.flatnonzero(inside)
    if len(hit) < least * SHARE:
        return []
    first = order[begin[hit]]
    nth = order[np.minimum(begin + _occurrence(np.argsort(y, kind="stable"), y), stop - 1)[hit]]
    diagonals, votes = np.unique(np.concatenate((first - hit, nth - hit)), return_counts=True)
    out = []
    free = inside.copy()
    for d in diagonals[votes >= K][np.argsort(-votes[votes >= K], kind="stable")].tolist():
        low, high = max(0, -d), min(len(y), len(x) - d)
        same = np.zeros(high - low + 2, np.int8)
        same[1:-1] = (y[low:high] == x[low + d : high + d]) & free[low:high]
        edge = np.flatnonzero(np.diff(same)).reshape(-1, 2)
        for a, b in (edge[edge[:, 1] - edge[:, 0] >= least] + low).tolist():
            out.append((a, b, a + d, b + d, 1.0))
            free[a:b] = False
    where = np.zeros(len(y), np.int64)
    where[hit] = nth
    left = np.flatnonzero(free)
    # matches further apart than an edit or two belong to different passages
    parts = [(int(p[0]), int(p[-1]) + 1) for p in np.split(left, np.flatnonzero(np.diff(left) > 2 * K + 2) + 1) if len(p)]
    y, x = (y.tolist(), x.tolist()) if any(q - p >= least for p, q in parts) else (y, x)
    while parts:
        start, stop_ = parts.pop()
        if stop_ - start < least:
            continue
        a, b = _longest(free[start:stop_], SHARE)
        a, b = a + start, b + start
        if b - a < least:
            continue
        # a stretch of the greatest length that fails as a whole may hold shorter passages
        fresh = _place(y, x, where, free, a, b, least, percent)
        found = [fresh] if fresh else _inner(y, x, where, free, a, b, least, percent)
        out.extend(found)
        for f in found:
            free[f[0] : f[1]] = False
        # what crosses an end of a failed stretch is looked at with the text beside it
        more = 0 if fresh else least - 1
        parts += [(start, a + more), (b - more, stop_)]
    return sorted(out)


_PASSAGE = pa.schema([("x", pa.int64()), ("y", pa.int64()), *((c, pa.int64()) for c in ("y_start", "y_end", "x_start", "x_end")), ("similarity", pa.float64())])
_PASSAGE_DDL = "x long, y long, y_start long, y_end long, x_start long, x_end long, similarity double"


def _check(batches: Iterator[pa.RecordBatch], least: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for x, y, a, b in zip(*((v.as_py() for v in batch.column(c)) for c in ("x", "y", "a", "b"))):
            for s, e, p, q, sim in stretches(_tokens(b), _tokens(a), least, percent):
                rows.append((x, y, s, e + K - 1, p, q + K - 1, sim))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PASSAGE)], schema=_PASSAGE)


def overlapping(met: DataFrame, least: int) -> DataFrame:
    """``x, y`` of which two windows of different minima overlap in ``least`` shingles, or that share a verbatim run or a pair of marks."""
    order = Window.partitionBy("x", "y").orderBy("low", "high", "at").rowsBetween(Window.unboundedPreceding, -1)
    furthest = met.withColumn("m", F.max(F.struct("high", "at")).over(order))
    # the furthest end of an earlier window of a minimum other than that of the furthest one
    second = F.max(F.when(F.col("m.at") != F.col("at"), F.least("high", "m.high"))).over(order)
    reach = F.when(F.col("m.at") != F.col("at"), F.col("m.high")).otherwise(second)
    overlap = F.col("reach").isNotNull() & (F.least("reach", "high") - F.col("low") >= least)
    return furthest.withColumn("reach", reach).where((F.col("low") < 0) | overlap).select("x", "y")


def _verified(pairs: DataFrame, sequences: DataFrame, least: int, percent: int) -> DataFrame:
    """Passages of ``pairs``."""
    ys = sequences.select(F.col("doc_id").alias("y"), F.col("tokens").alias("b"))
    xs = sequences.select(F.col("doc_id").alias("x"), F.col("tokens").alias("a"))
    return settle(pairs.join(ys, "y").join(xs, "x").select("x", "y", "a", "b").mapInArrow(partial(_check, least=least, percent=percent), _PASSAGE_DDL))


def _classes(found: DataFrame) -> DataFrame:
    """``doc, class_id`` of the documents that have passages."""
    return components(found.select("x", "y").distinct()).select(F.col("node").alias("doc"), F.col("component").alias("class_id"))


def _told(crowd: DataFrame, found: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """``crowd`` with the ``class_id`` of a window's document if each stretch of ``least`` shingles of the window touches a passage."""
    sides = (F.struct(F.col(d).alias("doc"), (F.col(f"{d}_start") - least + 1).alias("a"), (F.col(f"{d}_end") - K).alias("b")) for d in "xy")
    spans = found.select(F.explode(F.array(*sides)).alias("s")).select("s.*").distinct()
    # a and b are the first and last start of a stretch that touches the passage; ranges that follow one another are one
    order = Window.partitionBy("doc").orderBy("a", "b")
    spans = spans.withColumn("upto", F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("part", F.sum(F.when(F.col("a") <= F.col("upto") + 1, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc", "part").agg(F.min("a").alias("a"), F.max("b").alias("b")).join(classes, "doc")
    touch = (crowd.doc == spans.doc) & (F.col("a") <= F.col("low")) & (F.col("b") >= F.col("high") - least)
    return crowd.join(spans, touch, "left").select(*[crowd[c] for c in crowd.columns], "class_id")


def _unmet(told: DataFrame) -> DataFrame:
    """The windows of the shingles of which some have to be compared with all others of their shingle; those are ``open``.

    Windows that touch passages of documents of one class, the largest of the shingle, have nothing to gain from one another.
    """
    sizes = told.groupBy("token", "class_id").count()
    known = F.when(F.col("class_id").isNotNull(), F.struct("count", "class_id"))
    main = sizes.groupBy("token").agg(F.max(known).alias("main"), F.sum("count").alias("all")).where("main is null or main.count < all")
    main = main.select("token", F.col("main.class_id").alias("main"))
    return told.join(main, "token").withColumn("open", ~F.coalesce(F.col("class_id") == F.col("main"), F.lit(False))).drop("main")


_MARKED = ["token", "low", "high", "class_id", "open"]
_SIGNED_DDL = "doc long, token long, class_id long, open boolean, spare int, " + ", ".join(f"s{k} long" for k in range(WORDS))


def _marks(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Windows with a bit for each of their shingles, and how many of these the window of a near copy may lack."""
    spare = _misses(least) - least
    for batch in batches:
        docs, blobs, windows = batch.column("doc"), batch.column("tokens"), batch.column("windows")
        for i in range(batch.num_rows):
            bit = (_tokens(blobs[i].as_py()) & U64(64 * WORDS - 1)).astype(np.int64)
            own = windows[i].values
            for a in range(0, len(own), STARTS):
                part = own.slice(a, STARTS)
                low, high = (part.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "high"))
                size = np.minimum(high, len(bit)) - np.minimum(low, len(bit))
                at = np.arange(size.sum()) + np.repeat(np.minimum(low, len(bit)) - (np.cumsum(size) - size), size)
                table = np.zeros((len(part), 64 * WORDS), bool)
                table[np.repeat(np.arange(len(part)), size), bit[at]] = True
                signs = np.packbits(table, axis=1).view(np.int64)
                cols = [pa.array(np.full(len(part), docs[i].as_py(), np.int64)), *(part.field(c) for c in ("token", "class_id", "open")), pa.array((high - low + spare).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(np.ascontiguousarray(signs[:, k])) for k in range(WORDS)], ["doc", "token", "class_id", "open", "spare", *(f"s{k}" for k in range(WORDS))])


def _pairs(unmet: DataFrame, sequences: DataFrame, tried: DataFrame, least: int) -> DataFrame:
    """``x, y`` of an open window and another one of its shingle that may be near copies, by their marks, and were not tried yet.

    Of a stretch at most ``_misses`` shingles are not in its near copy, so of a window at most as many as lie outside the
    stretch and these.  Windows that touch passages of one class have nothing to gain from one another.
    """
    per = unmet.groupBy("doc").agg(F.collect_list(F.struct(*_MARKED)).alias("windows"))
    per = per.join(sequences.withColumnRenamed("doc_id", "doc"), "doc").select("doc", "tokens", "windows")
    signed = settle(per.mapInArrow(partial(_marks, least=least), _SIGNED_DDL))
    a, b = (signed.select([F.col(c).alias(c if c == "token" else f"{side}_{c}") for c in signed.columns]) for side in "ab")
    lacks = lambda p, q: reduce(add, [F.bit_count(F.col(f"{p}_s{k}").bitwiseAND(F.bitwise_not(f"{q}_s{k}"))) for k in range(WORDS)])
    once = ~F.col("b_open") & (F.col("a_doc") != F.col("b_doc")) | (F.col("a_doc") < F.col("b_doc"))
    apart = ~F.coalesce(F.col("a_class_id") == F.col("b_class_id"), F.lit(False))
    near = (lacks("a", "b") <= F.col("a_spare")) & (lacks("b", "a") <= F.col("b_spare"))
    a = a.where("a_open")
    both = a.join(b, (a.token == b.token) & once & apart & near).select(F.least("a_doc", "b_doc").alias("x"), F.greatest("a_doc", "b_doc").alias("y")).distinct()
    out = settle(both.join(tried, ["x", "y"], "left_anti"))
    release(signed)
    return out


def near_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 50, percent: int = 75) -> DataFrame:
    """``doc_id, start_word, end_word, partner_id, partner_start, partner_end, similarity, class_id``.

    One row per document and passage of at least ``words`` words that another document has too, with
    one such document; the leader of a passage has a row for each distinct stretch of its own.  ``class_id`` is the smallest
    doc_id that the document's links lead to, its own included.
    """
    spark = docs.sparkSession
    least = words - K + 1
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(shuffle_partitions(spark), size // FRAGMENT_BYTES)
    # cut twice from the texts rather than stored
    blocks = own.mapInArrow(partial(_blocks, least=least), _BLOCK_DDL)
    dealt = own.mapInArrow(partial(_deal, n=n, least=least), "bucket int, block long, data binary, held binary")
    times = grouped(dealt, "bucket", _count, _TIMES_DDL)
    windows = blocks.groupBy("block").cogroup(times.groupBy("block")).applyInArrow(lambda b, t: _windows(b, t, least), _WINDOW_DDL)
    met = settle(grouped(windows.withColumn("bucket", F.pmod("token", F.lit(n))), "bucket", _meet, _MET_DDL))
    pairs = settle(met.where("y is not null").select("x", "y").distinct())
    ends = pairs.select(F.explode(F.array("x", "y")).alias("d")).select(F.xxhash64("d").alias("h"))
    needed = spark.sparkContext.broadcast(bit_table(ends, "h", 2 * pairs.count()))
    marked = own.where("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    sequences = settle(marked.mapInArrow(partial(_sequences, table=needed), "doc_id long, tokens binary"), "lz4")
    found = _verified(pairs, sequences, least, percent)
    crowd = met.where("y is null").select(F.col("x").alias("doc"), "token", "low", "high")
    more = _pairs(_unmet(_told(crowd, found, _classes(found), least)), sequences, pairs, least)
    found = found.unionByName(_verified(more, sequences, least, percent))
    release(met, sequences)
    classes = _classes(found)

    def told(mine: str, other: str) -> DataFrame:
        """One partner of each passage of the documents ``mine``."""
        span = F.struct(F.col(other).alias("partner_id"), F.col(f"{other}_start").alias("partner_start"), F.col(f"{other}_end").alias("partner_end"), "similarity")
        one = found.groupBy(F.col(mine).alias("doc_id"), F.col(f"{mine}_start").alias("start_word"), F.col(f"{mine}_end").alias("end_word")).agg(F.min(span).alias("p"))
        return one.select("doc_id", "start_word", "end_word", "p.*")

    out = told("y", "x").unionByName(told("x", "y")).dropDuplicates(["doc_id", "start_word", "end_word", "partner_id"])
    return out.join(classes.select(F.col("doc").alias("doc_id"), "class_id"), "doc_id")
