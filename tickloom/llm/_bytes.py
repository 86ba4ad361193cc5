"""Array kernels over the UTF-8 bytes of an Arrow string column.

Every helper works on one Arrow batch inside a task.  Texts are handled whole;
``chunks`` only decides how many documents share one numpy pass, so the
temporary arrays stay small however many rows a batch has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# batches of many sizes come and go in a worker; give their memory back at once
pa.set_memory_pool(pa.system_memory_pool())

CHUNK_BYTES = 2 << 20
U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: bytes of words ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~_SPACE
#: bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply); changes ``x`` in place."""
    x ^= x >> U64(31)
    x *= U64(0x7FB5D329728EA185)
    x ^= x >> U64(27)
    x *= U64(0x81DADEF4BC2DD44D)
    x ^= x >> U64(33)
    return x


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
_BASES = (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
_powers = {b: np.ones(1, np.uint64) for b in (*_BASES, *_INVERSES)}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers[base]
    if len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column, "") if column.null_count else column
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes together; a longer text is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, min(end, n)
        row = end


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes for which ``inside`` holds, and the runs of each row.

    Runs never cross from one row into the next.
    """
    m = inside[data]
    left = np.zeros(len(m) + 1, bool)
    left[1:] = m
    left[offsets] = False
    starts = np.flatnonzero(m & ~left[:-1])
    right = np.zeros(len(m) + 1, bool)
    right[:-1] = m
    right[offsets] = False
    ends = np.flatnonzero(m & ~right[1:]) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans, from one prefix sum over ``data``; kinds 0 and 1 are independent."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((_TABLE ^ U64(kind << 40))[data] * _power(_BASES[kind], n), out=prefix[1:])
    h = prefix[ends]
    h -= prefix[starts]
    h *= _power(_INVERSES[kind], n + 1)[starts]
    h += (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93)
    return mix(h)


_ODD = mix(np.arange(1, 65, dtype=np.uint64)) | U64(1)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` neighbours of ``h``, ``len(h) - k + 1`` of them."""
    n = max(0, len(h) - k + 1)
    g = np.full(n, k, np.uint64)
    for j in range(k):
        g += h[j : j + n] * _ODD[j]
    return mix(g)


def run_prefix(h: np.ndarray) -> np.ndarray:
    """What ``run_hashes`` needs to know of the sequence ``h``."""
    out = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _power(_BASES[0], len(h)), out=out[1:])
    return out


def run_hashes(prefix: np.ndarray, start: np.ndarray, k: int, whole: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the runs of ``k`` items from ``start`` on; 0 where not ``whole``, and only there."""
    if whole is not None:
        start = np.where(whole, start, 0)
    if len(prefix) <= k:
        return np.zeros(len(start), np.uint64)
    out = prefix[start + k]
    out -= prefix[start]
    out *= _power(_INVERSES[0], len(prefix))[start]
    out = np.maximum(mix(out ^ mix(np.array([k], np.uint64))), U64(1))
    return out if whole is None else np.where(whole, out, U64(0))


def in_table(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes have their low bits in the bit table ``table`` of 32-bit words."""
    low = h.astype(np.uint64) & U64(32 * len(table) - 1)
    return (table[(low >> U64(5)).astype(np.int64)] >> (low & U64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)


def row_of(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of ``lengths[i]`` items from ``starts[i]`` on, for all i in order."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) if len(lengths) else np.empty(0, np.int64)
    return np.arange(total) + shift


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingle hashes, by row and then by hash, and the set size of each row.

    A row of fewer than ``k`` words has its whole word sequence as one shingle, a row without
    words has none.
    """
    low = LOWER[data]
    starts, ends, counts = spans(low, offsets, NOT_SPACE)
    words = hash_spans(low, starts, ends)
    rows = row_of(counts)
    if len(words) >= k:
        same = rows[: len(words) - k + 1] == rows[k - 1 :]
        h, r = grams(words, k)[same], rows[: len(words) - k + 1][same]
    else:
        h, r = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = np.concatenate(([0], np.cumsum(counts)))[short]
        own = np.array([grams(words[f : f + c], int(c))[0] for f, c in zip(first, counts[short])], np.uint64)
        h, r = np.concatenate((h, own)), np.concatenate((r, short))
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    if len(h):
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        h, r = h[fresh], r[fresh]
    return h, np.bincount(r, minlength=len(counts)).astype(np.int64)


def varints(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte-aligned code of rows of ascending integers: gaps, seven bits to a byte.

    Returns the bytes of all rows and the number of bytes of each.
    """
    values = values.astype(np.uint64)
    gap = np.diff(values, prepend=U64(0))
    first = (np.cumsum(counts) - counts)[counts > 0]
    gap[first] = values[first]
    size = np.ones(len(gap), np.int64)
    for k in range(1, 10):
        size += gap >= U64(1 << 7 * k)
    out = np.empty(int(size.sum()), np.uint8)
    upto = np.concatenate(([0], np.cumsum(size)))
    for k in range(int(size.max(initial=0))):
        live = np.flatnonzero(size > k)
        out[upto[live] + k] = ((gap[live] >> U64(7 * k)) & U64(127)).astype(np.uint8) | ((size[live] > k + 1) * 128).astype(np.uint8)
    return out, np.diff(upto[np.concatenate(([0], np.cumsum(counts)))])


def unvarints(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The integers of ``varints`` and how many each row has."""
    raw = np.frombuffer(b"".join(blobs), np.uint8)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
    gap = np.zeros(len(last), np.uint64)
    for k in range(int((last - first).max(initial=-1)) + 1):
        live = np.flatnonzero(first + k <= last)
        gap[live] |= (raw[first[live] + k] & 127).astype(np.uint64) << U64(7 * k)
    ends = np.searchsorted(last, np.cumsum([len(b) for b in blobs])) if blobs else np.empty(0, np.int64)
    counts = np.diff(ends, prepend=0)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(gap, dtype=np.uint64)))
    return total[1:] - np.repeat(total[ends - counts], counts), counts


def binaries(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])
