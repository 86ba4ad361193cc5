"""SentencePiece encoding and decoding for merge-type vocabularies.

The encoder keeps a score-ordered agenda of adjacent symbol pairs: the pair whose merged piece has
the best score (leftmost on ties) is merged first, then its new neighbours enter the agenda.  No
piece has a space mark after another character, so a text is a row of independent units, each from
a space mark to the next.  A batch's distinct units are encoded together, one agenda each, in
lockstep over flat arrays; units of more than ``LONG`` symbols use a heap.  Characters without a
piece become their bytes.

Every Arrow batch is checked: its distinct units are also given to the sentencepiece library, and a
difference raises.  Decoding is a table lookup of piece bytes; bytes that are no UTF-8 become
U+FFFD and the first space goes, as in the library.

Null and empty texts have no ids and decode to the empty text.  Texts are encoded whole, however long;
ties of scores go to the left.  Rows are independent: repeated doc_ids give a row each, a null doc_id
stays null, an empty table gives an empty one, and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import buffers, chunks, hash_spans, ragged

LONG = 256
#: bytes of text encoded at once: the more, the fewer units are encoded twice
ENCODE_BYTES = 4 << 20
NONE = np.int32(2**31 - 1)
MARK = "▁"


class Merger:
    """Lockstep agenda over ranked merges: ``(left, right) -> merged`` symbol, best rank first."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray, rank: np.ndarray):
        key = left.astype(np.int64) << 32 | right
        size = 1 << max(4, int(np.ceil(np.log2(4 * len(key) + 1))))
        self.mask = size - 1
        self.keys, self.ranks, self.to = np.full(size, -1, np.int64), np.full(size, NONE, np.int32), np.zeros(size, np.int32)
        at, todo = self._slot(key), np.arange(len(key))
        while len(todo):  # open addressing
            free = self.keys[at[todo]] == -1
            slot, first = np.unique(at[todo][free], return_index=True)
            won = todo[free][first]
            self.keys[slot], self.ranks[slot], self.to[slot] = key[won], rank[won], merged[won]
            todo = todo[self.keys[at[todo]] != key[todo]]
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(29))) >> np.uint64(20)).astype(np.int64) & self.mask

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        rank, to = self.ranks[at], self.to[at]
        have = self.keys[at]
        rank[have != key] = NONE
        todo = np.flatnonzero((have != key) & (have != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            have = self.keys[at[todo]]
            hit = have == key[todo]
            rank[todo[hit]], to[todo[hit]] = self.ranks[at[todo[hit]]], self.to[at[todo[hit]]]
            todo = todo[~hit & (have != -1)]
        return rank, to

    def run(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every unit as far as it goes; symbols below zero never merge."""
        pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # units, symbols of each, symbols
        n, unit = len(lengths), np.arange(len(lengths))
        long = lengths > LONG
        if long.any():
            starts = np.cumsum(lengths) - lengths
            for u in np.flatnonzero(long):
                got = np.array(self._heap(symbols[starts[u] : starts[u] + lengths[u]].tolist()), np.int32)
                pieces.append((np.array([u]), np.array([len(got)]), got))
            symbols, unit, lengths = symbols[np.repeat(~long, lengths)], unit[~long], lengths[~long]
        keep = lengths > 0
        unit, lengths = unit[keep], lengths[keep]
        sym = symbols.astype(np.int32)
        rank = to = None
        while len(unit):
            starts = np.cumsum(lengths) - lengths
            if rank is None:
                rank, to = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int32)
                inner = np.ones(len(sym), bool)
                inner[starts + lengths - 1] = False
                at = np.flatnonzero(inner)
                rank[at], to[at] = self._pair(sym[at], sym[at + 1])
            best = np.minimum.reduceat(rank, starts)
            over = best == NONE
            if over.any():
                gone = np.repeat(over, lengths)
                pieces.append((unit[over], lengths[over], sym[gone]))
                unit, lengths, best = unit[~over], lengths[~over], best[~over]
                sym, rank, to = sym[~gone], rank[~gone], to[~gone]
                if not len(unit):
                    break
                starts = np.cumsum(lengths) - lengths
            hit = np.flatnonzero(rank == np.repeat(best, lengths))
            own = np.searchsorted(starts, hit, "right")
            first = np.ones(len(hit), bool)
            first[1:] = own[1:] != own[:-1]
            at = hit[first]
            sym[at] = to[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym, rank, to = sym[stay], rank[stay], to[stay]
            at -= np.arange(len(at))
            lengths = lengths - 1
            starts = np.cumsum(lengths) - lengths
            rank[at] = NONE
            right = at[at < starts + lengths - 1]
            rank[right], to[right] = self._pair(sym[right], sym[right + 1])
            left = at[at > starts] - 1
            rank[left], to[left] = self._pair(sym[left], sym[left + 1])
        units = np.concatenate([p[0] for p in pieces]) if pieces else np.empty(0, np.int64)
        sizes = np.concatenate([p[1] for p in pieces]) if pieces else np.empty(0, np.int64)
        flat = np.concatenate([p[2] for p in pieces]) if pieces else np.empty(0, np.int32)
        order = np.argsort(units, kind="stable")
        from_ = (np.cumsum(sizes) - sizes)[order]
        final = np.zeros(n, np.int64)
        final[units] = sizes
        return flat[ragged(from_, sizes[order])], final

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, to = self.look(left, right)
        rank[(left < 0) | (right < 0)] = NONE
        return rank, to

    def _heap(self, sym: list[int]) -> list[int]:
        """The same agenda for one long unit, as a heap over a linked list."""
        n = len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(i: np.ndarray, j: np.ndarray) -> None:
            x, y = np.array([sym[k] for k in i], np.int32), np.array([sym[k] for k in j], np.int32)
            rank, to = self._pair(x, y)
            for r, p, q, t, a, b in zip(rank.tolist(), i, j, to.tolist(), x.tolist(), y.tolist()):
                if r != NONE:
                    heapq.heappush(agenda, (r, p, q, t, a << 32 | b))

        offer(range(n - 1), range(1, n))
        dead = [False] * n
        while agenda:
            _, i, j, to, was = heapq.heappop(agenda)
            if dead[i] or dead[j] or after[i] != j or sym[i] << 32 | sym[j] != was:
                continue
            sym[i], dead[j] = to, True
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            near = [(p, q) for p, q in ((before[i], i), (i, after[i])) if p >= 0 and q >= 0]
            if near:
                offer([p for p, _ in near], [q for _, q in near])
        return [s for s, d in zip(sym, dead) if not d]


class Vocabulary:
    """A merge-type model: character and merge tables, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        usable = {p: i for i, p in enumerate(names) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or sp.is_unused(i))}
        if any(MARK in p.lstrip(MARK) for p in usable):
            raise ValueError("a piece has a space mark after another character; units would not be independent")
        if any(c not in usable for p in usable for c in p):
            raise ValueError("a piece has a character without a piece of its own")
        score = {i: sp.get_score(i) for i in usable.values()}
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        merges = [(usable[p[:k]], usable[p[k:]], i, order[score[i]]) for p, i in usable.items() for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
        self.merger = Merger(*(np.array(x) for x in zip(*merges)))
        chars = sorted((ord(p), i) for p, i in usable.items() if len(p) == 1)
        self.chars, self.char_ids = np.array([c for c, _ in chars]), np.array([i for _, i in chars], np.int32)
        self.byte0 = next(i for i in range(n) if sp.is_byte(i))
        text = [bytes([i - self.byte0]) if sp.is_byte(i) else b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.bytes, self.byte_lengths = np.frombuffer(b"".join(text), np.uint8), np.array([len(t) for t in text])
        self.byte_starts = np.cumsum(self.byte_lengths) - self.byte_lengths
        digits = [f"{i},".encode() for i in range(n)]
        self.digits, self.digit_lengths = np.frombuffer(b"".join(digits), np.uint8), np.array([len(t) for t in digits])
        self.digit_starts = np.cumsum(self.digit_lengths) - self.digit_lengths
        self.space = int(usable[MARK])

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Ids of single characters; minus the code point less one where there is none."""
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        return np.where(self.chars[at] == points, self.char_ids[at], -1 - points).astype(np.int32)

    def fallback(self, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace symbols without a piece by the ids of their bytes."""
        lost = np.flatnonzero(flat < 0)
        if not len(lost):
            return flat, sizes
        raw = [chr(-1 - p).encode("utf-8", "surrogatepass") for p in flat[lost].tolist()]
        width = np.ones(len(flat), np.int64)
        width[lost] = [len(r) for r in raw]
        out = np.repeat(flat, width)
        begin = np.cumsum(width) - width
        out[ragged(begin[lost], width[lost])] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) + self.byte0
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return out, np.bincount(owner, width, len(sizes)).astype(np.int64)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_batch(vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray, check: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a batch, and how many each has."""
    hashes, spans, per = [], [], []
    for a, b in chunks(offsets):
        low, high = offsets[a], offsets[b]
        x = data[low:high]
        space = x == 0x20
        mark = np.zeros(len(x) + 3, bool)  # the mark itself counts as a space
        mark[: len(x) - 2] = (x[:-2] == 0xE2) & (x[1:-1] == 0x96) & (x[2:] == 0x81) if len(x) > 2 else False
        white = space | mark[: len(x)]
        tail = white.copy()  # last byte of a space or mark
        tail[mark[: len(x)]] = False
        tail[2:] |= mark[: len(x) - 2][: max(0, len(x) - 2)] if len(x) > 2 else False
        first = np.zeros(len(x) + 1, bool)
        own = offsets[a : b + 1] - low
        first[own[:-1][own[:-1] < own[1:]]] = True
        begin = first[:-1].copy()
        begin[1:] |= white[1:] & ~tail[:-1]
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(x))
        counts = np.diff(np.searchsorted(starts, own))
        h = hash_spans(x, starts, ends)
        # the first unit of a text has a space mark put before it
        h = np.where(first[:-1][starts], h ^ np.uint64(0x5851F42D4C957F2D), h)
        hashes.append(h)
        spans.append(np.stack((starts + low, ends + low, first[:-1][starts]), 1))
        per.append(counts)
    if not hashes:
        return np.empty(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
    h, span, per = np.concatenate(hashes), np.concatenate(spans), np.concatenate(per)
    _, index, inverse = np.unique(h, return_index=True, return_inverse=True)
    raw = data.tobytes()
    units = [(MARK if f else "") + raw[s:e].decode().replace(" ", MARK) for s, e, f in span[index].tolist()]
    lengths = np.array([len(u) for u in units], np.int64)
    points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
    flat, sizes = vocab.fallback(*vocab.merger.run(vocab.symbols(points), lengths))
    if check:
        _compare(vocab, units, flat, sizes)
    at = np.cumsum(sizes) - sizes
    ids = flat[ragged(at[inverse], sizes[inverse])]
    ends = np.concatenate(([0], np.cumsum(sizes[inverse])))[np.concatenate(([0], np.cumsum(per)))]
    return ids, np.diff(ends)


def _compare(vocab: Vocabulary, units: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
    """The library's ids of the same units: in one text of units, in blocks, set off by line breaks.

    The library puts a space mark first, so each block starts with a line break of its own.
    """
    at = np.concatenate(([0], np.cumsum(sizes)))
    for k in range(0, len(units), 4096):
        block = units[k : k + 4096]
        plain = [u for u in block if "\n" not in u]
        got = np.array(vocab.library.encode("\n" + "\n".join(plain) + "\n", num_threads=1), np.int32)
        breaks = np.flatnonzero(got == vocab.byte0 + 10)
        mine = [flat[at[k + i] : at[k + i + 1]] for i, u in enumerate(block) if "\n" not in u]
        want = np.delete(got, breaks)[1:]
        have = np.concatenate(mine) if mine else np.empty(0, np.int32)
        same = len(breaks) == len(plain) + 1 and np.array_equal(want, have) and np.array_equal(np.diff(breaks) - 1, [len(m) for m in mine])
        if not same:
            raise AssertionError("ids differ from the sentencepiece library's")
        for i, u in enumerate(block):
            if "\n" in u:
                got = vocab.library.encode("\n" + u, num_threads=1)[2:]
                if got != flat[at[k + i] : at[k + i + 1]].tolist():
                    raise AssertionError("ids differ from the sentencepiece library's")


def decode_batch(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """UTF-8 texts of the ids of each row."""
    lengths = vocab.byte_lengths[ids]
    ends = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(counts)))].tolist()
    raw = vocab.bytes[ragged(vocab.byte_starts[ids], lengths)].tobytes()
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        text = raw[a:b]
        out.append(text[1:] if text[:1] == b" " else text)
    return out


def decimal_batch(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Each row's ids as decimal numbers joined by commas."""
    lengths = vocab.digit_lengths[ids]
    ends = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(counts)))].tolist()
    raw = vocab.digits[ragged(vocab.digit_starts[ids], lengths)].tobytes()
    return [raw[a : max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:])]


def _encode(path: str, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for a, b in chunks(offsets, ENCODE_BYTES):
                ids, counts = encode_batch(vocab, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], check)
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """``doc_id, ids`` of every text, as ``encode`` of the library without begin or end ids."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(_encode(path, check), f"doc_id {dict(own.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of the ids of ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            ids = batch.column("ids")
            counts = np.diff(ids.offsets.to_numpy())
            texts = [t.decode("utf-8", "replace") for t in decode_batch(vocab, ids.flatten().to_numpy(), counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded and decoded again in one pass."""
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for a, b in chunks(offsets, ENCODE_BYTES):
                ids, counts = encode_batch(vocab, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], check)
                own = [sha256(x).hexdigest() for x in decimal_batch(vocab, ids, counts)]
                back = [sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in decode_batch(vocab, ids, counts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts.astype(np.int64)), pa.array(own, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, f"doc_id {dict(own.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
