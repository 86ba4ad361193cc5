"""Fill-in-middle transformation with cuts at unit boundaries, found in 64-bit words.

A unit is a run of ASCII letters or any other single code point.  The UTF-8 of a block of texts is laid out in
8-byte slots, each text from a word of its own with at least one zero byte behind it, and viewed as uint64.  Letters and continuation
bytes are marked by arithmetic on whole words, and from them the bytes that end a unit.  The marks of each word are
counted (``bitwise_count``); the word that holds the k-th end is found by a search in the running
count, and the byte in that word by a multiplication that adds up its marks.

Two cuts drawn from a hash of the id divide a text into prefix, middle and suffix; a text becomes ``<P>``prefix``<S>``suffix``<M>``middle (psm),
``<S>``suffix``<P>``prefix``<M>``middle (spm), or stays as it is (plain).

A null text counts as empty and comes back empty; empty texts and those with a marker in them stay plain.  Texts of any
length are cut whole.  A null doc_id is hashed as the empty string.  Repeated rows get equal results; an empty
table gives an empty one.  All other columns pass through ``fill_in_middle`` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._bytes import U64, buffers, chunks, ragged

MARKERS = ("<P>", "<S>", "<M>")
_ONES = U64(0x0101010101010101)
_HIGH = U64(0x8080808080808080)
_LOW7 = U64(0x7F7F7F7F7F7F7F7F)
_ALL = U64(0xFFFFFFFFFFFFFFFF)


class Words:
    """The texts of a block as uint64 words, with the marks of unit ends and of code points."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.size = np.diff(offsets)
        words = self.size // 8 + 1
        self.first = np.concatenate(([0], np.cumsum(words)))
        laid = np.zeros(8 * int(self.first[-1]), np.uint8)
        laid[ragged(8 * self.first[:-1], self.size)] = data
        w = laid.view("<u8")
        low = (w | _ONES * U64(0x20)) & _LOW7
        letter = low + _ONES * U64(0x1F) & ~(low + _ONES * U64(0x05)) & ~w & _HIGH
        follows = w & ~(w << U64(1)) & _HIGH
        before = letter << U64(8)
        before[1:] |= letter[:-1] >> U64(56)
        begins = _HIGH & ~follows & ~(letter & before)
        ends = begins >> U64(8)
        ends[:-1] |= begins[1:] << U64(56)
        # the last word of a text has its last size % 8 bytes
        last = self.first[1:] - 1
        inside = _ALL >> (U64(64) - U64(8) * (self.size % 8).astype(np.uint64)) % U64(64)
        inside[self.size % 8 == 0] = 0
        ends[last] &= inside
        points = _HIGH & ~follows
        points[last] &= inside
        self.ends, self.points = ends, points
        self.upto = np.concatenate(([0], np.cumsum(np.bitwise_count(ends), dtype=np.int64)))
        self.points_upto = np.concatenate(([0], np.cumsum(np.bitwise_count(points), dtype=np.int64)))

    def units(self) -> np.ndarray:
        return np.diff(self.upto[self.first])

    def after(self, k: np.ndarray) -> np.ndarray:
        """The number of bytes that the first ``k`` units of each text have."""
        base = self.upto[self.first[:-1]]
        word = np.searchsorted(self.upto, base + k, "left") - 1  # the first whose count reaches k
        word = np.maximum(word, 0)
        rank = (base + k - self.upto[word]).astype(np.uint64)
        sums = (self.ends[word] >> U64(7)) * _ONES  # byte i: how many ends bytes 0 to i have
        reached = (sums | _HIGH) - rank * _ONES & _HIGH
        byte = 8 - np.bitwise_count(reached).astype(np.int64)
        return np.where(k > 0, 8 * (word - self.first[:-1]) + byte + 1, 0)

    def chars(self, byte: np.ndarray) -> np.ndarray:
        """The number of code points in the first ``byte`` bytes of each text."""
        word = self.first[:-1] + byte // 8
        part = (byte % 8).astype(np.uint64)
        mask = np.where(part > 0, _ALL >> (U64(64) - U64(8) * part) % U64(64), U64(0))
        return self.points_upto[word] + np.bitwise_count(self.points[word] & mask) - self.points_upto[self.first[:-1]]


_FIM = T.StructType([T.StructField(n, t) for n, t in (("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()))])


def _arrange(batches: Iterator[pa.RecordBatch], plain_from: int, spm_below: int) -> Iterator[pa.RecordBatch]:
    marks = [np.frombuffer(m.encode(), np.uint8) for m in MARKERS]
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        h = [batch.column(f"h{i}").to_numpy() for i in range(1, 5)]
        marked = batch.column("marked").to_numpy(zero_copy_only=False)
        for a, b in chunks(offsets):
            own, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            words = Words(own, at)
            n = words.units()
            x, y = h[0][a:b] % (n + 1), h[1][a:b] % (n + 1)
            left, right = words.after(np.minimum(x, y)), words.after(np.maximum(x, y))
            plain = (words.size == 0) | marked[a:b] | (h[2][a:b] % 100 >= plain_from)
            spm = h[3][a:b] % 100 < spm_below
            start, size, end = at[:-1], words.size, words.size
            # pieces in the order of the output: marker, piece, marker, piece, marker, middle
            prefix, suffix, middle = (start, left), (start + right, end - right), (start + left, right - left)
            pick = lambda i, p, s, none: np.where(plain, none, np.where(spm, s[i], p[i]))
            pieces = [(pick(0, prefix, suffix, start), pick(1, prefix, suffix, size)), (pick(0, suffix, prefix, start), pick(1, suffix, prefix, 0)), (np.where(plain, start, middle[0]), np.where(plain, 0, middle[1]))]
            extra = np.where(plain, 0, 3)
            total = size + 3 * extra
            upto = np.concatenate(([0], np.cumsum(total)))
            out, place = np.empty(int(upto[-1]), np.uint8), upto[:-1].copy()
            mark_of = [np.where(spm, 1, 0), np.where(spm, 0, 1), np.full(b - a, 2)]
            for (begin, length), which in zip(pieces, mark_of):
                some = np.flatnonzero(~plain)
                out[place[some][:, None] + np.arange(3)] = np.stack(marks)[which[some]]
                place += extra
                out[ragged(place, length)] = own[ragged(begin, length)]
                place += length
            texts = pa.Array.from_buffers(pa.large_string(), b - a, [None, pa.py_buffer(upto), pa.py_buffer(out)]).cast(pa.string())
            before, upto_middle = words.chars(left), words.chars(right)
            forms = pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string())
            fim = pa.StructArray.from_arrays([pa.array(n), forms, pa.array(before, mask=plain), pa.array(upto_middle - before, mask=plain)], ["n", "form", "prefix_chars", "middle_chars"])
            yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), texts, fim], ["row", "text", "fim"])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_from: int = 90, spm_below: int = 20, told: str = "fim") -> DataFrame:
    """``docs`` with the transformed texts, and a column ``told``: struct<n, form, prefix_chars, middle_chars>.

    ``n`` counts units; ``form`` is plain also where the third part of the id's hash
    reaches ``plain_from`` percent, and spm where the fourth is below ``spm_below`` percent.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    parts = [F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    marked = reduce(or_, (F.contains("text", F.lit(m)) for m in MARKERS))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    own = docs.select(F.struct(*rest).alias("row"), text.alias("text"), digest.alias("digest")).select("row", "text", *parts, marked.alias("marked"))
    done = own.mapInArrow(partial(_arrange, plain_from=plain_from, spm_below=spm_below), T.StructType([own.schema["row"], T.StructField("text", T.StringType()), T.StructField("fim", _FIM)]))
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns], F.col("fim").alias(told))


def restored(output: Column, form: Column) -> Column:
    """The text that became ``output``."""
    part = F.split(output, "<[PSM]>", 4)
    at = lambda i: F.get(part, F.lit(i - 1))
    return F.when(form == "psm", F.concat(at(2), at(4), at(3))).when(form == "spm", F.concat(at(3), at(4), at(2))).otherwise(output)
