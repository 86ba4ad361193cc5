"""N-gram Jaccard self-join by vertical partitioning.

Every document is the set of its distinct 5-word shingles.  The global order of shingles (rare
ones first) is cut into fragments; each fragment is worked on by itself and only counts or short
lists leave it:

1. ``cut``: each task splits its documents' shingle hashes into fragments by hash range.  A
   fragment counts, per document, the shingles it has there and those that another document has
   too.  Summed per document, a document that shares less than three quarters of its shingles
   with *anyone* can have no partner and is done.  That is exact, and removes most of a corpus.
2. Documents with equal sets become one class, kept by its smallest doc_id.
3. Prefixes: of two sets with Jaccard >= t, the first ``n - ceil(t n) + 1`` shingles in the global
   order meet.  Only prefixes are dealt out by shingle.
4. Rounds find links by as many candidates as there are classes: first each class is paired with one
   leader of its posting lists, then with its nearest neighbour of another component, by a bound on
   the symmetric difference (lengths, places, and parity bitmaps of the sets).  Linked components
   become one after each round, so a large group of near copies joins up without its pairs, and a
   class that the bounds let link with no other component is done.
5. Then all pairs of still different components whose prefixes meet, and which the bounds do not
   exclude, are candidates: the rounds save work, they decide nothing.
6. Candidates are verified exactly: sets are cut into fragments again, each fragment counts its
   partial overlap, and the counts are summed per pair.

A posting list is compared inside one task, the members outside its largest component with all: no
pair leaves the task that the bounds exclude.

Null, empty or blank texts have the empty set and no links.  Rows that share a doc_id are one
document with the union of their shingles; rows with a null doc_id are left out.  Texts count whole,
however long.  An empty table gives an empty one.  Columns other than the two named are ignored,
whatever their names.  Shingles are compared by 48 hash bits beside their fragment.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._bytes import U64, binaries, buffers, chunks, mix, ragged, row_of, shingle_sets, unvarints, varints
from ._shared import components, grouped, release, settle, shuffle_partitions

#: bytes of text whose shingles make one fragment; bounds the memory of a fragment's task
FRAGMENT_BYTES = 48 << 20
LOW = U64((1 << 48) - 1)
#: rounds at most; one that finds no link is the last
ROUNDS = 8
#: partial overlaps a pair is verified in
SEGMENTS = 4

_BLOCK = "bucket int, part int, ids binary, total binary, shared binary, tokens binary, levels binary"
_BLOCK_ARROW = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), *((c, pa.binary()) for c in ("ids", "total", "shared", "tokens", "levels"))])


def varint(values: np.ndarray) -> bytes:
    return varints(values, np.array([len(values)]))[0].tobytes()


def _pack(ids: np.ndarray) -> bytes:
    return np.diff(ids, prepend=0).astype(np.int64).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.int64))


def _bucket(ids: np.ndarray, n: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % U64(n)).astype(np.int64)


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_BLOCK_ARROW)], schema=_BLOCK_ARROW)


def _cut(batches: Iterator[pa.RecordBatch], n: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        batch = batch.filter(pc.is_valid(ids))
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy()
        data, offsets = buffers(batch.column(1))
        parts = [shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k) for a, b in chunks(offsets)]
        h, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        fragment = ((h >> U64(40)) * U64(n) >> U64(24)).astype(np.int32)
        order = np.argsort(fragment, kind="stable")
        rows, low = row_of(sizes)[order].astype(np.int32), (h & LOW)[order]
        edges = np.searchsorted(fragment[order], np.arange(n + 1))
        out = []
        for f in np.flatnonzero(np.diff(edges)):
            r, t = rows[edges[f] : edges[f + 1]], low[edges[f] : edges[f + 1]]
            count = np.bincount(r, minlength=len(ids))
            has = np.flatnonzero(count)
            out.append((int(f), -1, _pack(ids[has]), count[has].astype(np.uint32).tobytes(), None, t.view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), None))
        empty = ids[sizes == 0]
        own = _bucket(empty, n)
        out += [(n + int(b), -1, _pack(empty[own == b]), None, None, None, None) for b in np.unique(own)]
        yield _blocks(out)


def _fragment(table: pa.Table, n: int) -> pa.Table:
    """One fragment: how many shingles each document has in it, and which of them others have too."""
    f = table.column("bucket")[0].as_py()
    rows = table.select(["ids", "total", "tokens"]).to_pylist()
    ids = np.concatenate([_unpack(r["ids"]) for r in rows])
    if f >= n:
        zero = np.zeros(len(ids), np.uint32).tobytes()
        return pa.Table.from_batches([_blocks([(f - n, -1, _pack(ids), zero, zero, b"", b"")])])
    counts = np.concatenate([np.frombuffer(r["total"], np.uint32) for r in rows]).astype(np.int64)
    raw = np.frombuffer(b"".join(r["tokens"] for r in rows), np.uint8).reshape(-1, 6)
    del rows
    h = np.zeros((len(raw), 8), np.uint8)
    h[:, :6] = raw
    h = h.view(np.uint64).ravel()
    unique, code = np.unique(ids, return_inverse=True)
    doc = np.repeat(code.astype(np.int32), counts)
    order = np.argsort(h, kind="stable") if len(unique) == len(ids) else np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = h[1:] != h[:-1]
    if len(unique) < len(ids):  # rows with the same doc_id may repeat a shingle
        again = np.zeros(len(h), bool)
        again[1:] = ~fresh[1:] & (doc[1:] == doc[:-1])
        h, doc, fresh = h[~again], doc[~again], fresh[~again]
    start = np.flatnonzero(fresh)
    df = np.diff(start, append=len(h))
    total = np.bincount(doc, minlength=len(unique))
    common = np.flatnonzero(df > 1)
    common = common[np.argsort(df[common], kind="stable")]
    levels = np.searchsorted(df[common], 1 << np.arange(1, 41)).astype(np.uint32).tobytes()
    gid = np.repeat(np.arange(len(common), dtype=np.uint32), df[common])
    doc = doc[ragged(start[common], df[common])]
    shared = np.bincount(doc, minlength=len(unique))
    bucket = _bucket(unique, n)
    rank = np.argsort(bucket, kind="stable")
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    gid = gid[np.argsort(place[doc], kind="stable")]
    ends, ntok = np.searchsorted(bucket[rank], np.arange(n + 1)), np.concatenate(([0], np.cumsum(shared[rank])))
    out = []
    for b in np.flatnonzero(np.diff(ends)):
        own = rank[ends[b] : ends[b + 1]]
        out.append((int(b), f, _pack(unique[own]), total[own].astype(np.uint32).tobytes(), shared[own].astype(np.uint32).tobytes(), gid[ntok[ends[b]] : ntok[ends[b + 1]]].tobytes(), levels))
    return pa.Table.from_batches([_blocks(out)])


_SETS = "doc_id long, n long, sig binary, tokens binary, shared long"
_SETS_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("tokens", pa.binary()), ("shared", pa.int64())])


def _assemble(table: pa.Table, percent: int) -> pa.Table:
    """Sum the fragments' counts per document; keep the shared shingles of those that can link.

    A shingle's id is (log2 of its document count, fragment, number in the fragment): ascending
    ids are the global order.
    """
    rows = table.select(["part", "ids", "total", "shared", "tokens", "levels"]).to_pylist()
    each = [_unpack(r["ids"]) for r in rows]
    unique, code = np.unique(np.concatenate(each), return_inverse=True)
    n = np.bincount(code, np.concatenate([np.frombuffer(r["total"], np.uint32) for r in rows]), len(unique)).astype(np.int64)
    have = np.concatenate([np.frombuffer(r["shared"], np.uint32) for r in rows]).astype(np.int64)
    s = np.bincount(code, have, len(unique)).astype(np.int64)
    alive = (n > 0) & (100 * s >= percent * n)
    tokens, docs, at = [], [], 0
    for r, ids in zip(rows, each):
        count, own = have[at : at + len(ids)], code[at : at + len(ids)]
        at += len(ids)
        gid = np.frombuffer(r["tokens"], np.uint32).astype(np.uint64)
        keep = np.repeat(alive[own], count)
        if not keep.any():
            continue
        level = np.searchsorted(np.frombuffer(r["levels"], np.uint32), gid, "right").astype(np.uint64)
        tokens.append((level << U64(58) | U64(r["part"]) << U64(32) | gid)[keep])
        docs.append(np.repeat(own, count)[keep])
    blobs: list = [None] * len(unique)
    sigs: list = [None] * len(unique)
    if tokens:
        tokens, docs = np.concatenate(tokens), np.concatenate(docs)
        order = np.lexsort((tokens, docs))
        tokens, docs = tokens[order], docs[order]
        edges = np.searchsorted(docs, np.arange(len(unique) + 1))
        for i in np.flatnonzero(alive):
            own = tokens[edges[i] : edges[i + 1]]
            blobs[i] = varint(own)
            sigs[i] = blake2b(blobs[i], digest_size=16).digest() if s[i] == n[i] else int(unique[i]).to_bytes(8, "big", signed=True)
    return pa.Table.from_arrays([pa.array(unique), pa.array(n), pa.array(sigs, pa.binary()), pa.array(blobs, pa.binary()), pa.array(s)], schema=_SETS_ARROW)


_POST = "bucket int, tokens binary, code binary, place binary, doc binary, n binary, alone binary, label binary, maps binary"
_POST_KIND = {"tokens": np.uint64, "code": np.uint32, "place": np.uint32, "doc": np.int64, "n": np.uint32, "alone": np.uint32, "label": np.int64, "maps": np.uint64}
_POST_ARROW = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in _POST_KIND)])
#: words of the smallest and largest parity bitmap
NARROW, WIDE = 2, 64


def _width(n: np.ndarray) -> np.ndarray:
    """Words of a set's parity bitmap: two bits to a shingle or more, within bounds, a power of two."""
    return np.clip(1 << np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / 32))).astype(np.int64), NARROW, WIDE)


def parity_maps(token: np.ndarray, counts: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Bit b of a row says whether an odd number of its tokens fall on b; rows stand one after the other."""
    out = np.zeros(int(width.sum()), np.uint64)
    row = row_of(counts)
    bit = mix(token ^ U64(0x51ED270B7A3F9C15)) & (width[row].astype(np.uint64) * U64(64) - U64(1))
    np.bitwise_xor.at(out, (np.cumsum(width) - width)[row] + (bit >> U64(6)).astype(np.int64), U64(1) << (bit & U64(63)))
    return out


def _post(batches: Iterator[pa.RecordBatch], n: int, percent: int, maps: bool) -> Iterator[pa.RecordBatch]:
    """Prefixes of the sets, dealt out by shingle, beside the classes that have them."""
    for batch in batches:
        token, counts = unvarints(batch.column("tokens").to_pylist())
        doc, size, label = (batch.column(c).to_numpy() for c in ("doc_id", "n", "label"))
        alone = size - counts  # shingles of no other document come first in the order
        most = np.clip(size - (percent * size + 99) // 100 + 1 - alone, 0, counts)
        at = ragged(np.cumsum(counts) - counts, most)
        row = row_of(most)
        if not len(at):
            continue
        width = _width(size)
        flat, start = (parity_maps(token, counts, width), np.cumsum(width) - width) if maps else (np.empty(0, np.uint64), width)
        place = alone[row] + at - (np.cumsum(counts) - counts)[row]
        token = token[at]
        own = (mix(token.copy()) % U64(n)).astype(np.int64)
        order = np.argsort(own, kind="stable")
        edges = np.searchsorted(own[order], np.arange(n + 1))
        out = []
        for b in np.flatnonzero(np.diff(edges)):
            take = order[edges[b] : edges[b + 1]]
            have, code = np.unique(row[take], return_inverse=True)
            cols = {"tokens": token[take], "code": code, "place": place[take], "doc": doc[have], "n": size[have], "alone": alone[have], "label": label[have]}
            cols["maps"] = flat[ragged(start[have], width[have])] if maps else flat
            out.append((int(b), *(cols[c].astype(kind).tobytes() for c, kind in _POST_KIND.items())))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_POST_ARROW)], schema=_POST_ARROW)


class Postings:
    """The posting lists of one bucket, and the classes in them."""

    def __init__(self, table: pa.Table, seed: int = 0):
        cols = {c: [np.frombuffer(x, kind) for x in table.column(c).to_pylist()] for c, kind in _POST_KIND.items()}
        upto = np.cumsum([0] + [len(d) for d in cols["doc"]])
        code = np.concatenate([c.astype(np.int64) + u for c, u in zip(cols["code"], upto)])
        self.doc, self.n, self.alone, self.label, self.maps = (np.concatenate(cols[c]) for c in ("doc", "n", "alone", "label", "maps"))
        self.n, self.alone = self.n.astype(np.int64), self.alone.astype(np.int64)
        token, place = np.concatenate(cols["tokens"]), np.concatenate(cols["place"]).astype(np.int64)
        # members in the same pseudo-random order everywhere
        rank = mix(self.doc.astype(np.uint64) * U64(2) + U64(1) + (U64(seed) << U64(52)))
        order = np.lexsort((rank[code], token))
        token, self.code, self.place = token[order], code[order], place[order]
        self.start = np.flatnonzero(np.diff(token, prepend=token[:1] ^ U64(1)) != 0)
        self.length = np.diff(self.start, append=len(token))

    def tables(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By width: bitmaps of the classes of that width or twice as wide, folded, and each class's row."""
        width = _width(self.n)
        first = np.cumsum(width) - width
        out = {}
        for w in (1 << k for k in range(NARROW.bit_length() - 1, WIDE.bit_length())):
            own, twice = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
            maps = self.maps[first[own][:, None] + np.arange(w)]
            folded = self.maps[first[twice][:, None] + np.arange(w)] ^ self.maps[first[twice][:, None] + np.arange(w, 2 * w)]
            row = np.full(len(width), -1, np.int32)
            row[own], row[twice] = np.arange(len(own)), len(own) + np.arange(len(twice))
            out[w] = (np.concatenate((maps, folded)), row)
        self.width = width
        return out

    def possible(self, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Classes i and others j of other components that meet in a list and may link, with the least difference of each."""
        tables = self.tables()
        for s, m in zip(self.start[self.length > 1], self.length[self.length > 1]):
            code, place = self.code[s : s + m], self.place[s : s + m]
            label, n, alone, width = self.label[code], self.n[code], self.alone[code], self.width[code]
            names, times = np.unique(label, return_counts=True)
            if len(names) == 1:
                continue
            largest = label == names[times.argmax()]
            minor = np.flatnonzero(~largest)
            for i in minor:
                j = np.flatnonzero((label != label[i]) & (largest | (np.arange(m) > i)))
                both = n[j] + n[i]
                # the lists before this place are different, and what follows has to be enough
                fits = (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])) & ((100 + percent) * np.minimum(n[j] - place[j], n[i] - place[i]) >= percent * both)
                j, both = j[fits], both[fits]
                if not len(j):
                    continue
                differ = alone[j] + alone[i]
                for narrow in (False, True):
                    w = int(width[i]) >> narrow
                    take = np.flatnonzero((width[j] < width[i]) == narrow)
                    if len(take):
                        maps, row = tables[w]
                        differ[take] += np.bitwise_count(maps[row[code[j[take]]]] ^ maps[row[code[i]]]).sum(1, dtype=np.int64)
                fits = (100 + percent) * differ <= (100 - percent) * both
                if fits.any():
                    yield int(code[i]), code[j[fits]], differ[fits] / both[fits]


_STAR = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("c", pa.float64())])


def _star(table: pa.Table, percent: int) -> pa.Table:
    """Each member of a posting list with the list's leader, if they are not connected yet."""
    p = Postings(table)
    lead, own = np.repeat(p.code[p.start], p.length), p.code
    fits = (p.label[lead] != p.label[own]) & (100 * np.minimum(p.n[lead], p.n[own]) >= percent * np.maximum(p.n[lead], p.n[own]))
    pair, c = np.unique(np.stack((p.doc[lead][fits], p.doc[own][fits]), 1), axis=0, return_counts=True)
    return pa.Table.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(c.astype(float))], schema=_STAR)


def _nearest(table: pa.Table, percent: int) -> pa.Table:
    """Each class with the one of another component that its lists and the bounds put nearest."""
    p = Postings(table)
    near, far = np.full(len(p.doc), -1, np.int64), np.full(len(p.doc), np.inf)
    for i, j, differ in p.possible(percent):
        best = int(differ.argmin())
        if differ[best] < far[i]:
            far[i], near[i] = differ[best], j[best]
        less = differ < far[j]
        far[j[less]], near[j[less]] = differ[less], i
    have = np.flatnonzero(near >= 0)
    return pa.Table.from_arrays([pa.array(p.doc[near[have]]), pa.array(p.doc[have]), pa.array(-far[have])], schema=_STAR)


_PAIR = pa.schema([("x", pa.int64()), ("y", pa.int64())])


def _pairs(table: pa.Table, percent: int) -> pa.Table:
    """Pairs of different components that meet here and may link."""
    p = Postings(table)
    found, held = [np.empty((0, 2), np.int64)], 0
    for i, j, _ in p.possible(percent):
        found.append(np.stack((np.minimum(p.doc[j], p.doc[i]), np.maximum(p.doc[j], p.doc[i])), 1))
        held += len(j)
        if held > 1 << 20:
            found, held = [np.unique(np.concatenate(found), axis=0)], 0
    pair = np.unique(np.concatenate(found), axis=0)
    return pa.Table.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], schema=_PAIR)


_SEGMENT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("segment", pa.int32()), ("tokens", pa.binary())])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        token, counts = unvarints(batch.column("tokens").to_pylist())
        own = row_of(counts) * SEGMENTS + (mix(token >> U64(32)) % U64(SEGMENTS)).astype(np.int64)
        order = np.argsort(own, kind="stable")
        blobs = binaries(*varints(token[order], np.bincount(own, minlength=len(counts) * SEGMENTS)))
        each = lambda c: pa.array(np.repeat(batch.column(c).to_numpy(), SEGMENTS))  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays([each("doc_id"), each("n"), pa.array(np.tile(np.arange(SEGMENTS, dtype=np.int32), len(counts))), blobs], schema=_SEGMENT)


_OVERLAP = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("n", pa.int64()), ("common", pa.int64())])


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 2048):
            part = batch.slice(k, 2048)
            keys = []
            for c in ("a", "b"):
                token, counts = unvarints(part.column(c).to_pylist())
                rows = row_of(counts)
                keys.append((mix(token + rows.astype(np.uint64) * U64(0x9E3779B97F4A7C15)), rows))
            both = np.isin(keys[0][0], keys[1][0])
            common = np.bincount(keys[0][1][both], minlength=part.num_rows)
            n = part.column("nx").to_numpy() + part.column("ny").to_numpy()
            yield pa.RecordBatch.from_arrays([part.column("x"), part.column("y"), pa.array(n), pa.array(common.astype(np.int64))], schema=_OVERLAP)


def _verify(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Exact links among ``pairs``: partial overlaps of the fragments, summed per pair."""
    ys = segments.select(F.col("doc_id").alias("y"), F.col("n").alias("ny"), "segment", F.col("tokens").alias("b"))
    xs = segments.select(F.col("doc_id").alias("x"), F.col("n").alias("nx"), "segment", F.col("tokens").alias("a"))
    met = pairs.join(ys, "y").join(xs, ["x", "segment"])
    part = met.select("x", "y", "nx", "ny", "a", "b").mapInArrow(_overlap, "x long, y long, n long, common long")
    total = part.groupBy("x", "y", "n").agg(F.sum("common").alias("common"))
    return total.where(100 * F.col("common") >= percent * (F.col("n") - F.col("common"))).select("x", "y")


def _contract(labels: DataFrame, links: DataFrame, k: int) -> DataFrame:
    """Labels after those of linked classes have moved, two hops at most.

    In the round of leaders (0) a class's label goes over to its leader's, and leaders come first in
    one order; in later rounds the later one in a pseudo-random order goes over to the earlier one.
    """
    of = lambda c, label: labels.select(F.col("doc_id").alias(c), F.col("label").alias(label))
    pairs = links.join(of("x", "to"), "x").join(of("y", "from"), "y").where("from <> to")
    if k:
        place = lambda c: F.struct(F.xxhash64(c, F.lit(k)), F.col(c).alias("label"))
        pairs = pairs.select(F.greatest(place("from"), place("to"))["label"].alias("from"), F.least(place("from"), place("to"))["label"].alias("to"))
    move = pairs.groupBy("from").agg(F.min("to").alias("to"))
    on = move.select(F.col("from").alias("to"), F.col("to").alias("on"))
    move = move.join(on, "to", "left").select(F.col("from").alias("label"), F.coalesce("on", "to").alias("to"))
    out = settle(labels.join(move, "label", "left").select("doc_id", F.coalesce("to", "label").alias("label")))
    release(labels)
    return out


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``.

    Two documents link when ``100 * |A & B| >= percent * |A | B|``; ``component_id`` is the smallest
    doc_id that links reach.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # one range of hashes each; a lower bound keeps all cores busy
    n = max(shuffle_partitions(spark), size // FRAGMENT_BYTES, 1)
    cut = own.mapInArrow(partial(_cut, n=n, k=k), _BLOCK)
    kept = grouped(cut, "bucket", _fragment, _BLOCK, n=n)
    sets = settle(grouped(kept, "bucket", _assemble, _SETS, percent=percent), "lz4")
    able = sets.where(F.col("tokens").isNotNull())
    classes = able.groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    classes = settle(classes, "lz4")
    segments = settle(classes.select("doc_id", "n", "tokens").mapInArrow(_segments, "doc_id long, n long, segment int, tokens binary"), "lz4")

    def deal(open_: DataFrame, labels: DataFrame, each, schema: str, maps: bool) -> DataFrame:
        posts = open_.join(labels, "doc_id").mapInArrow(partial(_post, n=n, percent=percent, maps=maps), _POST)
        return grouped(posts, "bucket", each, schema, percent=percent)

    # documents with one label are connected; the rounds leave some connected ones with two
    spent: list[DataFrame] = []
    found: list[DataFrame] = []
    open_, labels = classes.select("doc_id", "n", "tokens"), classes.select("doc_id", F.col("doc_id").alias("label"))
    for k in range(ROUNDS):
        c = F.max("c") if k else F.sum("c")
        best = deal(open_, labels, _nearest if k else _star, "x long, y long, c double", maps=k > 0).groupBy("x", "y").agg(c.alias("c"))
        best = settle(best.groupBy("y").agg(F.max_by("x", F.struct("c", -F.col("x"))).alias("x")))
        if k:  # who can link with no other component now never will
            open_ = classes.select("doc_id", "n", "tokens").join(best.select(F.col("y").alias("doc_id")), "doc_id", "left_semi")
        pairs = best.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct() if k else best
        found.append(settle(_verify(pairs, segments, percent)))
        spent.append(best)
        if k and found[-1].isEmpty():
            break
        labels = _contract(labels, found[-1], k)
    rest = deal(open_, labels, _pairs, "x long, y long", maps=True).distinct()
    late = components(reduce(DataFrame.unionByName, [*found, _verify(rest, segments, percent)]))
    release(segments, labels, *spent, *found)
    # a component is named after its smallest class, and a class after the smallest doc_id of its copies
    member = able.select("doc_id", "sig").join(classes.select("sig", F.col("doc_id").alias("node")), "sig")
    member = member.join(late, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))
    return sets.select("doc_id", F.col("n").alias("n_shingles")).join(member, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
