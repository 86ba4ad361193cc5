"""Importance resampling, exact dedup and fill-in-middle against plain Python, on odd rows and at their edges."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import _shared, exact_dedup, fill_middle, importance
from tickloom.llm._bytes import in_table

DOCS = "doc_id long, text string, row string, fim string, digest string, size long, head long, h1 long, n_words long, score long, _at long"
rng = np.random.default_rng(11)
ALPHABET = list("abcXYZ") + [" ", "\n", "\t", "é", "日", "😀", "<P>", "0", "-", "\x00", " ", "<", "S", ">"]
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, " "), (5, "word"), (6, "WORD"), (7, "a b\n c"), (8, "a  b c"), (9, "a b c"), (9, "a b c"), (9, "other"), (None, "a b c"), (None, "only null"), (None, "only null"), (10, "x" * 8), (11, "x" * 7 + "é"),
    (12, "日本 é \x00 😀 <S> end"), (13, "<M>"), (14, "ab<" * 40), (15, "long " * 600_000), (16, "long  " * 600_000), (17, "q" * 70_000 + "1" + "z" * 70_001), (18, "long " * 599_999 + "last"),
] + [(100 + i, "".join(rng.choice(ALPHABET, int(n)))) for i, n in enumerate(rng.integers(0, 90, 300))]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "r", "f", "d", 1, 2, 3, 4, 5, 6) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD).repartition(5).cache()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_crc_of_spans_is_that_of_the_library():
    words = [bytes(rng.integers(0, 256, int(n)).astype(np.uint8)) for n in rng.integers(0, 40, 500)] + [b"x" * 3000]
    sizes = np.array([len(w) for w in words])
    got = importance.crc32_spans(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert got.tolist() == [zlib.crc32(w) for w in words]


def features(text, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)]


def brute_resample(rows, target, most, buckets, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own, other = Counter(), Counter()
    for side, texts in ((own, [t for _, t in rows]), (other, target)):
        for t in texts:
            side.update(map(bucket, features(t, most)[1]))
    s, t = sum(own.values()), sum(other.values())
    gain = lambda b: math.floor(1000 * math.log((other[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets))))
    out = []
    for i, text in rows:
        n, found = features(text, most)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(sha(f"7:{'' if i is None else i}")[:8], 16)
        out.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    ranked = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[2], x[3]))
    rank = Counter()
    drawn = {}
    for place, x in enumerate(ranked[: len(ranked) * percent // 100], 1):
        drawn.setdefault(x, []).append(place)
    for x in out:
        places = drawn.get(x, [])
        yield (*x, places[rank[x]] if rank[x] < len(places) else None)
        rank[x] += 1


@pytest.mark.parametrize("most,percent,least", [(2, 25, 20), (3, 50, 1), (1, 100, 0)])
def test_resample_is_that_of_brute_force(spark, odd, most, percent, least):
    target = ["the word a b c", None, "", "WORD word 日本", "long long"]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(odd, bench, most=most, buckets=500, percent=percent, least_words=least).collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(key, got)) == sorted(map(key, brute_resample(ODD, target, most, 500, percent, least)))


def test_ranks_over_many_partitions(spark):
    scored = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(30).cast("long").alias("n_words"), F.lit(1).cast("long").alias("n_features"), F.lit(0).cast("long").alias("weight"), (F.col("id") % 3).alias("score"))
    got = {r.doc_id: r.rank for r in importance.draw(scored, percent=40).collect()}
    order = sorted(range(5000), key=lambda i: (-(i % 3), i))
    assert got == {i: place if place <= 2000 else None for place, i in enumerate(order, 1)}


def test_resample_prefers_the_target(spark):
    rows = [(i, " ".join(f"{'good' if i % 4 == 0 else 'bad'}{j}" for j in range(30))) for i in range(400)]
    target = spark.createDataFrame([(" ".join(f"good{j}" for j in range(30)),)] * 2000, "text string")
    drawn = importance.resampled(docs(spark, rows), target).select("doc_id", "fim").collect()
    assert len(drawn) == 100 and sum(r.doc_id % 4 == 0 for r in drawn) > 95 and drawn[0].fim == "f"


def test_no_documents_and_no_target(spark, odd):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(docs(spark, []), none).count() == 0
    got = importance.resample(odd, none).where("n_words = 0").collect()
    assert all((r.n_features, r.weight, r["rank"]) == (0, 0, None) for r in got) and got


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    for i, t in rows:
        ids = groups[normal(t)]
        keep = min((x for x in ids if x is not None), default=None)
        yield i, keep, len(ids), i == keep, sha(normal(t))


@pytest.mark.parametrize("broadcast", [200_000, 1, 0])
def test_exact_groups_are_those_of_brute_force(spark, odd, broadcast, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_GROUPS", max(1, broadcast))
    if not broadcast:  # every group is hot
        monkeypatch.setattr(exact_dedup, "HOT_ROWS", 1)
    key = lambda r: str(tuple(r))
    got = exact_dedup.exact_groups(odd, prefix=4, digests=True).withColumn("digest", F.lower(F.hex("digest"))).collect()
    assert sorted(map(key, got)) == sorted(map(key, brute_groups(ODD)))


def test_only_surviving_groups_are_read_whole(spark):
    rows = [(1, "same"), (2, "same"), (3, "unlike in length"), (4, "abcd1"), (5, "abcd2"), (6, "zyxw3")]
    got = {r.doc_id: r for r in exact_dedup.exact_groups(docs(spark, rows), prefix=4).collect()}
    assert sorted(i for i, r in got.items() if r.digest is not None) == [1, 2, 4, 5]
    assert {i for i, r in got.items() if r.kept} == {1, 3, 4, 5, 6} and got[2].keep_id == 1


def test_exact_duplicates_go(spark, odd):
    left = exact_dedup.drop_exact_duplicates(odd)
    assert left.columns == odd.columns
    want = Counter((i, t) for (i, t), (_, _, _, kept, _) in zip(ODD, brute_groups(ODD)) if kept)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == want
    assert exact_dedup.exact_groups(docs(spark, [])).count() == 0


def test_bit_table_has_all_hashes(spark):
    hashes = rng.integers(-(1 << 63), 1 << 63, 20_000)
    table = _shared.bit_table(spark.createDataFrame([(int(h),) for h in hashes], "h long"), "h", len(hashes))
    assert in_table(table, hashes.view(np.uint64)).all()
    assert in_table(table, rng.integers(-(1 << 63), 1 << 63, 20_000).view(np.uint64)).mean() < 0.1
    assert not _shared.bit_table(spark.createDataFrame([], "h long"), "h", 0).any()


def brute_middle(i, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    d = sha(f"1:{'' if i is None else i}")
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text, text
    if h[3] % 100 < 20:
        return i, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return i, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def test_fill_in_middle_is_that_of_brute_force(spark, odd):
    done = fill_middle.fill_in_middle(odd, told="cut")
    assert done.columns == [*odd.columns, "cut"]
    got = done.select("doc_id", "cut.*", "text", fill_middle.restored(F.col("text"), F.col("cut.form")).alias("back")).collect()
    key = lambda r: sha(repr(tuple(r)))
    assert sorted(map(key, got)) == sorted(key(brute_middle(i, t)) for i, t in ODD)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs(spark, [])).count() == 0


def test_cuts_at_every_unit():
    texts = ["", "a", "ab1cd", "日本é😀 word", "x" * 16, "x" * 15 + "1", "1" * 8, "é" * 4 + "zz"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    words = fill_middle.Words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    units = [re.findall("[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    assert words.units().tolist() == [len(u) for u in units]
    for k in range(17):
        want = ["".join(u[:k]) for u in units]
        got = words.after(np.minimum(k, words.units()))
        assert got.tolist() == [len(w.encode()) for w in want] and words.chars(got).tolist() == [len(w) for w in want]
