"""Results must be whole: passages against brute force where simple shortcuts lose some."""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tickloom.llm import passages
from tickloom.llm._bytes import buffers


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").select("doc_id", "text", F.col("lang"))


def verbatim(rows, words=50):
    """Documents that have ``words`` words in a row that another one has too."""
    at = {}
    for i, text in rows:
        w = text.split()
        for k in range(len(w) - words + 1):
            at.setdefault(tuple(w[k : k + words]), set()).add(i)
    return {i for ids in at.values() if len(ids) > 1 for i in ids}


def test_passages_of_frequent_lines(spark):
    """Three lines of 17 words in a row; many documents have the first two or the last two of them."""
    lines = lambda k, *which: " ".join(f"l{k}_{i}_{j}" for i in which for j in range(17))
    fill = lambda k, n: " ".join(f"f{k}_{i}" for i in range(n))
    rows = [(100 * k + n, f"{fill(100 * k + n, 30)} {lines(k, *which)} {fill(-100 * k - n, 40)}") for k in range(1, 11) for n, which in enumerate([(0, 1), (1, 2)] * 40 + [(0, 1, 2)] * 2)]
    want = verbatim(rows)
    assert want == {100 * k + n for k in range(1, 11) for n in (80, 81)}
    got = passages.near_passages(docs(spark, rows)).collect()
    assert {r.doc_id for r in got} == want
    assert all(r.start_word <= 30 and r.end_word >= 81 for r in got)


def test_hash_functions_reach_the_stated_recall():
    miss = lambda n, p=passages.USABLE: (1 - p) ** n + n * p * (1 - p) ** (n - 1)
    assert passages.HASHES >= 6 and miss(passages.HASHES) <= 1 - passages.RECALL


def test_windows_of_any_other_minimum_count(spark):
    rng = np.random.default_rng(8)
    rows = []
    for pair in range(300):
        for _ in range(rng.integers(1, 7)):
            low = int(rng.integers(0, 120))
            rows.append((pair, pair + 1000, int(rng.integers(0, 3)), low, low + 46 + int(rng.integers(0, 60))))
    want = {a[0] for a in rows for b in rows if a[0] == b[0] and a[2] != b[2] and min(a[4], b[4]) - max(a[3], b[3]) >= 46}
    met = spark.createDataFrame(rows, "x long, y long, at long, low int, high int")
    got = {r.x for r in passages.overlapping(met, 46).collect()}
    assert got == want and 0 < len(want) < 300


def test_near_copies_of_the_least_length(spark):
    """One word edited anywhere in a passage of 52 words."""
    rows = []
    for k in range(1, 401):
        words = [f"w{k}_{i}" for i in range(52)]
        rows.append((2 * k, " ".join([f"f{k}_{i}" for i in range(30)] + words + [f"g{k}_{i}" for i in range(20)])))
        words[12 + k % 28] = "edit"
        rows.append((2 * k + 1, " ".join([f"h{k}_{i}" for i in range(20)] + words + [f"e{k}_{i}" for i in range(30)])))
    got = {r.doc_id for r in passages.near_passages(docs(spark, rows)).collect()}
    assert len(got) >= 2 * 400 * passages.RECALL


def test_every_near_stretch_of_long_edited_copies_is_verified():
    """Against a scan of all stretches of 46 shingles: each that has a near copy touches a passage."""
    least, rng = 46, np.random.default_rng(23)
    some = 0
    for trial in range(12):
        size, base = 700, np.arange(1, 701, dtype=np.uint64) + np.uint64(10_000 * trial)
        x = base.copy()
        for at in np.arange(20, size - 10, int(rng.integers(22, 38))):  # an edited word each: five shingles
            x[at : at + 5] = rng.integers(1 << 40, 1 << 41, 5).astype(np.uint64)
        for at in (180, 400, 560):  # a run of edits that no share of 6/7 spans
            for k in range(0, 60, 12):
                x[at + k : at + k + 6] = rng.integers(1 << 40, 1 << 41, 6).astype(np.uint64)
        if trial % 3 == 0:  # the middle elsewhere
            x = np.concatenate((x[:250], x[450:], x[250:450]))
        covered = np.zeros(size, bool)
        got = passages.stretches(base, x, least, 75)
        for a, b, p, q, sim in got:
            assert b - a >= least and q - p >= least and sim >= 0.75
            common = len(np.intersect1d(base[a:b], x[p:q]))
            assert abs(common / (len(np.unique(base[a:b])) + len(np.unique(x[p:q])) - common) - sim) < 1e-9
            covered[a:b] = True
        for i in range(size - least + 1):
            own = base[i : i + least]
            hit = np.flatnonzero(np.isin(x, own))
            if not len(hit):
                continue
            p = max(0, min(int(hit[0]), len(x) - least))
            common = len(np.intersect1d(own, x[p : p + least]))
            if common >= 0.75 * (2 * least - common) and common >= passages.SHARE * least:
                some += 1
                assert covered[i : i + least].any(), (trial, i)
    assert some > 100


def test_no_link_is_lost_beside_others_that_hold_nearly_all_of_a_passage(spark):
    """20 pairs of 52 words with one word changed, beside 200 others that hold 40 to 49 of the words; then a ring of many edits of one text."""
    rng = np.random.default_rng(7)
    words = lambda name, n: [f"{name}_{i}" for i in range(n)]
    rows = []
    for p in range(20):
        whole = words(f"p{p}", 52)
        other = list(whole)
        other[int(rng.integers(6, 46))] = "edit"
        for k, own in ((2 * p, whole), (2 * p + 1, other)):
            rows.append((k, " ".join(words(f"a{k}", 30) + own + words(f"b{k}", 30))))
        for c in range(200):
            size = int(rng.integers(40, 50))
            at = int(rng.integers(0, 53 - size))
            rows.append((1000 + 1000 * p + c, " ".join(words(f"c{p}_{c}", 30) + whole[at : at + size] + words(f"d{p}_{c}", 30))))
    ring = words("ring", 60)
    for k in range(60):  # each has two words of its own and one in common with either neighbour
        own = list(ring)
        for j in (k, (k + 1) % 60):
            own[j] = f"other_{j}"
        rows.append((100_000 + k, " ".join(words(f"e{k}", 10) + own + words(f"g{k}", 10))))
    got = passages.near_passages(docs(spark, rows)).collect()
    found = {frozenset((r.doc_id, r.partner_id)) for r in got}
    assert {frozenset((2 * p, 2 * p + 1)) for p in range(20)} <= found
    of = {r.doc_id: r.class_id for r in got}
    assert all(of[2 * p] == of[2 * p + 1] == 2 * p for p in range(20))
    # against all pairs of the ring
    seq = {i: passages.shingles(*buffers(pa.array([t])))[0] & np.uint64((1 << 40) - 1) for i, t in rows if i >= 100_000}
    pairs = [(a, b) for a, b in combinations(seq, 2) if passages.stretches(seq[b], seq[a], 46, 75)]
    top = {i: i for p in pairs for i in p}
    for _ in top:
        for a, b in pairs:
            top[a] = top[b] = min(top[a], top[b])
    assert len(top) > 20 and {i: c for i, c in of.items() if i >= 100_000} == top


def test_crowds_compare_stretches_with_words_inserted(spark):
    """Eight pairs of a passage and its copy with three words inserted, of which all shingles are also in others that are no near copies."""
    rng = np.random.default_rng(8)
    fresh = lambda n: [f"u{v}" for v in rng.integers(0, 1 << 40, n)]
    rows = []
    for p in range(8):
        common = [f"c{p}_{k}" for k in range(150)]
        text = lambda *parts: " ".join(w for part in (fresh(30), *parts, fresh(30)) for w in part)
        places = [*range(5, 43), *range(62, 100)] * 2
        rows += [(10_000 + 1000 * p + k, text(common[a : a + 46])) for k, a in enumerate(places)]
        rows += [(2 * p, text(common[50:75], fresh(3), common[75:100])), (2 * p + 1, text(common[50:100]))]
    got = passages.near_passages(docs(spark, rows)).collect()
    assert {(r.doc_id, r.partner_id, r.class_id) for r in got} == {t for p in range(0, 16, 2) for t in ((p, p + 1, p), (p + 1, p, p))}


def test_different_shingles_of_stretches_are_counted():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        token = rng.integers(0, 9 + 3 * seed, 60 + seed).astype(np.uint64)
        own = token < 4 + seed
        got = passages._different(token, own, 46)
        assert got.tolist() == [len(set(token[i : i + 46][own[i : i + 46]].tolist())) for i in range(len(token) - 45)]
