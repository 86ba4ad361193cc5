"""Every text operator on nulls, empty and odd texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import zlib
from statistics import NormalDist

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tickloom.llm import chat, decontaminate, langid, line_dedup, ngram_join, passages, perplexity, sentencepieces, token_file, url_rules

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, key long, n_words long, component string, row string, bucket string, label string, ids string"
WORDS = [f"w{i}" for i in range(400)]


def docs(spark, rows):
    """Documents with columns whose names clash with what operators use inside."""
    return spark.createDataFrame([(i, t, lang, "s", 0, 1, 2, "c", "r", "b", "l", "x") for i, t, lang in rows], DOCS)


ODD = [
    (1, None, "en"), (2, "", None), (3, "  \n\t ", "en"), (4, "x" * 5000, "en"), (5, " ".join(WORDS), "en"), (6, " ".join(WORDS), "en"), (6, " ".join(WORDS), "en"), (None, "a null id", "en"), (7, "日本 é \x00 　 <|endoftext|> ▁ end", None),
    (8, "#### 123 !!!", "en"), (9, "\n".join(["the same long line of text here"] * 4), "en"), (10, "the same long line of text here", "de"), (11, "The Same long line of TEXT here \n", "de"), (12, " ".join(WORDS * 60), "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD).cache()


def none(spark):
    return docs(spark, [])


BENCH = "item_id long, text string"


def bench(spark):
    return spark.createDataFrame([(1, " ".join(WORDS[50:80])), (2, "W3 w4"), (3, None), (4, ""), (None, "w1 w2"), (5, " ".join(WORDS[50:80]))], BENCH)


def test_decontaminate(spark, odd):
    got = {r.doc_id: r for r in decontaminate.decontaminate(odd, bench(spark)).collect()}
    assert len(got) == 13 and (got[1].n_words, got[1].n_hit, got[1].contaminated) == (0, 0, False)
    r = got[5]
    assert (r.n_words, r.n_hit, r.n_items, r.items, r.contaminated) == (400, 32, 3, ["1", "2", "5"], True)
    assert got[6] .n_hit == 32 and got[12].n_hit == 32 * 60
    assert r.items_sha256 == hashlib.sha256(b"1,2,5").hexdigest() and got[1].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert decontaminate.decontaminate(none(spark), bench(spark)).count() == 0
    assert not any(r.n_hit for r in decontaminate.decontaminate(odd, spark.createDataFrame([], BENCH)).collect())


def test_every_shared_span_is_found(spark):
    rng = np.random.default_rng(1)
    item = [f"i{i}" for i in range(40)]
    rows = []
    for k in range(60):  # the same 13 words at any place, and 12, which are too few
        at, n = int(rng.integers(0, 27)), 13 if k % 2 else 12
        rows.append((k, " ".join([f"a{k}{j}" for j in range(rng.integers(0, 9))] + item[at : at + n] + [f"z{k}{j}" for j in range(rng.integers(0, 9))]), "en"))
    got = {r.doc_id: r.n_hit for r in decontaminate.decontaminate(docs(spark, rows), spark.createDataFrame([(1, " ".join(item))], BENCH)).collect()}
    assert got == {k: 13 if k % 2 else 0 for k in range(60)}


def test_perplexity(spark, odd):
    rows = perplexity.quality(odd).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and got[1].base_failed and not got[1].kept and got[1].log_perplexity is None
    assert (got[9].n_dup_lines, got[9].n_words, got[9].n_repeat_words) == (3, 28, 28)
    assert (got[8].n_symbols, got[8].word_chars) == (4, 10) and got[12].base_failed and not got[5].base_failed
    assert perplexity.quality(none(spark)).count() == 0


def brute_perplexity(known, texts, order=perplexity.ORDER):
    """Mean negative log-probability of each text under that of ``known``: interpolated modified Kneser-Ney, from dictionaries."""
    from collections import Counter, defaultdict
    from math import log

    padded, own = (["\0" * (order - 1) + (t or "") for t in x] for x in (texts, known))
    counts = {order: Counter(t[i - order + 1 : i + 1] for t in own for i in range(order - 1, len(t)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut, total, spare = {}, defaultdict(float), defaultdict(float)
    for k, c in counts.items():
        n = [max(1, sum(v == i for v in c.values())) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        cut[k] = [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.1), 0.9 * (i + 1)) for i in range(3)]
        for g, v in c.items():
            total[k, g[:-1]] += v
            spare[k, g[:-1]] += min(v, cut[k][min(v, 3) - 1])

    def p(k, g):
        if not k:
            return 1 / (len(counts[1]) + 1)
        if (k, g[:-1]) not in total:
            return p(k - 1, g[1:])
        v = counts[k].get(g, 0)
        own = max(0, v - cut[k][min(v, 3) - 1]) if v else 0
        return own / total[k, g[:-1]] + spare[k, g[:-1]] / total[k, g[:-1]] * p(k - 1, g[1:])

    return [-sum(log(p(order, t[i - order + 1 : i + 1])) for i in range(order - 1, len(t))) / (len(t) - order + 1) if len(t) >= order else None for t in padded]


def test_perplexity_is_that_of_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdé 日😀\n"), int(n))) for n in rng.integers(1, 200, 60)] + ["", None, "a\0b" * 9, "abcd" * 50]
    half = [i % 2 for i in range(len(texts))]
    own = spark.createDataFrame([(i, "x", h, t) for i, (h, t) in enumerate(zip(half, texts))], "doc_id long, lang string, half int, text string")
    by = [brute_perplexity([t for t, h in zip(texts, half) if h != own_half], texts) for own_half in (0, 1)]
    want = {i: by[half[i]][i] for i in range(len(texts))}
    shards = perplexity.SHARD_ENTRIES
    try:
        for size in (shards, 100):
            perplexity.SHARD_ENTRIES = size
            model = perplexity.fit(own.select("half", "text"))
            assert model.shards.count() == model.n > (1 if size == 100 else 0)
            for most in (1 << 30, 0):  # broadcast, and sent for by blocks
                got = {r.doc_id: r.nats for r in perplexity.score(own, model, most).collect()}
                assert set(got) == set(want) and got[60] is None and got[61] is None
                assert all(abs(got[i] - want[i]) < 1e-4 for i in want if want[i] is not None), (size, most)
    finally:
        perplexity.SHARD_ENTRIES = shards


def test_bands_reject_text_unlike_its_language(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("aeiounrst"), int(n))) for n in rng.integers(2, 8, 300)]
    prose = [" ".join(rng.choice(words, 120)) for _ in range(200)]
    noise = [" ".join("".join(rng.choice(list("QXZJKWVYUPLMNBGHFD0123456789@^~"), 6)) for _ in range(100)) for _ in range(3)]
    rows = [(i, t, "xx") for i, t in enumerate(prose + noise)] + [(900 + i, t, None) for i, t in enumerate(prose[:9])]
    got = {r.doc_id: r for r in perplexity.quality(docs(spark, rows)).collect()}
    assert all(got[i].kept for i in range(200)) and all(got[900 + i].kept for i in range(9))
    assert all(not got[200 + i].kept and got[200 + i].log_perplexity > got[200 + i].upper for i in range(3))


def test_passages(spark, odd):
    shared, other = [f"p{i}" for i in range(60)], [f"q{i}" for i in range(45)]
    fill = lambda k, n: [f"f{k}_{i}" for i in range(n)]
    rows = [(k, " ".join(fill(k, 80) + shared + fill(-k, 70)), "en") for k in (101, 102, 103)]
    rows += [(104, " ".join(fill(104, 90) + other), "en"), (105, " ".join(other + fill(105, 90)), "en")]  # too short
    rows += [(106, " ".join(fill(106, 200)), "en"), (107, " ".join(fill(107, 30) + [f"n{w}" for w in WORDS[:120]]), "en"), (108, " ".join([f"n{w}" for w in WORDS[:60]] + ["edit"] + [f"n{w}" for w in WORDS[61:120]] + fill(108, 9)), "en")]
    got = passages.near_passages(docs(spark, rows)).collect()
    assert {r.doc_id for r in got} == {101, 102, 103, 107, 108}
    assert all((r.end_word - r.start_word) >= 50 and r.similarity >= 0.75 and r.doc_id != r.partner_id for r in got)
    assert {(r.start_word, r.end_word) for r in got if r.doc_id in (101, 102, 103)} == {(80, 140)}
    assert {r.doc_id for r in passages.near_passages(odd).collect()} >= {5, 6}
    assert passages.near_passages(none(spark)).count() == 0


def words_of(prefix, n):
    return [f"{prefix}{i}" for i in range(n)]


@pytest.mark.parametrize("rivals", [0, 2, 6, 40, 200])
@pytest.mark.parametrize("edited", ["no word", "the middle", "any word"])
def test_a_passage_is_found_however_many_others_hold_parts_of_it(spark, rivals, edited):
    rng = np.random.default_rng(rivals)
    rows = []
    for p in range(20):
        whole = words_of(f"p{p}_", 60)
        other = list(whole)
        if edited != "no word":
            other[30 if edited == "the middle" else int(rng.integers(0, 60))] = "edit"
        for c, own in enumerate((whole, other)):
            k = 2 * p + c
            rows.append((k, " ".join(words_of(f"a{k}_", int(rng.integers(20, 90))) + own + words_of(f"b{k}_", int(rng.integers(20, 90)))), "en"))
        for c in range(rivals):  # forty words of it, too few for a passage
            at = int(rng.integers(0, 21))
            rows.append((1000 + 1000 * p + c, " ".join(words_of(f"c{p}_{c}_", 30) + (whole, other)[c % 2][at : at + 40] + words_of(f"d{p}_{c}_", 30)), "en"))
    found = {frozenset((r.doc_id, r.partner_id)) for r in passages.near_passages(docs(spark, rows)).collect()}
    want = {frozenset((2 * p, 2 * p + 1)) for p in range(20)}
    assert found <= want and len(found) >= (20 if edited == "no word" else 18)


def test_short_edited_copies_are_found(spark):
    """Passages near the least length with one word changed: recall is a matter of hash functions."""
    rng = np.random.default_rng(8)
    rows = []
    for p in range(150):
        whole = words_of(f"p{p}_", 56)
        edited = list(whole)
        edited[int(rng.integers(6, 50))] = "edit"
        for k, own in ((2 * p, whole), (2 * p + 1, edited)):
            rows.append((k, " ".join(words_of(f"a{k}_", int(rng.integers(20, 60))) + own + words_of(f"b{k}_", int(rng.integers(20, 60)))), "en"))
    found = {frozenset((r.doc_id, r.partner_id)) for r in passages.near_passages(docs(spark, rows)).collect()}
    assert found <= {frozenset((2 * p, 2 * p + 1)) for p in range(150)} and len(found) >= 0.96 * 150


def test_passages_against_brute_force(spark):
    """All pairs of the smallest table: every document with a passage, and the links between documents."""
    from itertools import combinations

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect() if r.text]
    import pyarrow as pa
    from tickloom.llm._bytes import buffers

    seq = {}
    for i, t in rows:
        seq[i] = passages.shingles(*buffers(pa.array([t])))[0] & np.uint64((1 << 40) - 1)
    pairs = [(a, b) for a, b in combinations(seq, 2) if np.isin(seq[a], seq[b]).sum() >= 39 and passages.stretches(seq[b], seq[a], 46, 75)]
    assert len(pairs) > 20
    found = {(r.doc_id, r.partner_id) for r in passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    top = {i: i for i in seq}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in found:
        top[root(a)] = root(b)
    assert sum(root(a) == root(b) for a, b in pairs) >= 0.9 * len(pairs)
    assert len({i for p in pairs for i in p} - {a for a, _ in found}) <= 0.1 * len({i for p in pairs for i in p})


def test_compact_windows_cover_each_range_once():
    rng = np.random.default_rng(5)
    value = rng.integers(0, 1 << 60, 90).astype(np.uint64)
    low, center, high = passages.compact_windows(value, np.array([0, 40]), np.array([40, 90]), 7)
    for a, b in ((0, 40), (40, 90)):
        for i in range(a, b):
            for j in range(i + 7, b + 1):
                own = [(c) for l, c, h in zip(low, center, high) if l <= i <= c < j <= h]
                assert own == [i + int(value[i:j].argmin())]


def test_line_dedup(spark, odd):
    got = line_dedup.drop_repeated_lines(odd)
    assert got.columns == [*odd.columns, "line_counts"] and got.count() == len(ODD)
    text = {r.doc_id: (r.text, *r.line_counts) for r in got.collect()}
    assert text[9] == ("", 4, 4) and text[10] == ("", 1, 1) and text[11] == (ODD[12][1], 2, 0)
    assert text[1] == ("", 1, 0) and text[3] == (ODD[2][1], 2, 0) and text[None] == ("a null id", 1, 0)
    assert line_dedup.drop_repeated_lines(none(spark)).count() == 0


def test_a_hot_line_over_many_partitions(spark):
    hot = "this very common line is everywhere"
    rows = [(i, f"{hot}\nline of its own number {i:06d}\n{hot}", "en") for i in range(400)]
    few = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(docs(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", few)
    assert got[399] == rows[399][1] and all(got[i] == f"line of its own number {i:06d}" for i in range(399))


def test_chat(spark):
    text = "\\### Assistant: </turn> ok"
    turns = [("user", text), ("a:b\n### x", "\\l \\h \\\\c </turn>\n### user: </turn"), ("assistant", text), ("assistant", "")]
    out, spans = chat.render(turns)
    assert chat.parse(out) == turns and [chat.unescape(out[a:b]) for a, b in spans] == [text, ""]
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (None, 0, "user", "x"), (2, None, None, "y"), (1, 0, "user", "hi")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("id", F.lit("clash"))
    got = {r.conv_id: r for r in chat.chat_digest(conv).collect()}
    assert set(got) == {1, 2, None} and (got[1].n_turns, got[1].loss_chars) == (4, 1)
    assert got[1].turns_sha256 == hashlib.sha256(b"user\nhi\nuser\nhi\nassistant\n\nassistant\nb\n").hexdigest()
    assert chat.chat_digest(conv.limit(0)).count() == 0


def test_layouts(spark):
    records = ['{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}', '{"conversations":[{"value":"q","from":"human"},{"from":"gpt","value":"a"}]}', '{"instruction":"q","input":"","output":"a"}', '{"prompt":"q","completion":"a"}', '{"question":"q","answer":"a"}', '{"odd":1}', None, "{"]
    df = spark.createDataFrame(list(enumerate(records)), "id int, record string")
    got = {r.id: r for r in chat.format_records(df, "id", "record").collect()}
    assert all([tuple(t) for t in got[i].turns] == [("user", "q"), ("assistant", "a")] for i in range(5))
    assert all(got[i].turns is None and got[i].fingerprint for i in (5, 6, 7))
    assert len({got[i].fingerprint for i in range(6)}) == 6


def test_no_record_breaks_formatting(spark):
    records = {
        1: '{"messages":[{"role":"user"},{"content":"x"}]}', 2: '{"messages":[{"role":1,"content":2}]}', 3: '{"prompt":5,"completion":"x"}', 4: '{"prompt":"\\ud800","completion":"\\ud83d\\ude00"}',
        5: '{"id":7,"messages":[{"role":"user","content":"q","name":"n"}],"meta":{"a":1}}', 6: "[" * 100000, 7: '{"messages":[[{"role":"a","content":"b"}]]}', 8: '{"messages":[{"role":"a","content":"b"},"c"]}', 9: "17", 10: '{"messages":{}}',
        11: '{"messages":[]}', 12: '{"\\ud800":1}', 13: '"x"', 14: '{"messages":[{"role":["a"],"content":null}]}', 15: "1" * 9999, 16: '{"prompt":null,"completion":false}',
    }
    df = spark.createDataFrame(list(records.items()), "id int, record string")
    got = {r.id: r for r in chat.format_records(df, "id", "record").collect()}
    turns = {i: None if r.turns is None else [tuple(t) for t in r.turns] for i, r in got.items()}
    assert turns[1] == [("user", ""), ("", "x")] and turns[2] == [("1", "2")] and turns[3] == [("user", "5"), ("assistant", "x")]
    assert turns[4] == [("user", "\ufffd"), ("assistant", "\U0001f600")] and turns[5] == [("user", "q")] and turns[11] == []
    assert all(turns[i] is None for i in (6, 7, 8, 9, 10, 12, 13, 14, 15)) and turns[16] == [("user", ""), ("assistant", "false")]
    assert all(chat.parse(r.formatted) == turns[i] for i, r in got.items() if r.formatted is not None)
    own = chat.mapping(chat.Layout("talk", "who", "says"))
    talk = spark.createDataFrame([(1, '{"talk":[{"who":"a","says":"b"}]}'), (2, '{"prompt":"q","completion":"a"}')], "id int, record string")
    assert {r.id: r.turns for r in chat.format_records(talk, "id", "record", own).collect()} == {1: [("a", "b")], 2: None}


def test_conversations_pass_through_several_layouts(spark):
    roles = ["user", "assistant", "system", "human", "gpt", None]
    rows = [(i, t, roles[(i // 9 + t) % 6] if i % 9 == 0 else roles[t % 2], f"{i} {t}") for i in range(90) for t in range(3)]
    records = chat.conversation_records(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = chat.format_records(records, "conv_id", "record")
    assert got.select("fingerprint").distinct().count() == len(chat.LISTS)
    want = {i: [(r or "", t) for j, _, r, t in rows if j == i] for i in range(90)}
    assert {r.id: [tuple(t) for t in r.turns] for r in got.collect()} == want


def test_sentencepiece(spark, odd):
    sp = sentencepieces.vocabulary(PIECES).library
    got = sentencepieces.encode(odd, PIECES)
    want = sorted((sp.encode(t or ""), i if i is not None else -1) for i, t, _ in ODD)
    assert sorted((r.ids, r.doc_id if r.doc_id is not None else -1) for r in got.collect()) == want
    back = {r.doc_id: r.text for r in sentencepieces.decode(got, PIECES).collect()}
    assert all(back[i] == sp.decode(sp.encode(t or "")) for i, t, _ in ODD)
    d = {r.doc_id: r for r in sentencepieces.digests(odd, PIECES).collect()}
    assert d[1].n_tokens == 0 and d[1].ids_sha256 == hashlib.sha256(b"").hexdigest() == d[1].decoded_sha256
    assert sentencepieces.digests(none(spark), PIECES).count() == 0


def test_random_texts_encode_as_the_libraries_do():
    import pyarrow as pa

    rng = np.random.default_rng(11)
    letters = np.array(list("ab' ,1é\n\t日😀.the 　!s\x1c\x00\x85▁  ing"))
    texts = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(1500)] + ["ab" * 400, "don't we're\n\n x"]
    from tickloom.llm._bytes import buffers

    data, offsets = buffers(pa.array(texts))
    vocab, coder = sentencepieces.vocabulary(PIECES), token_file.units(BYTES)
    ids, counts = sentencepieces.encode_batch(vocab, data, offsets)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == vocab.library.encode(texts)
    assert [x.decode("utf-8", "replace") for x in sentencepieces.decode_batch(vocab, ids, counts)] == [vocab.library.decode(i) for i in vocab.library.encode(texts)]
    ids, counts = coder.encode(data, offsets)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in coder.library.encode_batch(texts, add_special_tokens=False)]


def test_language_id(spark, odd):
    model = langid.train(["the cat and the dog"] * 5 + ["der hund und die katze"] * 5, ["en"] * 5 + ["de"] * 5, steps=80)
    got = langid.predict(odd, model)
    assert got.columns == [*odd.columns, "lang_id"]
    said = {r.doc_id: r.lang_id for r in got.collect()}
    assert all(tuple(said[i]) == ("und", 0.0) for i in (1, 2, 3, 8)) and said[9].lang == "en" and 0 < said[9].score <= 1
    assert said[7].lang in ("en", "de")
    assert {r.lang_pred for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(none(spark)).count() == 0


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(2)
    model = langid.train(["ab cd"], ["a"], steps=1)
    model.languages, model.out, model.bias = ["a", "b"], rng.normal(size=(2 * langid.HIDDEN, 2)), np.zeros(2)
    model.inputs = [p.astype(np.float64) for p in model.inputs]
    model.recurrent = [p.astype(np.float64) for p in model.recurrent]
    x, y = rng.integers(97, 101, (3, 4)).astype(np.uint8), np.array([0, 1, 1])
    _, grads = langid.gradients(model, x, y)
    for p, g in zip(model.parameters(), grads):
        flat = int(np.abs(g).argmax())
        at = np.unravel_index(flat, p.shape)
        keep, step = p[at], 1e-2
        p[at] = keep + step
        up, _ = langid.gradients(model, x, y)
        p[at] = keep - step
        down, _ = langid.gradients(model, x, y)
        p[at] = keep
        assert abs((up - down) / (2 * step) - g[at]) < 2e-2 * max(1e-2, abs(g[at])) + 1e-4


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert got > 0.95


def brute_components(rows, k=5, percent=75):
    sets = {}
    for i, t, *_ in rows:
        w = [x for x in (t or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if x]
        sets.setdefault(i, set()).update({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    comp = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[a] and sets[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return {i: (len(s), comp[i]) for i, s in sets.items()}


def test_ngram_join(spark, odd):
    rows = [r for r in ODD if r[0] is not None]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(odd).collect()}
    assert got == brute_components(rows)
    assert ngram_join.ngram_components(none(spark)).count() == 0


def test_ngram_join_on_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(140):
        words = list(WORDS[:60]) if k < 120 else [f"u{k}_{i}" for i in range(60)]
        for at in rng.integers(0, 60, k % 4):
            words[at] = f"e{k}_{at}"
        rows.append((k, " ".join(words[: 60 - k % 7]), "en"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_varints():
    rng = np.random.default_rng(9)
    rows = [np.sort(rng.integers(0, 1 << int(rng.integers(1, 62)), int(rng.integers(0, 9)))).astype(np.uint64) for _ in range(200)]
    flat, sizes = ngram_join.varints(np.concatenate(rows), np.array([len(r) for r in rows]))
    ends = np.cumsum(sizes)
    got, counts = ngram_join.unvarints([flat[e - s : e].tobytes() for e, s in zip(ends, sizes)])
    assert got.tolist() == np.concatenate(rows).tolist() and counts.tolist() == [len(r) for r in rows]


def test_urls(spark):
    urls = ["http://Sub.Example.NET/en/a?x", "https://example.net/de/", "http://a.net", "x.net/", None, "http://example.com/de/x#y", "http://www.org/fr/", "http://notnet/", "ftp://q.example.com?z"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"tokens": F.lit(1), "host": F.lit("clash"), "label": F.lit(2)})
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.filter_urls(pages, labels).collect()}
    assert got == {
        0: ("sub.example.net", "/en/a", "example.net/en/", "allow"), 1: ("example.net", "/de/", "net/", "block"), 2: ("a.net", "", None, "allow"), 3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("example.com", "/de/x", "example.com/de/", "block"),
        6: ("www.org", "/fr/", "org/fr/", "allow"), 7: ("notnet", "/", None, "allow"), 8: ("q.example.com", "", None, "allow"),
    }
    assert url_rules.filter_urls(pages.limit(0), labels).count() == 0


def test_mined_rules_block(spark):
    rows = [(i, f"http://spam.example/{'win' if i % 2 else 'read'}/prize/{i}") for i in range(40)] + [(100 + i, f"http://good.example/read/{i}") for i in range(40)]
    pages = spark.createDataFrame([*rows, (900, "http://spam.example/win/prize/x"), (901, "http://good.example/read/y"), (902, "http://spam.example/other")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if 0 <= i < 40 and i % 2 else 1, None) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_rules.filter_urls(pages, labels, rules=()).collect()}
    assert got[900] == "block" and got[901] == "allow" and got[902] == "allow"
    assert all(got[i] == ("block" if i < 40 and i % 2 else "allow") for i, _ in rows)


def test_mined_rules_are_those_of_brute_force(spark):
    from itertools import combinations

    rng = np.random.default_rng(6)
    names = ["a", "b", "c", "d", "e", "f"]
    sets = [sorted({names[int(j)] for j in rng.integers(0, 6, 4)}) for _ in range(300)]
    bad = [bool(("a" in s and "b" in s and rng.random() < 0.9) or ("c" in s and rng.random() < 0.5) or rng.random() < 0.05) for s in sets]
    urls = spark.createDataFrame(list(enumerate(sets)), "id int, tokens array<string>")
    options = {"min_support": 0.01, "min_confidence": 0.5, "min_rows": 5, "min_lift": 1.2}
    got = {tuple(sorted(r.tokens)): (r.confidence, r.support, r.lift, r.head) for r in url_rules.mine(urls, spark.createDataFrame(list(enumerate(bad)), "id int, bad boolean"), **options).collect()}
    base, found = sum(bad) / 300, {}
    tried = sum(5 <= sum(set(need) <= set(s) for s in sets) for k in range(1, 7) for need in combinations(names, k))
    z = NormalDist().inv_cdf(1 - 0.025 / tried)
    for k in range(1, 7):
        for need in combinations(names, k):
            own = [b for s, b in zip(sets, bad) if set(need) <= set(s)]
            both, m = sum(own), len(own)
            if both < 5 or both / 300 < 0.01:
                continue
            c = both / m
            low = (c + z * z / (2 * m) - z * (c * (1 - c) / m + z * z / (4 * m * m)) ** 0.5) / (1 + z * z / m)
            if low > base and c >= 0.5 and c / base >= 1.2:
                found[need] = (c, both / 300, c / base)
    held = {t: sum(t in s for s in sets) for t in names}
    want = {n: f for n, f in found.items() if not any(found.get(tuple(x for x in n if x != out), (0,))[0] >= f[0] for out in n)}
    assert set(got) == set(want) and len(want) > 2
    for need, (c, support, lift, head) in got.items():
        assert np.allclose((c, support, lift), want[need]) and head == min(need, key=lambda t: (held[t], t))


def test_chance_makes_no_rules(spark):
    """Labels that have nothing to do with the urls: many combinations, none of which is a rule."""
    rng = np.random.default_rng(12)
    sets = [sorted({f"t{int(j)}" for j in rng.integers(0, 25, 5)}) for _ in range(1500)]
    urls = spark.createDataFrame(list(enumerate(sets)), "id int, tokens array<string>")
    bad = spark.createDataFrame([(i, bool(rng.random() < 0.26)) for i in range(1500)], "id int, bad boolean")
    assert url_rules.mine(urls, bad, min_confidence=0.4).count() == 0


def test_urls_of_any_column_name(spark):
    got = spark.createDataFrame([("http://A.b/c?d",)], "link string").select(*url_rules.host_and_path(F.col("link"))).first()
    assert tuple(got) == ("a.b", "/c")


def test_the_deciding_rule_is_told(spark):
    rows = [(i, f"http://spam.example/{'win' if i % 2 else 'read'}/prize/{i}") for i in range(60)]
    pages = spark.createDataFrame([*rows, (900, "http://x.net/win/prize"), (901, "http://spam.example/" + "win/" * 30_000)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1, None) for i, _ in rows] + [(5000, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_rules.filter_urls(pages, labels).collect()}
    assert (got[1].learned, got[1].verdict, got[1].confidence) == ("p:win", "block", 1.0) and abs(got[1].lift - 2) < 1e-9 and got[0].learned is None
    assert (got[900].rule, got[900].verdict, got[900].learned) == ("net/", "block", None) and got[901].learned == "p:win"


def test_token_file(spark, odd, tmp_path):
    lib = token_file.units(BYTES).library
    path = str(tmp_path / "blocks")
    token_file.write_token_blocks(odd, BYTES, path)
    got = token_file.read_token_blocks(spark, path).orderBy("start").collect()
    ids = sorted(((-1 if i is None else i), lib.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in ODD)
    at = 0
    for r, (i, x) in zip(got, ids, strict=True):
        assert (-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        at += len(x)
    token_file.write_token_blocks(none(spark), BYTES, str(tmp_path / "none"))
    assert token_file.read_token_blocks(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("top", [1, 200, 300, 70_000])
def test_blocks_round_trip(top):
    ids = np.random.default_rng(top).integers(0, top, 70_001).astype(np.uint32)
    docs_, lengths, back = token_file.read_block(token_file.write_block([None, 5], np.array([1, 70_000]), ids))
    assert docs_ == [None, 5] and lengths.tolist() == [1, 70_000] and np.array_equal(ids, back)
    empty = token_file.read_block(token_file.write_block([], np.array([], np.int64), np.array([], np.uint32)))
    assert empty[0] == [] and len(empty[2]) == 0
