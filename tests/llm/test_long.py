"""Texts of more than one piece of work, repeated ids and clashing columns in the operators that cut texts up."""

import zlib

import numpy as np
import public_tokenizers
import pytest

from tickloom.llm import line_dedup, ngram_join, passages, perplexity, token_file, url_rules

WORDS = " ".join(f"w{i}" for i in range(700_000))  # more than every piece that an operator works on at once
LINES = "\n".join(f"line {i} of a very long text" for i in range(200_000))
SCHEMA = "doc_id long, text string, lang string, x string, y long, at long, bucket int, data string, a string, b string, half int, shard int, block long"


@pytest.fixture(scope="module")
def long(spark):
    assert len(WORDS) > max(passages.CHUNK, perplexity.PASS_BYTES, token_file.RANGE_BYTES // 16)
    rows = [(1, WORDS), (2, WORDS + " end"), (3, LINES), (4, LINES + "\nlast line of the longest text"), (5, LINES), (6, "short " * 60), (6, "another text of the same id"), (None, WORDS)]
    return spark.createDataFrame([(i, t, None if i in (2, 6) else "en", "x", 1, 2, 3, "d", "a", "b", 7, 8, 9) for i, t in rows], SCHEMA).repartition(3).cache()


def test_passages(long):
    got = passages.near_passages(long).collect()
    pairs = {frozenset((r.doc_id, r.partner_id)) for r in got}
    assert {r.doc_id for r in got} == {1, 2, 3, 4, 5} and all(p <= {1, 2} or p <= {3, 4, 5} for p in pairs)
    own = next(r for r in got if r.doc_id == 2)
    assert (own.start_word, own.end_word) == (0, 700_000)


def test_line_dedup(long):
    got = {(r.doc_id, len(r.text)): r.line_counts for r in line_dedup.drop_repeated_lines(long).collect()}
    assert got[3, 0] == (200_000, 200_000) and got[4, len("last line of the longest text")] == (200_001, 200_000) and got[5, len(LINES)] == (200_000, 0)
    assert got[1, len(WORDS)] == (1, 0) and got[None, len(WORDS)] == (1, 0)


def test_ngram_join(long):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(long).where("doc_id <> 6").collect())
    words = LINES.split()
    n = len(set(zip(*(words[k:] for k in range(5)))))
    assert [g for g in got if g[0] < 3] == [(1, 699_996, 1), (2, 699_997, 1)]
    assert [g[::2] for g in got if g[0] > 2] == [(3, 3), (4, 3), (5, 3)] and got[2][1] == n


def test_token_file(spark, long, tmp_path):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_file.write_token_blocks(long, tokenizer, str(tmp_path / "t"))
    got = {(r.doc_id, r.n_tokens): r.ids_crc32 for r in token_file.read_token_blocks(spark, str(tmp_path / "t")).collect()}
    lib = token_file.units(tokenizer).library
    for i, text in ((1, WORDS), (5, LINES)):
        ids = lib.encode(text, add_special_tokens=False).ids + [2]
        assert got[i, len(ids)] == zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("most", [1 << 30, 0])
def test_perplexity_of_long_texts_and_null_languages(long, most, monkeypatch):
    monkeypatch.setattr(perplexity, "SHARD_ENTRIES", 1000)
    monkeypatch.setattr(perplexity, "BLOCK_BYTES", 1 << 20)
    own = long.selectExpr("doc_id", "lang", "0 as half", "text")
    model = perplexity.fit(own.select("half", "text").unionByName(own.selectExpr("1 - half as half", "text")))
    got = {r.doc_id: r for r in perplexity.score(own.where("doc_id <> 6"), model, most).collect()}
    assert model.shards.count() > 1 and got[2].lang is None and got[1].n_words == 700_000
    assert all(r.nats > 0 for r in got.values()) and abs(got[1].nats - got[2].nats) < 1e-3 < abs(got[1].nats - got[3].nats)


def test_labels_of_repeated_ids_and_nulls(spark):
    pages = spark.createDataFrame([(i, f"http://h.example/{'bad' if i % 2 else 'fine'}/{i}") for i in range(60)] + [(None, "http://h.example/bad/x"), (7, None), (7, "http://h.example/fine/7")], "page_id long, url string")
    # of several labels of a page one that is bad suffices; nulls say nothing
    labels = spark.createDataFrame([(i, None, None) for i in range(60)] + [(i, 0 if i % 2 else 1, None) for i in range(60)] + [(i, 1, 0) for i in range(60)] + [(None, 0, 1)], "doc_id long, quality int, toxic int")
    got = sorted(((r.page_id, r.path), r.verdict) for r in url_rules.filter_urls(pages.where("page_id is not null and url is not null"), labels, rules=()).collect())
    assert all(v == ("block" if "/bad/" in p else "allow") for (_, p), v in got)
    got = url_rules.filter_urls(pages, labels, rules=())
    assert got.count() == 63 and {r.verdict for r in got.where("page_id is null").collect()} == {"block"}
