"""Parsers, sinks and streams on small literal inputs."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tickloom.operators import blocks, candles, l4
from tickloom.sources import archive, diffs, frames, sinks
from tickloom.streaming import live


def raw(spark, *lines):
    return spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x), i) for i, x in enumerate(lines)], "raw string, ordinal long")


def lv(px, sz):
    return {"px": px, "sz": sz, "n": 1}


def test_frames(spark):
    f = raw(
        spark, {"channel": "l2Book", "data": {"coin": "BTC", "levels": [[lv("1", "2")], [lv("3", "4")]], "time": 7}}, {"channel": "l2Book", "data": {"coin": "BTC", "levels": [[], []]}}, {"channel": "l2Book", "data": {"coin": "DOGE", "levels": [[], []], "time": 1}},
        {"channel": "trades", "data": [{"coin": "BTC", "px": "1.5", "sz": "2", "side": "B", "time": 1, "tid": 9}, {"coin": "BTC", "px": "1.6", "sz": "1", "side": "A", "time": 2, "tid": 10}]}, {"channel": "allMids", "data": {"mids": {"BTC": "5", "XYZ": "6"}}},
        {"channel": "bbo", "data": {"coin": "BTC", "time": 3, "bbo": [lv("1", "2"), None]}}, {"channel": "activeAssetCtx", "data": {"coin": "BTC", "ctx": {"markPx": "50010", "oraclePx": "50000", "funding": True}}}, {"channel": "activeAssetCtx", "data": {"coin": "BTC", "ctx": {"funding": True}}}, {"channel": "user", "data": {"a": 1}}, "junk",
    )
    books = frames.level_books(f, ["BTC"], 99).orderBy("t_ms").collect()
    assert [(b.t_ms, len(b.bids)) for b in books] == [(7, 1), (99, 0)]
    assert [(t.price, t.size, t.tid) for t in frames.trades(f, ["BTC"]).collect()] == [(1.5, 2.0, 9), (1.6, 1.0, 10)]
    assert [(m.symbol, m.mid) for m in frames.mids(f, ["BTC"], 0).collect()] == [("BTC", 5.0)]
    row = frames.bbo(f, ["BTC"]).first()
    assert row.bid.px == "1" and row.ask is None
    (ctx,) = frames.contexts(f, ["BTC"], 0).collect()
    assert (ctx.basis, ctx.basis_bps, ctx.funding) == (10.0, 2.0, None)
    assert frames.user_events(f).count() == 1
    assert len(frames.subscriptions(["BTC"], bbo=True, user="u")) == 6


def test_archive_lines_of_all_shapes(spark):
    t = {"coin": "BTC", "px": "1", "sz": "2", "side": "A", "time": 5, "tid": 1}
    f = raw(spark, {"time": "x", "ver_num": 1, "raw": {"channel": "trades", "data": [t, t]}}, t, [t], "junk")
    assert frames.archive_trades(f).count() == 4
    b = {"coin": "BTC", "time": 5, "levels": [[lv("1", "2")], []]}
    assert frames.archive_books(raw(spark, {"raw": {"data": b}}, b)).count() == 2


def test_capture_loader_skips_junk(spark):
    ok = {"symbol": "BTC", "data_type": "bbo", "data": {"bid": lv("1", "2"), "ask": lv("2", "3"), "timestamp_ms": 4}}
    half = {"symbol": "BTC", "data_type": "bbo", "data": {"bid": lv("1", "2"), "ask": None, "timestamp_ms": 4}}
    level = {"symbol": "BTC", "data_type": "orderbook", "data": {"bids": [lv("1", "2")], "asks": [lv("2", "3")], "timestamp_ms": 5}}
    assert [r.t_ms for r in frames.capture_quotes(raw(spark, ok, half, level, "x")).orderBy("t_ms").collect()] == [4, 5]
    trade = lambda t: {"symbol": "BTC", "data_type": "trade", "data": {"price": "1", "size": 2, "side": "B", "timestamp_ms": t}}
    assert frames.capture_trades(raw(spark, trade(0), trade(3))).count() == 1


#: name: what the line says of order 1, and what is read: kind, size, new size, reason
CHANGES = {
    "placed": ({"raw_book_diff": {"new": {"sz": "0.50"}}}, ("new", "0.50", None, None)), "gone": ({"raw_book_diff": "remove"}, ("remove", None, None, None)),
    "resized": ({"rawBookDiff": {"update": {"origSz": "1", "newSz": "2"}}}, ("update", None, "2", None)), "snake": ({"raw_book_diff": {"update": {"orig_sz": "1", "new_sz": "3"}}}, ("update", None, "3", None)),
    "named": ({"raw_book_diff": {"new": {"sz": "abc"}}, "memo": 1}, ("new", "abc", None, None)), "strange": ({"raw_book_diff": {"odd": 1}}, (None, None, None, "unsupported diff")),
    "nulled": ({"raw_book_diff": None, "rawBookDiff": "remove"}, (None, None, None, "unsupported diff")), "unsized": ({"raw_book_diff": {"update": {"newSz": "2"}}}, (None, None, None, "unsupported diff")),
    "more": ({"raw_book_diff": {"new": {"sz": "1", "tif": "x"}}}, (None, None, None, "unsupported diff")), "both": ({"raw_book_diff": {"new": {"sz": "1"}, "odd": 1}}, (None, None, None, "unsupported diff")),
}


def line(name):
    return {"oid": 1, "coin": "BTC", "side": "B", "px": "100.0", **CHANGES[name][0]}


def test_diff_lines(spark):
    shapes = [
        {"time": 9, "height": 5, "data": {"order_statuses": [], "book_diffs": [line("gone"), line("resized"), {"oid": 3}]}}, {"time": 9, "height": 6, "data": {"book_diffs": []}}, {"time": 9, "height": 7, "book_diffs": [line("snake")]},
        {"time": 9, "height": 8}, {"time_ms": 9, "blockHeight": 9, "data": {"order_statuses": [1]}}, {"time": 9, "height": 10, "data": {"book_diffs": None}}, {"time": 9, "height": "x", "book_diffs": [line("gone")]},
        {"height": 11, "book_diffs": []}, {"time": 9, "height": 12, "order_statuses": []}, {"time": 9, "height": 13, "book_diffs": {"no": "list"}}, [1],
    ]
    bare = [n for n in CHANGES if n not in ("gone", "resized", "snake")]
    f = raw(spark, *(line(n) for n in bare), *shapes, "no json", "  ")
    got = [(r.height, r.kind, r.sz, r.new_sz, r.reason) for r in diffs.events(f).orderBy("ordinal", "pos").collect()]
    none, bad = (None,) * 4, lambda text: (None, None, None, None, text)
    want = [(None, *CHANGES[n][1]) for n in bare] + [(5, *CHANGES["gone"][1]), (5, *CHANGES["resized"][1]), (5, *none[:3], "missing coin,side,px"), (7, *CHANGES["snake"][1])]
    assert got == [*want, bad("unknown line"), *[bad("bad block")] * 3, bad("not an object"), bad("not an object")]
    assert [(r.height, r.time_ms, r.n_events) for r in diffs.blocks(f).orderBy("ordinal").collect()] == [(5, 9, 3), (6, 9, 0), (7, 9, 1), (9, 9, 0), (10, 9, 0), (12, 9, 0)]
    for odd in (line("named"), {"oid": 3}, line("strange"), {"time": 1, "height": 2, "book_diffs": [], "memo": 1}, {"time": 1, "height": 2}):
        with pytest.raises(Exception, match="unknown|missing|unsupported"):
            diffs.events(raw(spark, odd), strict=True).collect()
    assert {r.coin: (r.diffs, r.rejected) for r in diffs.counters(diffs.events(f)).collect()} == {"BTC": (5, 0), "": (0, 12)}


def test_bad_sizes_from_lines_are_bad_decimals(spark):
    got = diffs.events(raw(spark, {"time": 1, "height": 1, "book_diffs": [line("named")]}))
    assert [r.type for r in l4.anomaly_rows(got).collect()] == ["bad_decimal"]


def test_snapshot_keeps_queue_order(spark):
    s = {"coin": "BTC", "time": 1, "height": 100, "bids": [{"oid": 7, "side": "B", "limit_px": "1", "sz": "2.0"}], "asks": [{"oid": 3, "side": "A", "px": "2", "size": "1"}]}
    assert [(r.ordinal, r.oid, r.side, r.px, r.sz) for r in diffs.snapshots(raw(spark, s)).collect()] == [(0, 7, "B", "1", "2.0"), (1, 3, "A", "2", "1")]
    for lost, bad in (("height", {"coin": "BTC", "bids": [], "asks": []}), ("price", {**s, "asks": [{"oid": 3, "side": "A", "sz": "1"}]}), ("size", {**s, "asks": [{"oid": 3, "side": "A", "px": "1"}]})):
        with pytest.raises(Exception, match=f"without {lost}"):
            diffs.snapshots(raw(spark, bad)).collect()


def test_requests(spark):
    spans = spark.sql("select 'BTC' symbol, date'2024-01-31' first_day, date'2024-02-01' last_day")
    assert archive.requests(spans, ["trades", "asset_ctxs"]).count() == 2 * 24 + 2
    assert archive.requests(spans, ["asset_ctxs"]).orderBy("path").first().path == "asset_ctxs/20240131.csv.lz4"
    assert sorted(r.path for r in archive.requests(spans, ["node_fills"]).collect()) == ["node_fills_by_block/20240131/", "node_fills_by_block/20240201/"]
    with pytest.raises(ValueError, match="unknown data type"):
        archive.requests(spans, ["nope"])


def test_price_csv_is_utc(spark, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,open,high,low,close,volume\n1970-01-01 00:00:01,1,2,0.5,1.5,9\n")
    row = archive.check_bars(archive.price_csv(spark, str(tmp_path), "x")).first()
    assert (row.t_ms, row.close) == (1000, 1.5)
    with pytest.raises(ValueError, match="numeric close"):
        archive.check_bars(spark.sql("select 1 t_ms, 'x' close"))


def test_sinks(spark, tmp_path):
    points = spark.createDataFrame([("BTC", "trade", 86_400_000 + i, i, '{"a":1}', 5.0, 7) for i in range(5)], "symbol string, data_type string, t_ms long, arrival long, data string, recv_ts_ms double, recv_mono_ns long")
    calls = []

    def broken(df):
        calls.append(df.count())
        raise RuntimeError("down")

    sinks.fan_out(broken, sinks.jsonl(str(tmp_path / "j")), sinks.parquet(str(tmp_path / "p"), "symbol"))(points)
    assert calls == [5] and spark.read.parquet(str(tmp_path / "p")).count() == 5
    assert (tmp_path / "j/symbol=BTC/data_type=trade/date=1970-01-02").is_dir()
    with pytest.raises(RuntimeError):
        sinks.fan_out(broken)(points)
    assert json.loads(sinks.with_capture(points).first().data)["_capture"]["recv_mono_ns"] == 7
    assert sinks.capped(points, 2).count() == 2


def trade_rows(n):
    return [("BTC", 1_700_000_000_000 + 1000 * i, 100.0 + i % 7, 1.0 + i % 3, "B", i, i) for i in range(n)]


def test_streamed_candles_and_dedup_equal_the_batch(spark, tmp_path):
    src = spark.createDataFrame(trade_rows(300), live.TRADES)
    src.unionByName(src.limit(10)).repartition(3).write.json(str(tmp_path / "in"))
    stream = live.dedup(live.read(spark, str(tmp_path / "in"), live.TRADES)).drop("ts")
    live.write(stream, sinks.parquet(str(tmp_path / "out")), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300
    stream = live.candles(live.read(spark, str(tmp_path / "out"), live.TRADES, kind="parquet"), late="0 seconds")
    live.write(stream, lambda df: df.write.mode("overwrite").saveAsTable("candles_out"), str(tmp_path / "c2")).awaitTermination()
    want = {(r.start_ms, r.open, r.close, r.volume) for r in candles.tumbling(src, 60_000).collect()}
    got = {(r.start_ms, r.open, r.close, r.volume) for r in spark.table("candles_out").collect()}
    spark.sql("drop table candles_out")
    assert got <= want and len(got) >= len(want) - 1  # the last window is still open


def in_turns(spark, rows, schema, path, n):
    """``rows`` as ``n`` files, one batch each."""
    for k in range(n):
        spark.createDataFrame(rows[k * len(rows) // n : (k + 1) * len(rows) // n], schema).coalesce(1).write.mode("append").json(path)
        time.sleep(0.05)


def streamed(spark, tmp_path, stream, name):
    live.write(stream, sinks.parquet(str(tmp_path / f"{name}_out")), str(tmp_path / f"{name}_at")).awaitTermination()
    return spark.read.parquet(str(tmp_path / f"{name}_out"))


@pytest.mark.parametrize("n", [1, 5])
def test_streamed_trailing_candles_equal_the_batch(spark, tmp_path, n):
    rng = random.Random(n)
    rows = [("BTC" if i % 3 else "ETH", 1_700_000_000_000 + 1000 * i + rng.randint(-4000, 4000), 100.0 + i % 7, 1.0 + i % 3, "B", i, i) for i in range(120)]
    in_turns(spark, rows, live.TRADES, str(tmp_path / "t"), n)
    stream = live.trailing(live.read(live.stateful(spark), str(tmp_path / "t"), live.TRADES, files=1), 10_000)
    key = lambda rows: sorted((r.symbol, r.arrival, r.open, r.high, r.low, r.close, r.trades, round(r.vwap, 9)) for r in rows)
    assert key(streamed(spark, tmp_path, stream, "t").collect()) == key(candles.trailing(spark.createDataFrame(rows, live.TRADES), 10_000).collect())


def test_streamed_trailing_state_is_bounded(spark, tmp_path):
    """Entries that have left every window go, and all of a symbol's when it falls silent."""
    rows = [("BTC", 1_700_000_000_000 + 20_000 * i, 100.0, 1.0, "B", i, i) for i in range(40)]
    rows = [("OLD", *rows[0][1:]), *rows]
    in_turns(spark, rows, live.TRADES, str(tmp_path / "t"), 8)
    stream = live.trailing(live.read(live.stateful(spark), str(tmp_path / "t"), live.TRADES, files=1), 10_000, late="10 seconds")
    streamed(spark, tmp_path, stream, "t")
    spans = spark.read.format("statestore").option("stateVarName", "spans").load(str(tmp_path / "t_at"))
    left = spans.select("key.*").collect()
    assert {r[0] for r in left} == {"BTC"} and len(left) <= 3


FEED = "coin string, arrival long, height long, pos long, oid long, side string, px string, kind string, sz string, new_sz string, orig_sz string"


def feed_rows(seed):
    """Blocks with gaps and diffs of two coins with mixed texts."""
    rng, height, rows, seen = random.Random(seed), 10, [], []
    for arrival in range(80):
        height += rng.choice([1] * 20 + [0, 2])
        seen.append((arrival, height))
        for coin in "XY":
            for pos in range(rng.choice([0, 0, 1, 3])):
                oid, kind = rng.randint(1, 12), rng.choice(["new", "new", "update", "remove"])
                px = f"{rng.randint(90, 95) if oid % 2 else rng.randint(95, 99)}{rng.choice(['', '.0'])}"
                rows.append((coin, arrival, height, pos, oid, "B" if oid % 2 else "A", px, kind, rng.choice(["1", "2.0", "bad"]) if kind == "new" else None, rng.choice(["3", "0", "1.50"]) if kind == "update" else None, None))
    return rows, seen


@pytest.mark.parametrize("n", [1, 7])
def test_streamed_books_equal_the_batch(spark, tmp_path, n):
    rows, seen = feed_rows(n)
    cut = lambda x, k: [r for r in x if r[0 if x is seen else 1] * n // 80 == k]
    for k in range(n):
        spark.createDataFrame(cut(rows, k), FEED).coalesce(1).write.mode("append").json(str(tmp_path / "d"))
        spark.createDataFrame(cut(seen, k), live.BLOCKS).coalesce(1).write.mode("append").json(str(tmp_path / "b"))
        time.sleep(0.05)
    read = lambda name, schema: live.read(live.stateful(spark), str(tmp_path / name), schema, files=1)
    got = streamed(spark, tmp_path, live.book_tops(read("d", FEED), read("b", live.BLOCKS), ["X", "Y"]), "s")
    d, calendar = spark.createDataFrame(rows, FEED), blocks.calendar(spark.createDataFrame(seen, live.BLOCKS))
    want = l4.block_tops(d, calendar=calendar, clock="arrival")
    names = ["coin", "arrival", "n_diffs", "bid_px", "bid_sz", "ask_px", "ask_sz", "mid", "crossed", "stale"]
    key = lambda frame: sorted(map(str, frame.select(*names).collect()))
    assert key(got) == key(want) and {r.stale for r in got.collect()} == {True, False}
    orders = spark.read.format("statestore").option("stateVarName", "orders").load(str(tmp_path / "s_at"))
    assert orders.count() == l4.final_orders(d, "arrival").count()  # an entry per open order, none for those that went


def test_a_snapshot_resets_a_streamed_book(spark, tmp_path):
    new = lambda coin, at, h, oid, px: (coin, at, h, 1 + oid, oid, "B", px, "new", "1", None, None)
    rows = [new("X", 1, 1, 1, "101"), new("X", 2, 5, 2, "102"), ("X", 3, 8, 0, None, None, None, "reset", None, None, None), new("X", 3, 8, 9, "90.0"), new("X", 4, 9, 3, "91"), new("X", 5, 11, 4, "92"), ("X", 6, 12, 1, 1, "B", "101", "remove", None, None, None)]
    in_turns(spark, rows, FEED, str(tmp_path / "d"), 3)
    got = streamed(spark, tmp_path, live.book_tops(live.read(live.stateful(spark), str(tmp_path / "d"), FEED, files=1)), "s").orderBy("arrival").collect()
    assert [(r.arrival, r.bid_px, r.stale, r.anomalies) for r in got] == [(1, "101", False, 0), (2, "102", True, 1), (4, "91", False, 0), (5, "92", True, 1), (6, "92", True, 2)]
    with pytest.raises(ValueError, match="name them"):
        live.book_tops(spark.createDataFrame([], FEED), spark.createDataFrame([], live.BLOCKS))
