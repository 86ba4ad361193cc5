"""Results on larger tables: what ties, dense windows and long histories must not change."""

import json
from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from tickloom.functions.scalars import round6
from tickloom.operators import book, candles, l4
from tickloom.plans import market
from tickloom.sources import diffs, views


def events(spark, folder, rows):
    """A folder with a table of events: id, user, kind, value."""
    told = [(i, datetime(2024, 1, 1, 0, 0, i % 60), user, kind, value, '{"k":3}') for i, user, kind, value in rows]
    frame = spark.createDataFrame(told, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    frame.write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_spreads_of_quotes_and_levels_are_the_nearest_doubles(spark, tmp_path):
    d = events(spark, tmp_path, [(i, i, "x", 0.1 * (7 * i % 400)) for i in range(1, 400)])
    for r in views.quotes(spark, d).collect():
        assert r.ask_px == r.bid_px + (0.1, 0.2, 0.3)[r.arrival % 3]
    steps = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
    for b, q in zip(views.books(spark, d).orderBy("arrival").collect(), views.quotes(spark, d).orderBy("arrival").collect()):
        assert [x.px for x in b.bids] == [q.bid_px - s for s in steps]
        assert [x.px for x in b.asks] == ([] if b.arrival % 89 == 0 else [q.ask_px - (b.arrival % 97 == 0) + s for s in steps])


def test_six_places_of_any_double(spark):
    given = [1.2345678, -1.2345678, 0.0, 1.5e15, -1.4411518807585586e20, 9.3e12, None]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x double").orderBy("i").select(round6(F.col("x"))).collect()]
    assert got == [1.234568, -1.234568, 0.0, *[(x * 1e6 + 0.37) / 1e6 for x in given[3:5]], 9.3e12, None]


def test_metrics_of_a_book_whose_mid_is_next_to_nothing(spark):
    level = "array<struct<px:double,sz:double>>"
    b = spark.createDataFrame([("x", 0, 0, [(0.4, 1.0)], [(0.4 + 0.2 - 1.0, 2.0)])], f"symbol string, t_ms long, arrival long, bids {level}, asks {level}")
    assert book.metrics(b).select(round6(F.col("spread_bps"))).first()[0] < -1e20


def test_a_snapshot_in_parts_is_the_whole_one(spark):
    order = lambda oid, side: {"oid": oid, "side": side, "limit_px": "1", "sz": "2"}
    whole = {"coin": "X", "height": 5, "bids": [order(i, "B") for i in range(7)], "asks": [order(i, "A") for i in range(10, 15)]}
    cut = [(0, 3, 0, 1), (3, 3, 1, 4), (3, 7, 4, 5)]
    parts = [{"coin": "X", "height": 5, "part": 10 * k, "bids": whole["bids"][a:b], "asks": whole["asks"][c:e]} for k, (a, b, c, e) in enumerate(cut)]
    raw = lambda lines: spark.createDataFrame([(json.dumps(x),) for x in lines], "raw string")
    read = lambda frame: sorted(map(tuple, frame.collect()))
    assert read(diffs.snapshots(raw(parts[::-1]), parts=True)) == read(diffs.snapshots(raw([whole])))


def items(spark, folder, orders):
    rows = [(o, o * 7 + n, n, float(1 + (o + n) % 9), "ANR"[(o + n) % 3], "OF"[n % 2]) for o in range(orders) for n in range(1, 5)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_snapshot_lines_do_not_grow_with_the_book(spark, tmp_path, monkeypatch):
    d, seen = items(spark, tmp_path, 20_000), []
    whole = diffs.snapshots
    monkeypatch.setattr(diffs, "snapshots", lambda frame, *a, **k: seen.append(frame) or whole(frame, *a, **k))
    market.QUERIES["l4_snapshots"](spark, d)
    lines = seen[0].select(F.get_json_object("raw", "$.coin").alias("coin"), F.size(F.split("raw", "limit_px")).alias("n"))
    most, n = lines.agg(F.max("n"), F.count("*")).first()
    assert n > 3 and most <= 32_768 // 2 + 1  # of eight ids four are taken


def test_views_read_line_items_once(spark, tmp_path):
    d = items(spark, tmp_path, 30)
    got = {(r.oid, r.kind): (r.height, r.pos, r.sz, r.new_sz, r.orig_sz) for r in views.diffs(spark, d).collect()}
    oids = [8 * o + n for o in range(30) for n in range(1, 5)]
    assert set(got) == {(i, "new") for i in oids} | {(i, "update") for i in oids if i % 3 == 0} | {(i, "remove") for i in oids if i % 5 == 0}
    for (oid, kind), (height, pos, sz, new_sz, orig_sz) in got.items():
        later = {"new": 0, "update": 1, "remove": 2}[kind]
        assert (height, pos) == (oid // 8 + later, oid % 8 + 8 * later)
        assert (sz is not None, new_sz is not None, orig_sz is not None) == (kind == "new", kind == "update", kind == "update")
    assert views.diffs(spark, d)._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    heights = {h for h, *_ in got.values()}
    assert {r.height for r in views.blocks(spark, d).collect()} == {h for h in heights if h % 501}


def test_a_replay_from_a_snapshot_does_not_deal_diffs_by_coin(spark, tmp_path):
    d = items(spark, tmp_path, 30)
    diffs_ = views.diffs(spark, d)
    snapshot = diffs_.where("kind = 'new'").select("coin", "height", F.col("pos").alias("ordinal"), "oid", "side", "px", "sz").where("height < 9")
    plan = l4.with_snapshot(snapshot, diffs_)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan


def test_trailing_candles_of_dense_windows_in_any_order_of_arrival(spark):
    rng = np.random.default_rng(8)
    rows = [(s, int(t), int(a), float(p), float(z)) for s, n in (("A", 300), ("B", 70), ("C", 1)) for t, a, p, z in zip(rng.integers(-150, 400, n), rng.permutation(n), rng.integers(1, 50, n), rng.integers(0, 3, n))]
    got = {(r.symbol, r.arrival): tuple(r)[1:] for r in candles.trailing(spark.createDataFrame(rows, "symbol string, t_ms long, arrival long, price double, size double").repartition(5), 60).collect()}
    want = {}
    for s, t, a, *_ in rows:
        own = sorted((x[2], x[3], x[4]) for x in rows if x[0] == s and t - 60 <= x[1] < t and x[2] < a)
        if own:
            price, size = [x[1] for x in own], sum(x[2] for x in own)
            want[s, a] = (t, a, price[0], max(price), min(price), price[-1], size, len(own), sum(x[1] * x[2] for x in own) / size if size else price[-1])
    assert got == want


def test_trailing_candles_join_no_trade_with_its_window(spark):
    t = spark.createDataFrame([("A", 1, 1, 1.0, 1.0)], "symbol string, t_ms long, arrival long, price double, size double")
    plan = candles.trailing(t, 60)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "specifiedwindowframe(RangeFrame, -60" not in plan


def test_tops_of_a_history_with_a_long_silence(spark):
    rows = [("X", 1 << 30 if i == 9 else 3 * i, 0, i, "B", str(90 + i % 4), "new", "1", None) for i in range(10)]
    d = spark.createDataFrame(rows, "coin string, height long, pos long, oid long, side string, px string, kind string, sz string, new_sz string")
    tops = l4.block_tops(d)
    assert [r.bid_px for r in tops.orderBy("height").collect()] == ["90", "91", "92", *["93"] * 7]
