"""Hand-computed cases of the market operators."""

import hashlib
import math
import random
from decimal import Decimal
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.operators import asof, backtest, blocks, book, candles, indicators, l4, latency, ofi, validate

TRADES = "symbol string, t_ms long, price double, size double, side string, arrival long"


def trades(spark, rows):
    return spark.createDataFrame([("x", t, p, s, "B", i) for i, (t, p, s) in enumerate(rows)], TRADES)


def test_trailing_candle_excludes_its_own_trade_and_later_arrivals(spark):
    t = trades(spark, [(0, 100.0, 1.0), (10, 110.0, 2.0), (20, 90.0, 1.0), (30, 105.0, 1.0), (5, 1.0, 1.0), (60, 0.5, 1.0)])
    got = {r.arrival: r for r in candles.trailing(t, 60).collect()}
    assert 0 not in got
    assert (got[3].open, got[3].high, got[3].low, got[3].close, got[3].trades) == (100, 110, 90, 90, 3)
    assert got[4].trades == 1  # the late trade sees only the one before it in time
    assert (got[5].open, got[5].close, got[5].trades) == (100, 1, 5)


def test_candle_values(spark):
    row = candles.tumbling(trades(spark, [(0, 100.0, 1.0), (1, 110.0, 2.0), (2, 90.0, 1.0), (3, 105.0, 1.0)]), 60_000).first()
    assert (row.open, row.high, row.low, row.close, row.volume, row.trades, row.vwap) == (100, 110, 90, 105, 5, 4, 103)


def test_candle_without_volume_takes_the_close(spark):
    assert candles.tumbling(trades(spark, [(0, 7.0, 0.0), (1, 8.0, 0.0)]), 10).first().vwap == 8


def test_anchored_candles_start_at_the_first_trade(spark):
    got = candles.anchored(trades(spark, [(7, 1.0, 1.0), (16, 2.0, 1.0), (17, 3.0, 1.0)]), 10).orderBy("end_ms").collect()
    assert [(r.end_ms, r.close) for r in got] == [(17, 2.0)]  # no bucket starts at the last trade
    got = candles.anchored(trades(spark, [(7, 1.0, 1.0), (17, 3.0, 1.0), (18, 4.0, 1.0)]), 10).orderBy("end_ms").collect()
    assert [(r.end_ms, r.close) for r in got] == [(17, 1.0), (27, 4.0)]


def closes(spark, values):
    return spark.createDataFrame([("x", i, float(v), 1.0) for i, v in enumerate(values)], "symbol string, start_ms long, close double, volume double")


def test_indicators(spark):
    row = indicators.indicators(closes(spark, range(100, 160))).orderBy(F.desc("start_ms")).first()
    assert (row.sma_10, row.rsi_14, row.price_change) == (154.5, 100, 1)
    row = indicators.indicators(closes(spark, range(1, 21))).first()
    assert row.bb_middle == 10.5 and math.isclose(row.bb_upper, 10.5 + 2 * math.sqrt(33.25))
    assert row.ema_50 is None


def test_ema_folds_from_the_oldest_close(spark):
    values = [3.0, 5.0, 4.0, 8.0] * 8
    a, e = 2 / 11, values[0]
    for v in values[1:]:
        e = v * a + e * (1 - a)
    row = indicators.indicators(closes(spark, values)).orderBy(F.desc("start_ms")).first()
    assert math.isclose(row.ema_10, e)


def test_both_rsi_definitions_on_a_flat_series(spark):
    frame = closes(spark, [5] * 20).withColumn("_d", F.lit(0.0))
    got = frame.select(indicators.rsi("close", 14, "start_ms").alias("a"), indicators.rsi("close", 14, "start_ms", True).alias("b")).collect()[-1]
    assert got.a == 100 and math.isnan(got.b)


BOOKS = "symbol string, t_ms long, arrival long, bids array<struct<px:double,sz:double>>, asks array<struct<px:double,sz:double>>"


def test_book_metrics(spark):
    rows = [("x", 0, 0, [(100.0, 6.0)], [(101.0, 2.0)]), ("x", 1, 1, [(100.0 - i, 500.0 if i == 9 else 1.0) for i in range(10)], [(101.0 + i, 1.0) for i in range(10)]), ("x", 2, 2, [(102.0, 1.0)], [(101.0, 1.0)]), ("x", 3, 3, [], [(1.0, 1.0)])]
    a, b, c = book.metrics(spark.createDataFrame(rows, BOOKS)).orderBy("arrival").collect()  # a one-sided book has no row
    assert (a.mid, a.spread, a.imbalance, a.bid_depth_5, a.ask_depth_5) == (100.5, 1, 0.5, 6, 2)
    assert b.imbalance > 0.9 and b.imbalance_5 == 0 and (b.bid_volume, b.bid_depth_5) == (509, 5)
    assert c.crossed
    assert book.sanitize(spark.createDataFrame(rows, BOOKS)).count() == 2


def test_findings(spark):
    t = trades(spark, [(0, 100.0, 1.0), (1, 120.0, 1.0), (2, 0.0, 0.0)])
    assert sorted(r.code for r in validate.trade_findings(t).collect()) == ["price_change", "price_change", "price_not_positive", "size_not_positive"]
    spike = trades(spark, [(i, 1.0, 1.0) for i in range(10)] + [(11, 1.0, 20.0)])
    assert [r.code for r in validate.trade_findings(spike).collect()] == ["volume_spike"]
    still = spark.createDataFrame([("x", i, 1.0, 0.0, "B", i) for i in range(3)] + [("x", 9, 1.0, 0.5, "B", 9)], TRADES)
    assert sorted((r.arrival, r.code) for r in validate.trade_findings(still).collect()) == [(0, "size_not_positive"), (1, "size_not_positive"), (2, "size_not_positive"), (9, "volume_spike")]
    books = spark.createDataFrame([("x", 0, 0, [(102.0, 1.0)], [(101.0, 1.0)]), ("x", 1, 1, [(100.0, 1.0)], [(106.0, 1.0)]), ("x", 2, 2, [(1.0, 1.0), (2.0, 1.0)], [])], BOOKS)
    assert sorted((r.arrival, r.code, r.level) for r in validate.book_findings(books).collect()) == [(0, "crossed", "CRITICAL"), (1, "wide_spread", "WARNING"), (2, "bids_unsorted", "ERROR"), (2, "empty_asks", "ERROR")]
    assert validate.drop_critical(books, validate.book_findings(books)).count() == 2
    assert [r.arrival for r in validate.checked_books(books).collect()] == [1]
    assert validate.checked_trades(t.withColumn("recv_ts_ms", F.lit(5))).select("arrival", "side", "recv_ts_ms").collect() == [(0, "buy", 5), (1, "buy", 5)]


def test_payloads(spark):
    rows = [(0, "trade", None), (1, "trade", " {} "), (2, "trade", '{"price":"1.5","size":2}'), (3, "trade", '{"price":[1]}'), (4, "bbo", "nonsense"), (5, None, '{"a":1}')]
    points = spark.createDataFrame([("x", i, i, k, d) for i, k, d in rows], "symbol string, t_ms long, arrival long, data_type string, data string")
    got = sorted((r.arrival, r.code, r.level) for r in validate.structure_findings(points).collect())
    assert got == [(0, "missing_data", "ERROR"), (1, "missing_data", "ERROR"), (3, "validation_error", "CRITICAL"), (4, "validation_error", "CRITICAL"), (5, "missing_data_type", "ERROR")]


def test_quality_figures(spark):
    levels = ["ERROR"] * 2 + ["WARNING"] * 3 + ["CRITICAL"] * 5
    found = spark.createDataFrame([("x", "volume_spike" if v == "WARNING" else "e", v) for v in levels] + [("y", "duplicate", "WARNING")], "symbol string, code string, level string")
    x, y, total = validate.report(found).orderBy(F.col("symbol").asc_nulls_last()).collect()
    assert (x.findings, x.errors, x.warnings, x.criticals, x.spikes) == (10, 2, 3, 5, 3)
    assert math.isclose(x.completeness, 0.8) and math.isclose(x.accuracy, 0.65)
    assert (y.completeness, y.accuracy, y.duplicates) == (1, 0.5, 1) and (total.symbol, total.findings) == (None, 11)


def test_rows_windows_do_not_depend_on_how_a_symbol_is_cut(spark):
    t = trades(spark, [(i * 1000, 100.0 + i % 13, 1.0 + i % 5) for i in range(700)])
    key = lambda rows: sorted((r.arrival, r.x) for r in rows)
    from pyspark.sql.window import Window

    whole = Window.partitionBy("symbol").orderBy("arrival").rowsBetween(-9, 0)
    want = key(t.withColumn("x", F.sum("price").over(whole)).collect())
    cut = asof.chunked(t, ["symbol"], ["arrival"], 9, 40)
    got = cut.withColumn("x", F.sum("price").over(Window.partitionBy("symbol", "_b").orderBy("_pos").rowsBetween(-9, 0))).where("not _halo")
    assert key(got.collect()) == want and cut.select("_b").distinct().count() > 9
    assert sorted(r._pos for r in asof.numbered(t, ["symbol"], ["t_ms", "arrival"], 7000).collect()) == list(range(700))
    assert [r.arrival for r in asof.newest(t, ["symbol"], ["t_ms", "arrival"], 5).orderBy("_rank").collect()] == [699, 698, 697, 696, 695]


def test_tape_is_in_order(spark):
    t = trades(spark, [(5, 1.0, 1.0), (3, 1.0, 1.0)])
    books = spark.createDataFrame([("x", 3, 0, [(1.0, 1.0)], [(2.0, 1.0)]), ("x", 5, 1, [(1.0, 1.0)], [(2.0, 1.0)])], BOOKS)
    got = [(r.t_ms, r.rank, r.place) for r in asof.merge_events(t, books).collect()]
    assert got == [(3, 0, 0), (3, 1, 1), (5, 0, 2), (5, 1, 3)]


def test_times(spark):
    p = trades(spark, [(1000, 1.0, 1.0), (1050, 1.0, 1.0), (500_000, 1.0, 1.0)]).withColumn("data_type", F.lit("trade"))
    got = sorted((r.arrival, r.code) for r in validate.time_findings(p, 400_000).collect())
    assert got == [(0, "stale"), (1, "duplicate"), (1, "stale"), (2, "future")]


def test_gap_end_is_recovered_and_its_start_is_not(spark):
    live = trades(spark, [(0, 1.0, 1.0), (300_000, 1.0, 1.0)])
    archive = trades(spark, [(0, 1.0, 1.0), (1, 2.0, 1.0), (300_000, 3.0, 1.0), (300_001, 4.0, 1.0), (2, float("nan"), 1.0)])
    gap = validate.gaps(live, 60_000)
    assert [r.price for r in validate.recovered(gap, archive).orderBy("t_ms").collect()] == [2.0, 3.0]


QUOTES = "symbol string, t_ms long, arrival long, bid_px double, bid_sz double, ask_px double, ask_sz double"


def test_ofi_counts_unchanged_prices_on_both_sides(spark):
    q = spark.createDataFrame([("x", 0, 0, 10.0, 5.0, 11.0, 4.0), ("x", 100, 1, 10.0, 7.0, 11.0, 3.0), ("x", 200, 2, 9.0, 2.0, 11.0, 3.0)], QUOTES)
    assert [(r.t_ms, r.e) for r in ofi.contributions(q).orderBy("t_ms").collect()] == [(100, 7 - 5 - 3 + 4), (200, -7 - 3 + 3)]


def triples(spark, rows):
    return spark.createDataFrame([("x", i, float(a), float(b), 100.0) for i, (a, b) in enumerate(rows)], "symbol string, start_ms long, ofi double, change double, mid double")


def test_regression(spark):
    row = ofi.regression(triples(spark, [(0, 0), (1, 1), (2, 0), (3, 1)]), 1).first()
    assert math.isclose(row.slope, 0.2) and math.isclose(row.r, 1 / math.sqrt(5))
    assert math.isclose(row.t_stat, (1 / math.sqrt(5)) * math.sqrt(2 / 0.8)) and math.isclose(row.t_hac, 0.2 / math.sqrt(0.0108))
    row = ofi.regression(triples(spark, [(i, 2 * i + 1) for i in range(10)]), 1).first()
    assert math.isclose(row.slope, 2) and row.t_stat == math.inf
    row = ofi.regression(triples(spark, [(1, 2), (1, 3), (1, 4)]), 1).first()
    assert row.slope is None and row.t_hac is None
    row = ofi.regression(triples(spark, [(1, 2), (2, 2), (3, 2)]), 1).first()
    assert row.slope == 0 and row.r is None
    assert ofi.regression(triples(spark, [(1, 2), (2, 3)]), 1).first().slope is None


def test_deciles_are_floor_slices(spark):
    assert {r.decile: r.n for r in ofi.deciles(triples(spark, [(i, i) for i in range(40)])).collect()} == {k: 4 for k in range(1, 11)}
    got = {r.decile: r.n for r in ofi.deciles(triples(spark, [(i, i) for i in range(13)])).collect()}
    assert got == {b + 1: (b + 1) * 13 // 10 - b * 13 // 10 for b in range(10)}
    assert ofi.monotone(ofi.deciles(triples(spark, [(i, i) for i in range(40)]))).first().monotone_fraction == 1
    assert len(ofi.deciles(triples(spark, [(1, 1), (2, 2)])).collect()) == 2


def test_asof_takes_the_last_of_a_tie(spark):
    left = spark.createDataFrame([("x", 5, 1), ("x", 0, 2)], "symbol string, t_ms long, arrival long")
    right = spark.createDataFrame([("x", 5, 1, 1.0), ("x", 5, 2, 2.0), ("x", 6, 3, 3.0)], "symbol string, t_ms long, arrival long, v double")
    assert {r.arrival: r.v for r in asof.asof(left, right, ["v"]).collect()} == {1: 2.0, 2: None}
    assert {r.arrival: r.v for r in asof.asof(left, right, ["v"], strict=True).collect()} == {1: None, 2: None}


def test_latency(spark):
    d = spark.createDataFrame([("x", float(v)) for v in [50] * 98 + [500, 2000]], "symbol string, delta_ms double")
    got = {r.q: r.value_ms for r in latency.percentiles(latency.histogram(d, (10, 100, 1000)), (0.5, 0.99, 1.0)).collect()}
    assert got == {0.5: 100, 0.99: 1000, 1.0: 2000}
    assert latency.BOUNDS == (1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000, 10000)
    row = latency.summary(spark.createDataFrame([("x", 100.0), ("x", 200.0)], d.schema), 50).first()
    assert (row.raw.p50_ms, row.adjusted.p50_ms, row.adjusted.max_ms) == (100, 150, 250)
    row = latency.summary(spark.createDataFrame([("x", float(v)) for v in range(-3, 97)] + [("x", 1 / 3)], d.schema)).first()
    assert (row["count"], row.negative_count, row.raw.p1_ms, row.raw.p90_ms, row.adjusted) == (101, 3, -2, 86, None)
    assert row.raw.mean_ms == round((sum(range(-3, 97)) + 1 / 3) / 101, 3)
    shot = latency.snapshot(latency.histogram(d)).first()
    assert (shot["count"], shot.mean_ms, shot.p50_ms, shot.p99_ms, shot.max_ms, shot.negative_count) == (100, 74, 50, 500, 2000, 0)
    low = latency.histogram(spark.createDataFrame([("x", -5.0)], d.schema)).first()
    assert (low.negatives, low.total_ms, low.bucket) == (1, 0, 0)


def bars(spark, values, signals=None, day=86_400_000):
    rows = [("x", i * day, float(v), float(signals[i]) if signals else 1.0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, t_ms long, close double, signal double")


def test_backtest(spark):
    held = lambda b: b
    end = backtest.run(bars(spark, [100, 110, 121]), held, 0).orderBy(F.desc("t_ms")).first()
    assert math.isclose(end.equity, 12_100)
    turn = backtest.run(bars(spark, [100] * 5, [1, 1, -1, -1, -1]), held, 100)
    assert math.isclose(turn.where("t_ms = 3 * 86400000").first().net, -0.02)
    assert [r.direction for r in backtest.trades(turn).orderBy("entry_ms").collect()] == [1, -1]
    ruin = backtest.run(bars(spark, [100, 250, 100], [-1, -1, -1]), held, 0).orderBy(F.desc("t_ms")).first()
    assert ruin.equity == 0
    m = backtest.metrics(backtest.run(bars(spark, [100, 120, 90, 100]), held, 0)).first()
    assert math.isclose(m.max_drawdown, -0.25) and math.isnan(m.cagr)
    with pytest.raises(ValueError):
        backtest.run(bars(spark, [1]), held, -1)


def test_clean_signal(spark):
    df = spark.createDataFrame([(None,), (5.0,), (-9.0,), (1e-12,), (float("nan"),), (0.5,)], "s double")
    assert [r[0] for r in df.select(backtest.clean_signal(F.col("s"))).collect()] == [0, 1, -1, 0, 0, 0.5]


DIFFS = "coin string, height long, pos long, oid long, side string, px string, kind string, sz string, new_sz string, orig_sz string"


def diff_rows(spark, rows, coin="X"):
    return spark.createDataFrame([(coin, h, i, *r, *[None] * (7 - len(r))) for i, (h, *r) in enumerate(rows)], DIFFS)


class PlainBook:
    """A book kept by hand, one diff at a time."""

    def __init__(self):
        self.orders, self.levels = {}, {"B": {}, "A": {}}

    def leave(self, oid):
        side, px, _ = self.orders.pop(oid)
        self.levels[side][px][1].remove(oid)
        if not self.levels[side][px][1]:
            del self.levels[side][px]

    def apply(self, oid, side, px, kind, sz=None, new_sz=None, orig_sz=None):
        if kind == "new":
            if oid in self.orders:
                self.leave(oid)
            self.orders[oid] = [side, Decimal(px), sz]
            self.levels[side].setdefault(Decimal(px), (px, []))[1].append(oid)
        elif oid in self.orders and kind == "update" and Decimal(new_sz) > 0:
            self.orders[oid][2] = new_sz
        elif oid in self.orders:
            self.leave(oid)

    def total(self, side, px):
        return float(sum(Decimal(self.orders[o][2]) for o in self.levels[side][px][1]))

    def best(self, side):
        if not self.levels[side]:
            return None, None
        px = (max if side == "B" else min)(self.levels[side])
        return self.levels[side][px][0], self.total(side, px)

    def text(self, coin, height):
        out = f"coin={coin};height={height};"
        for side, down in (("B", True), ("A", False)):
            for px in sorted(self.levels[side], reverse=down):
                name, ids = self.levels[side][px]
                out += f"{side}|{name}|" + ",".join(f"{o}:{Decimal(self.orders[o][2]):f}" for o in ids) + ";"
        return out


def random_diffs(seed, blocks=400):
    rng = random.Random(seed)
    sizes = ["1", "1.0", "2.50", "3e0", "1e1", "0.125", "7", " 4.0 "]
    for h in range(0, blocks, 2):
        for _ in range(rng.randint(1, 4)):
            oid, kind = rng.randint(1, 30), rng.choice(["new", "new", "update", "remove"])
            px = f"{rng.randint(90, 99) if oid % 2 else rng.randint(98, 107)}{rng.choice(['', '.0', '.00'])}"
            yield h, oid, "B" if oid % 2 else "A", px, kind, rng.choice([*sizes, "0"]) if kind == "new" else None, rng.choice([*sizes, "0", "0.0"]) if kind == "update" else None, None


def test_l4_final_state_and_queue(spark):
    d = diff_rows(spark, [(1, 1, "B", "100.0", "new", "0.5"), (1, 2, "B", "100", "new", "0.3"), (2, 1, "B", "100.00", "new", "0.2"), (3, 2, "B", "100.0", "update", None, "0.1"), (3, 9, "A", "101.0", "update", None, "4"), (4, 3, "A", "101.0", "new", "1"), (5, 3, "A", "101.0", "update", None, "0.0"), (6, 3, "A", "101.0", "update", None, "7")])
    orders = l4.final_orders(d)
    assert {(r.oid, float(r.size), r.size_text) for r in orders.collect()} == {(1, 0.2, "0.2"), (2, 0.1, "0.1")}
    assert {r.oid: (r.orders_ahead, float(r.size_ahead)) for r in l4.queue_positions(orders).collect()} == {2: (0, 0.0), 1: (1, 0.1)}
    assert {r.type: r.n for r in l4.anomalies(d).collect()} == {"duplicate_new": 1, "unknown_oid_update": 2, "update_to_zero": 1}
    (level,) = l4.levels(orders, l4.level_texts(d)).collect()
    assert (level.px, float(level.size), level.orders) == ("100.0", 0.3, 2)  # called as order 1 said first, who left and came back
    tops = {r.height: r for r in l4.block_tops(d).collect()}
    assert (tops[1].bid_px, tops[1].bid_sz, tops[1].ask_px) == ("100.0", 0.8, None)
    assert (tops[4].mid, tops[5].ask_px, tops[6].ask_px) == (100.5, None, None)
    # blocks without diffs are told too, from before the first one to after the last
    every = spark.createDataFrame([("X", h) for h in range(-2, 12)], "coin string, height long")
    all_ = {r.height: r for r in l4.block_tops(d, every).collect()}
    assert set(all_) == set(range(-2, 12)) and (all_[0].bid_px, all_[0].n_diffs) == (None, 0)
    assert all(all_[h].bid_sz == tops[h].bid_sz and all_[h].ask_px == tops[h].ask_px for h in tops) and all_[11].bid_sz == tops[6].bid_sz
    assert l4.block_tops(d.limit(0)).count() == 0


def test_equal_prices_of_any_text_are_one_level(spark):
    d = diff_rows(spark, [(1, 1, "B", "100.0", "new", "1"), (2, 2, "B", "100", "new", "2"), (3, 3, "B", "1e2", "new", "0.1"), (4, 1, "B", "100.0", "remove"), (5, 4, "B", "99.9", "new", "4"), (6, 5, "A", "101", "new", "1"), (7, 5, "A", "101", "remove"), (8, 6, "A", "101.00", "new", "3")])
    orders = l4.final_orders(d)
    got = {(r.side, r.px): (float(r.size), r.orders) for r in l4.levels(orders, l4.level_texts(d)).collect()}
    # the level keeps the first text while it stands, and gets another when it is opened again
    assert got == {("B", "100.0"): (2.1, 2), ("B", "99.9"): (4.0, 1), ("A", "101.00"): (3.0, 1)}
    assert {r.oid: r.orders_ahead for r in l4.queue_positions(orders).collect()} == {2: 0, 3: 1, 4: 0, 6: 0}


@pytest.mark.parametrize("seed", [3, 4])
def test_block_tops_and_checksum_are_those_of_a_replayed_book(spark, seed):
    rows, book_, want = list(random_diffs(seed)), PlainBook(), {}
    for h, own in groupby(rows, lambda r: r[0]):
        for r in own:
            book_.apply(*r[1:])
        bid, ask = book_.best("B"), book_.best("A")
        want[h] = (*bid, *ask, bool(bid[0] and ask[0] and Decimal(bid[0]) >= Decimal(ask[0])))
    d = diff_rows(spark, rows).cache()
    got = {r.height: (r.bid_px, r.bid_sz, r.ask_px, r.ask_sz, r.crossed) for r in l4.block_tops(d).collect()}
    assert got == want and any(w[4] for w in want.values())
    assert l4.checksum(l4.final_orders(d), d).first().checksum == hashlib.sha256(book_.text("X", rows[-1][0]).encode()).hexdigest()


def test_anomalies_by_type(spark):
    rows = [
        (1, 1, "B", "1", "new", "2"), (2, 1, "B", "1", "update", None, "1.0", "2.00"), (3, 1, "B", "1", "update", None, "0.5", "9"), (4, 1, "B", "1", "update", None, "many"), (5, 2, "B", "x", "new", "1"), (5, 4, "B", "1", "new", "abc"),
        (6, 3, "B", "1", "new"), (7, 1, "B", "1", "odd"), (8, 1, "B", "1", "update", None, "0.4", "half"), (9, 1, "B", "1", "update", None, "0.0", "0.4"), (10, 1, "B", "1", "remove"), (12, 1, "B", "1", "new", "1"),
    ]
    d = diff_rows(spark, rows)
    got = sorted((r.height, r.type) for r in l4.anomaly_rows(d).collect())
    assert got == [(3, "orig_sz_mismatch"), (4, "bad_decimal"), (5, "bad_decimal"), (5, "bad_decimal"), (6, "new_without_sz"), (7, "unknown_kind"), (8, "bad_decimal"), (9, "update_to_zero"), (10, "unknown_oid_remove")]
    assert {r.type: r.n for r in l4.anomalies(d).collect()}["height_gap"] == 1
    assert {r.type for r in l4.anomaly_rows(d, "Y").collect()} == {"coin_mismatch"}
    assert sorted(r.height for r in l4.newest_anomalies(d, n=3).collect()) == [8, 9, 10]
    snap = spark.createDataFrame([("X", 4), ("X", 4), ("Y", 5)], "coin string, height long")
    assert [tuple(r) for r in l4.snapshot_mismatches(snap, "Y").collect()] == [("X", 4, "snapshot_coin_mismatch")]


def test_checksum_covers_queue_order_and_the_decimals_as_they_came(spark):
    rows = [(1, 1, "B", "100.0", "new", "0.50"), (1, 2, "B", "100.0", "new", "3"), (2, 3, "B", "101.0", "new", "1e1"), (2, 4, "A", "102.5", "new", "1.0E-7"), (2, 5, "A", "103", "new", "+.5")]
    digest = lambda d: l4.checksum(l4.final_orders(d), d).first().checksum
    text = "coin=X;height=2;B|101.0|3:10;B|100.0|1:0.50,2:3;A|102.5|4:0.00000010;A|103|5:0.5;"
    assert digest(diff_rows(spark, rows)) == hashlib.sha256(text.encode()).hexdigest()
    assert digest(diff_rows(spark, [rows[1], rows[0], *rows[2:]])) != digest(diff_rows(spark, rows))


def test_l4_snapshot_replaces_what_came_before(spark):
    d = diff_rows(spark, [(1, 1, "B", "1", "new", "1"), (5, 2, "B", "1", "update", None, "3.0")])
    snap = spark.createDataFrame([("X", 4, 0, 2, "B", "1", "2")], "coin string, height long, ordinal long, oid long, side string, px string, sz string")
    assert [(r.oid, float(r.size)) for r in l4.final_orders(l4.with_snapshot(snap, d)).collect()] == [(2, 3.0)]


def followed(heights, coins, loads):
    """Books that see every block: (coin, place of the block) -> stale, and each one's gaps since it was loaded."""
    books, stale = {}, {}
    for i, h in enumerate(heights):
        for c in coins[i]:
            books.setdefault(c, [None, False, 0])
        for c, book_ in books.items():
            if book_[0] is not None and h != book_[0] + 1:
                book_[1], book_[2] = True, book_[2] + 1
            book_[0] = h
            if c in coins[i]:
                stale[c, i] = book_[1]
        for c, at, height in loads:
            if at == i:
                books[c] = [height, False, 0]
    return stale, {c: b[2] for c, b in books.items()}


def test_only_the_chain_makes_books_stale(spark):
    feed = [("X", 1), ("Y", 2), ("X", 3)]  # silent coins don't miss anything
    d = spark.createDataFrame([(c, h, h, 0) for c, h in feed], "coin string, arrival long, height long, pos long")
    calendar = blocks.calendar(d.select("arrival", "height"))
    assert blocks.gaps(calendar).count() == 0
    assert not any(r.stale for r in blocks.staleness(d, blocks.epochs(d, calendar), calendar).collect())


@pytest.mark.parametrize("seed", range(3))
def test_staleness_is_that_of_books_that_see_every_block(spark, seed):
    rng = random.Random(seed)
    heights = [100]
    for _ in range(120):
        heights.append(heights[-1] + rng.choice([1] * 12 + [0, -2, 3]))
    coins = [[c for c in "XYZ" if rng.random() < 0.5 and not (c == "Z" and i < 40)] for i in range(len(heights))]
    loads = [("X", 30, heights[30]), ("X", 60, heights[60] - 1), ("Y", 61, heights[61]), ("W", 70, heights[70])]
    want, counts = followed(heights, coins, loads)
    b = spark.createDataFrame([(i, h) for i, h in enumerate(heights)], "arrival long, height long")
    d = spark.createDataFrame([(c, i, heights[i], k) for i, own in enumerate(coins) for c in own for k in range(2)], "coin string, arrival long, height long, pos long")
    s = spark.createDataFrame(loads, "coin string, arrival long, height long")
    calendar = blocks.calendar(b, span=16).cache()  # more than one bucket
    epochs = blocks.epochs(d, calendar, s)
    got = blocks.staleness(d.select("coin", "arrival").distinct(), epochs, calendar).collect()
    assert {(r.coin, r.arrival): r.stale for r in got} == want and set(want.values()) == {True, False}
    assert {r.coin: r.n for r in blocks.gap_counts(epochs, calendar).collect()} == counts
    kinds = {(r.arrival, r.kind) for r in blocks.gaps(calendar).collect()}
    assert kinds == {(i, {0: "repeat", -2: "rewind", 3: "missing"}[b - a]) for i, (a, b) in enumerate(zip(heights, heights[1:]), 1) if b - a != 1}


def test_block_tops_tell_staleness_by_arrival(spark):
    rows = [("X", 0, 7, 0, 1, "B", "1.0", "new", "2"), ("Y", 1, 8, 0, 2, "B", "3", "new", "2"), ("X", 2, 8, 0, 3, "B", "1", "new", "1"), ("X", 3, 9, 0, 1, "B", "1.0", "remove", None)]
    d = spark.createDataFrame([(*r, None) for r in rows], "coin string, arrival long, height long, pos long, oid long, side string, px string, kind string, sz string, new_sz string")
    calendar = blocks.calendar(d.select("arrival", "height").distinct())
    got = {(r.coin, r.arrival): (r.bid_px, r.bid_sz, r.stale) for r in l4.block_tops(d, calendar=calendar, clock="arrival").collect()}
    assert got == {("X", 0): ("1.0", 2.0, False), ("Y", 1): ("3", 2.0, False), ("X", 2): ("1.0", 3.0, True), ("X", 3): ("1.0", 1.0, True)}
    told = l4.feed_stats(d.withColumn("reason", F.when(F.col("oid") == 3, "bad side")), d.select("arrival", "height").distinct()).first()
    assert tuple(told) == (4, 3, 1, 2, ["X", "Y"])


def test_fifo_allocation(spark):
    orders = spark.createDataFrame([("L", 1, 1.0), ("L", 2, 0.5)], "level string, arrival long, size double")
    fills = lambda printed: [round(r.filled, 9) for r in l4.allocate(orders, F.lit(printed), F.lit(5.0), ["level"], ["arrival"]).orderBy("arrival").collect()]
    assert fills(5.5) == [0.5, 0.0] and fills(6.4) == [1.0, 0.4] and fills(4.0) == [0.0, 0.0]


def test_scalars(spark):
    df = spark.createDataFrame([("115323.0", "Bid", "true"), ("83.585", " A ", "1.5"), ("7", "x", "nan")], "px string, side string, n string")
    got = df.select(scalars.tick(F.col("px")).cast("double"), scalars.side(F.col("side")), scalars.number(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(0.1, "B", None), (0.001, "A", 1.5), (1.0, None, None)]
    assert scalars.timeframe_ms("5m") == 300_000 and scalars.timeframe_ms("1d") == 86_400_000
    with pytest.raises(Exception, match="not a side"):
        df.select(scalars.side(F.col("side"), strict=True)).collect()
    assert abs(scalars.ema_alpha(1) - 0.5) < 1e-12 and abs((1 - scalars.ema_alpha(300)) ** 300 - 0.5) < 1e-12
    assert [scalars.backoff_bound(k) for k in (0, 3, 9)] == [1.0, 8.0, 60.0]
    plain = spark.createDataFrame([("1.50",), ("+.5",), ("1e2",), ("1.5e-3",), (" 007 ",), ("5.",), ("-2.0",)], "t string").select(scalars.plain(scalars.exact("t"), F.col("t"))).collect()
    assert [r[0] for r in plain] == ["1.50", "0.5", "100", "0.0015", "7", "5", "-2.0"]
    texts = spark.createDataFrame([('{"a":null,"b":"2"}',), ('{"b":"2"}',), ('{"c":{"b":1}}',), ("x",)], "j string")
    assert [r[0] for r in texts.select(scalars.first_path(F.col("j"), "$.a", "$.b", "$.c.b")).collect()] == [None, "2", "1", None]


def test_report_of_a_few_rows():
    from pyspark.sql import Row

    text = backtest.report([Row(symbol="X", cagr=float("nan"), total_return=0.25, num_trades=3)])
    assert [x.strip() for x in text.splitlines()] == ["symbol: X", "cagr: n/a", "total_return: 0.2500", "num_trades: 3"]
