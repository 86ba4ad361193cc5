"""Results must be whole: the rolling order flow folds over every quote."""

import numpy as np

from tickloom.operators import ofi


def folded(quotes, window_ms, halflife, warmup=30):
    """The signal after each quote of one symbol, one quote at a time."""
    alpha, flows, norm, out, last = 1 - 0.5 ** (1 / halflife), [], 0.0, [], None
    for n, (t, bid, bid_sz, ask, ask_sz) in enumerate(quotes, 1):
        if last:
            e = (bid_sz if bid >= last[0] else 0) - (last[1] if bid <= last[0] else 0) - (ask_sz if ask <= last[2] else 0) + (last[3] if ask >= last[2] else 0)
            flows.append((t, e))
            v = sum(x for s, x in flows if s >= t - window_ms)
            norm += alpha * (abs(v) - norm)
            out.append(max(-3.0, min(3.0, v / norm)) if n >= warmup and norm > 0 else 0.0)
            flows = [f for f in flows if f[0] >= t - window_ms]
        last = (bid, bid_sz, ask, ask_sz)
    return out


def test_rolling_signal_folds_over_every_quote(spark):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for symbol, n, step in (("A", 6000, 60_000), ("B", 500, 300), ("C", 20, 1000)):
        t, own = 1_700_000_000_000, []
        for k in range(n):
            t += int(rng.integers(0, 3)) * step  # often several in a millisecond
            scale = 1000.0 if k < 1500 else 1.0  # the older flow was much larger
            own.append((t, 100.0 + int(rng.integers(0, 4)), float(rng.integers(1, 9)) * scale, 105.0 + int(rng.integers(0, 4)), float(rng.integers(1, 9)) * scale))
            rows.append((symbol, own[-1][0], k, *own[-1][1:]))
        want |= {(symbol, k): v for k, v in enumerate(folded(own, 120_000, 300), 1)}
    quotes = spark.createDataFrame(rows, "symbol string, t_ms long, arrival long, bid_px double, bid_sz double, ask_px double, ask_sz double").repartition(7)
    got = {(r.symbol, r.arrival): r.signal for r in ofi.rolling_signal(quotes, window_ms=120_000, halflife=300).collect()}
    assert set(got) == set(want)  # a symbol's first quote has no flow
    worst = max(abs(got[k] - want[k]) for k in got)
    assert worst < 1e-9, f"off by {worst}"


def test_rolling_signal_sums_no_window_row_by_row(spark):
    """A window that holds all 3000 quotes, and one that holds two: the work is the same, and so is the sum."""
    rng = np.random.default_rng(5)
    own = [(1_700_000_000_000 + 7 * (k // 3), 100.0 + int(rng.integers(0, 4)), float(rng.integers(1, 9)), 105.0 + int(rng.integers(0, 4)), float(rng.integers(1, 9))) for k in range(3000)]
    quotes = spark.createDataFrame([("A", r[0], k, *r[1:]) for k, r in enumerate(own)], "symbol string, t_ms long, arrival long, bid_px double, bid_sz double, ask_px double, ask_sz double")
    for width in (1_000_000, 7):
        told = ofi.rolling_signal(quotes, window_ms=width, halflife=30)
        assert "RangeFrame" not in told._jdf.queryExecution().toString()
        got = {r.arrival: r.signal for r in told.collect()}
        want = dict(enumerate(folded(own, width, 30), 1))
        assert set(got) == set(want) and max(abs(got[k] - want[k]) for k in got) < 1e-9
