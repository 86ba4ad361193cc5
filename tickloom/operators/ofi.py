"""Order-flow imbalance: contributions, windows, forward moves, regression, deciles."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .asof import BUCKET_MS, asof, numbered, seeded


def contributions(quotes: DataFrame, *keep: str) -> DataFrame:
    """``symbol, t_ms, arrival, e`` and columns to ``keep``; an unchanged price counts on both sides, a symbol's first row has none."""
    own = quotes.select("symbol", "t_ms", "arrival", "bid_px", "bid_sz", "ask_px", "ask_sz", *keep)
    w = Window.partitionBy("symbol", "_b").orderBy("t_ms", "arrival")
    pb, qb, pa, qa = (F.lag(c).over(w) for c in ("bid_px", "bid_sz", "ask_px", "ask_sz"))
    b, a = F.col("bid_px"), F.col("ask_px")
    zero = F.lit(0.0)
    e = F.when(b >= pb, F.col("bid_sz")).otherwise(zero) - F.when(b <= pb, qb).otherwise(zero) - F.when(a <= pa, F.col("ask_sz")).otherwise(zero) + F.when(a >= pa, qa).otherwise(zero)
    told = seeded(own, "symbol", ["t_ms", "arrival"]).select("symbol", "t_ms", "arrival", "_seed", *keep, F.when(pb.isNotNull(), e).alias("e"))
    return told.where("e is not null and not _seed").drop("_seed")


def windows(quotes: DataFrame, width_ms: int) -> DataFrame:
    """``symbol, start_ms, ofi`` of windows with an event."""
    start = (F.floor(F.col("t_ms") / width_ms) * width_ms).alias("start_ms")
    return contributions(quotes).groupBy("symbol", start).agg(F.sum("e").alias("ofi"))


def forward(quotes: DataFrame, width_ms: int, horizon_ms: int) -> DataFrame:
    """``symbol, start_ms, ofi, change, mid``: mids as of the window's end and a horizon later.

    Windows whose horizon ends after the last quote have no row.
    """
    mids = quotes.select("symbol", "t_ms", "arrival", ((F.col("bid_px") + F.col("ask_px")) / 2).alias("mid"))
    last = mids.groupBy("symbol").agg(F.max("t_ms").alias("last_ms"))
    open_ = windows(quotes, width_ms).join(last, "symbol").withColumn("t_ms", F.col("start_ms") + width_ms)
    open_ = open_.where(F.col("t_ms") + horizon_ms <= F.col("last_ms"))
    # both times of a window are probes of one as-of join
    probes = open_.select("symbol", "start_ms", "ofi", F.explode(F.array(F.lit(0), F.lit(horizon_ms))).alias("ahead"), F.col("t_ms").alias("end_ms")).withColumn("t_ms", F.col("end_ms") + F.col("ahead"))
    met = asof(probes, mids, ["mid"]).groupBy("symbol", "start_ms", "ofi").agg(F.min_by("mid", "ahead").alias("now"), F.max_by("mid", "ahead").alias("then"))
    return met.select("symbol", "start_ms", "ofi", (F.col("then") - F.col("now")).alias("change"), F.col("now").alias("mid")).where("change is not null")


def regression(triples: DataFrame, lag: int = 1) -> DataFrame:
    """Per symbol ``n, slope, r, t_stat, t_hac`` of change on ofi.

    Moments are pre-aggregated in one pass.  Fewer than three rows or no variance of ofi: all null.  No
    variance of change: slope 0, r and t null.  A perfect fit has an infinite t.  ``t_hac`` uses Bartlett
    weights with ``lag`` lags over windows in time order.
    """
    n = F.count("*")
    sums = triples.groupBy("symbol").agg(
        n.alias("n"), F.avg("ofi").alias("mx"), F.avg("change").alias("my"), (F.var_pop("ofi") * n).alias("sxx"), (F.var_pop("change") * n).alias("syy"), (F.covar_pop("ofi", "change") * n).alias("sxy")
    )
    able = (F.col("n") >= 3) & (F.col("sxx") > 0)
    slope = F.when(able, F.try_divide("sxy", "sxx"))
    r = F.when(able & (F.col("syy") > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy"))))))
    sums = sums.select("symbol", "n", "mx", "my", "sxx", slope.alias("slope"), r.alias("r"))
    t = Window.partitionBy("symbol").orderBy("start_ms")
    x, y = F.col("ofi") - F.col("mx"), F.col("change") - F.col("my")
    scored = triples.join(sums.select("symbol", "mx", "my", "slope"), "symbol").select("symbol", "start_ms", (x * (y - F.col("slope") * x)).alias("g"))
    parts = [F.sum(F.col("g") * F.col("g"))] + [2 * (1 - k / (lag + 1)) * F.coalesce(F.sum(F.col("g") * F.col(f"g{k}")), F.lit(0.0)) for k in range(1, lag + 1)]
    scored = scored.withColumns({f"g{k}": F.lag("g", k).over(t) for k in range(1, lag + 1)})
    hac = scored.groupBy("symbol").agg(sum(parts[1:], parts[0]).alias("s"))
    left = 1 - F.col("r") * F.col("r")
    t_stat = F.when(F.col("r").isNotNull(), F.when(left <= 1e-15, float("inf")).otherwise(F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, left))))
    honest = F.when(F.col("s") <= 0, F.when(F.col("slope") != 0, float("inf"))).otherwise(F.try_divide(F.col("slope") * F.col("sxx"), F.sqrt("s")))
    return sums.join(hac, "symbol", "left").select("symbol", "n", "slope", "r", t_stat.alias("t_stat"), F.when(F.col("slope").isNotNull(), honest).alias("t_hac"))


def bucket(rank: Column, n: Column, most: int) -> Column:
    """0-based bucket of a 0-based rank when ``n`` rows are cut at ``b * n div k``."""
    k = F.least(F.lit(most).cast("long"), n)
    return F.floor(((rank + 1) * k - 1) / n)


def deciles(triples: DataFrame, most: int = 10) -> DataFrame:
    """``symbol, decile, n, mean_ofi, mean_fwd_bps``; ties on ofi keep window order."""
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy("ofi", "start_ms")) - 1
    n = F.count("*").over(Window.partitionBy("symbol"))
    placed = triples.withColumn("decile", bucket(rank, n, most) + 1)
    return placed.groupBy("symbol", "decile").agg(F.count("*").alias("n"), F.avg("ofi").alias("mean_ofi"), F.avg(F.try_divide(F.col("change"), F.col("mid")) * 10_000).alias("mean_fwd_bps"))


def monotone(table: DataFrame) -> DataFrame:
    """Share of steps between neighbouring deciles that do not fall; null with one decile."""
    before = F.lag("mean_fwd_bps").over(Window.partitionBy("symbol").orderBy("decile"))
    up = table.withColumn("up", (F.col("mean_fwd_bps") >= before).cast("double"))
    return up.groupBy("symbol").agg(F.avg("up").alias("monotone_fraction"))


def hac_lag(width_ms: int, horizon_ms: int) -> int:
    return max(1, math.ceil(horizon_ms / width_ms))


def analyze(quotes: DataFrame, widths_ms: list[int], horizons_ms: list[int]) -> DataFrame:
    """The regression read of every width and horizon, and of the next window of each width."""
    out = None
    for w in widths_ms:
        for label, h in [(f"{h / 1000:g}s", h) for h in horizons_ms] + [(f"next({w / 1000:g}s)", w)]:
            triples = forward(quotes, w, h)
            read = regression(triples, hac_lag(w, h)).join(monotone(deciles(triples)), "symbol", "left")
            read = read.select(F.lit(w).alias("window_ms"), F.lit(label).alias("horizon"), F.lit(hac_lag(w, h)).alias("hac_lag"), *read.columns)
            out = read if out is None else out.unionByName(read)
    return out


def _trailing(flow: DataFrame, width_ms: int) -> DataFrame:
    """``flow`` (``symbol, t_ms, arrival, e`` and more) with ``ofi``, the sum of ``e`` over ``[t - width, t]`` as far as it has arrived.

    Time is cut into stretches of one width, so a window is the end of one stretch and the beginning of the next: two
    running sums, whatever a window holds, and nothing is taken off again.
    """
    upto = Window.rowsBetween(Window.unboundedPreceding, 0)
    placed = flow.withColumn("_b", F.floor(F.col("t_ms") / width_ms))
    begun = placed.withColumn("_own", F.sum("e").over(upto.partitionBy("symbol", "_b").orderBy("t_ms", "arrival")))
    kept = F.struct("_own", *[c for c in flow.columns if c != "symbol"])
    # each quote is a row of its stretch, and asks what the stretch before holds from its own place on
    at = lambda b, t, e, of: F.struct((F.col("_b") - b).alias("_b"), (F.col("t_ms") - t).alias("_t"), e.alias("_e"), of.alias("_of"))
    asked = at(1, width_ms, F.lit(0.0), kept)
    both = begun.select("symbol", F.inline(F.array(at(0, 0, F.col("e").cast("double"), F.when(F.lit(False), kept)), asked)))
    back = F.sum("_e").over(upto.partitionBy("symbol", "_b").orderBy(F.desc("_t"), F.col("_of").isNotNull()))
    told = both.withColumn("_before", back).where("_of is not null")
    return told.select("symbol", "_of.*", (F.col("_before") + F.col("_of._own")).cast("double").alias("ofi")).drop("_own")


def rolling_signal(quotes: DataFrame, window_ms: int = 1000, halflife: int = 300, warmup: int = 30) -> DataFrame:
    """Rolling OFI over ``[t - window, t]`` over a slow average of its size, within [-3, 3].

    The average folds over all quotes of the symbol so far.  A quote sees those of its millisecond that
    arrived before it.  Quotes are numbered first.  Within a chunk of them the fold is a running sum of sizes that are scaled
    up by as much as the average would have decayed since the chunk began; a chunk is 200 half-lives long, so
    that doubles hold the scale (2^200), and of the chunks before, all that doubles can tell is in the last five.
    """
    alpha = 1 - 0.5 ** (1 / halflife)
    size = 200 * halflife
    own = numbered(quotes, ["symbol"], ["t_ms", "arrival"], BUCKET_MS)
    # the first quote has no flow
    flow = _trailing(contributions(own, "_pos"), window_ms).select("symbol", "t_ms", "arrival", "ofi", "_pos", F.floor((F.col("_pos") - 1) / size).alias("_c"))
    decay, k = F.lit(1 - alpha), F.pmod(F.col("_pos") - 1, F.lit(size))
    chunk = Window.partitionBy("symbol", "_c").orderBy("_pos")
    scaled = F.sum(F.abs("ofi") * F.pow(decay, -k)).over(chunk.rowsBetween(Window.unboundedPreceding, 0))
    flow = flow.withColumns({"own": alpha * scaled * F.pow(decay, k), "k": k + 1})
    ends = flow.groupBy("symbol", "_c").agg(F.max_by("own", "_pos").alias("end"))
    before = Window.partitionBy("symbol").orderBy("_c")
    start = reduce(add, (F.coalesce(F.lag("end", d).over(before), F.lit(0.0)) * (1 - alpha) ** (size * (d - 1)) for d in range(1, 6)))
    flow = flow.join(ends.select("symbol", "_c", start.alias("start")), ["symbol", "_c"])
    norm = F.col("own") + F.col("start") * F.pow(decay, F.col("k"))
    # the first quote, which has no flow, is an update too
    ready = F.col("_pos") + 1 >= warmup
    return flow.select("symbol", "t_ms", "arrival", F.when(ready & (norm > 0), F.greatest(F.lit(-3.0), F.least(F.lit(3.0), F.try_divide(F.col("ofi"), norm)))).otherwise(0.0).alias("signal"))
