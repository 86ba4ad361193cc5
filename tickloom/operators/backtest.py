"""Bar backtests without look-ahead: signals, positions, equity, trades and metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import ratio

YEAR_MS = 365.25 * 86_400_000

#: a strategy maps bars to the same bars with a column ``signal``
Strategy = Callable[[DataFrame], DataFrame]


def _w() -> Window:
    return Window.partitionBy("symbol").orderBy("t_ms")


def _past() -> Window:
    return _w().rowsBetween(Window.unboundedPreceding, 0)


def buy_and_hold(bars: DataFrame) -> DataFrame:
    return bars.withColumn("signal", F.lit(1.0))


def crossover(fast: int = 10, slow: int = 30) -> Strategy:
    """Long while the fast mean is above the slow one, short below, flat until both are there."""

    def run(bars: DataFrame) -> DataFrame:
        a, b = (F.when(F.count("close").over(w) == n, F.avg("close").over(w)) for n, w in ((fast, _w().rowsBetween(-fast + 1, 0)), (slow, _w().rowsBetween(-slow + 1, 0))))
        return bars.withColumn("signal", F.when(a > b, 1.0).when(a < b, -1.0).otherwise(0.0))

    return run


def rsi_bands(n: int = 14, low: float = 30, high: float = 70) -> Strategy:
    """Long below ``low``, flat above ``high``, else as before; a window without change says nothing."""

    def run(bars: DataFrame) -> DataFrame:
        frame = bars.withColumn("_d", F.col("close") - F.lag("close").over(_w()))
        w = _w().rowsBetween(-n + 1, 0)
        up, down = F.sum(F.greatest("_d", F.lit(0.0))).over(w), F.sum(F.greatest(-F.col("_d"), F.lit(0.0))).over(w)
        value = F.when((F.count("_d").over(w) == n) & (up + down > 0), 100 * ratio(up, up + down))
        said = F.when(value < low, 1.0).when(value > high, 0.0)
        return frame.withColumn("_s", said).withColumn("signal", F.coalesce(F.last("_s", ignorenulls=True).over(_past()), F.lit(0.0))).drop("_d", "_s")

    return run


def clean_signal(x: Column) -> Column:
    """Null is flat, values stay within [-1, 1], dust is zero."""
    held = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))))
    return F.when(F.abs(held) <= 1e-9, 0.0).otherwise(held)


def run(bars: DataFrame, strategy: Strategy, fee_bps: float = 10.0, slippage_bps: float = 0.0, capital: float = 10_000.0) -> DataFrame:
    """Per bar ``symbol, t_ms, close, position, ret, net, equity``.

    The position of a bar is the signal of the bar before; costs are paid on its change; a bar loses
    at most everything, and equity stays at zero after that.
    """
    if fee_bps < 0 or slippage_bps < 0 or capital <= 0:
        raise ValueError("fees and slippage must not be negative, capital must be positive")
    if "close" not in bars.columns or "t_ms" not in bars.columns:
        raise ValueError("bars need t_ms and close")
    frame = strategy(bars).withColumn("signal", clean_signal(F.col("signal")))
    frame = frame.withColumns({"position": F.lag("signal", 1, 0.0).over(_w()), "ret": F.coalesce(F.try_divide("close", F.lag("close").over(_w())) - 1, F.lit(0.0))})
    turnover = F.abs(F.col("position") - F.lag("position", 1, 0.0).over(_w()))
    net = F.greatest(F.col("position") * F.col("ret") - turnover * ((fee_bps + slippage_bps) / 10_000), F.lit(-1.0))
    frame = frame.withColumn("net", net)
    return frame.select("symbol", "t_ms", "close", "position", "ret", "net", (F.product(1 + F.col("net")).over(_past()) * capital).alias("equity"))


def trades(result: DataFrame) -> DataFrame:
    """Runs of one position sign: ``symbol, entry_ms, exit_ms, direction, entry_price, exit_price, bars, ret, is_open``."""
    sign = F.signum("position")
    frame = result.withColumns({"_s": sign, "_before": F.lag("close").over(_w()), "_last": F.max("t_ms").over(Window.partitionBy("symbol"))})
    frame = frame.withColumn("_run", F.sum((F.col("_s") != F.lag("_s", 1, 0.0).over(_w())).cast("long")).over(_past())).where("_s <> 0")
    out = frame.groupBy("symbol", "_run").agg(
        F.min("t_ms").alias("entry_ms"), F.max("t_ms").alias("exit_ms"), F.first("_s").cast("int").alias("direction"), F.min_by("_before", "t_ms").alias("entry_price"), F.max_by("close", "t_ms").alias("exit_price"),
        F.count("*").alias("bars"), (F.product(1 + F.col("net")) - 1).alias("ret"), (F.max("t_ms") == F.first("_last")).alias("is_open"),
    )
    return out.drop("_run")


def metrics(result: DataFrame) -> DataFrame:
    """Per symbol return, CAGR, Sharpe, Sortino, drawdown, trade statistics, exposure and final equity.

    Spans under a week have no CAGR (NaN).  Risk ratios leave the first bar out and use population
    deviations; the bar spacing is the median one.
    """
    gap = F.col("t_ms") - F.lag("t_ms").over(_w())
    frame = result.withColumns({"_gap": gap, "_peak": F.max("equity").over(_past()), "_n": F.row_number().over(_w())})
    r = F.when(F.col("_n") > 1, F.col("net"))
    fall = F.when(r < 0, r)
    per = frame.groupBy("symbol").agg(
        F.count("*").alias("bars"), F.min_by("equity", "t_ms").alias("first"), F.max_by("equity", "t_ms").alias("final_equity"), (F.max("t_ms") - F.min("t_ms")).alias("span"), F.median("_gap").alias("step"), F.avg(r).alias("mean"),
        F.stddev_pop(r).alias("sd"), F.coalesce(F.stddev_pop(fall), F.lit(0.0)).alias("down"), F.min(F.try_divide("equity", "_peak") - 1).alias("max_drawdown"), F.avg((F.col("position") != 0).cast("double")).alias("exposure"),
    )
    closed = trades(result).where("not is_open")
    gains, losses = F.sum(F.greatest("ret", F.lit(0.0))), F.sum(F.greatest(-F.col("ret"), F.lit(0.0)))
    stats = closed.groupBy("symbol").agg(
        F.count("*").alias("num_trades"), F.avg((F.col("ret") > 0).cast("double")).alias("win_rate"), F.when(losses > 0, F.try_divide(gains, losses)).when(gains > 0, float("inf")).otherwise(0.0).alias("profit_factor"), F.avg("ret").alias("expectancy")
    )
    ppy = F.when(F.col("step") > 0, YEAR_MS / F.col("step"))
    total = F.coalesce(F.try_divide("final_equity", "first") - 1, F.lit(0.0))
    years = F.col("span") / YEAR_MS
    cagr = F.when(F.col("bars") < 2, 0.0).when(years < 7 / 365.25, float("nan")).when(1 + total <= 0, -1.0).otherwise(F.pow(1 + total, F.try_divide(F.lit(1.0), years)) - 1)
    sharpe = F.when((F.col("bars") > 2) & (F.col("sd") > 0) & ppy.isNotNull(), F.try_divide("mean", "sd") * F.sqrt(ppy)).otherwise(0.0)
    sortino = F.when((F.col("bars") <= 2) | ppy.isNull(), 0.0).when(F.col("down") > 0, F.try_divide("mean", "down") * F.sqrt(ppy)).when(F.col("mean") > 0, float("inf")).otherwise(0.0)
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return per.join(stats, "symbol", "left").select(
        "symbol", total.alias("total_return"), cagr.alias("cagr"), sharpe.alias("sharpe"), sortino.alias("sortino"), "max_drawdown", zero("win_rate"), zero("profit_factor"), zero("expectancy"), F.coalesce("num_trades", F.lit(0)).alias("num_trades"), "exposure", "final_equity"
    )


def report(rows: list) -> str:
    """Text of a few collected metric rows; NaN reads n/a."""
    show = lambda v: "n/a" if isinstance(v, float) and v != v else f"{v:,.4f}" if isinstance(v, float) else str(v)
    return "\n\n".join("\n".join(f"{k:>15}: {show(v)}" for k, v in r.asDict().items()) for r in rows)
