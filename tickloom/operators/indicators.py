"""Technical indicators over an ordered series of closes per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import ratio

HISTORY = 200


def _by(order: str) -> Window:
    return Window.partitionBy("symbol").orderBy(order)


def sma(x: str, n: int, order: str) -> Column:
    """Null until ``n`` values are there."""
    w = _by(order).rowsBetween(-(n - 1), 0)
    return F.when(F.count(x).over(w) == n, F.avg(x).over(w))


def ema(x: str, n: int, order: str, history: int = HISTORY) -> Column:
    """Fold over the retained history, seeded with its oldest value; null until ``n`` values are there."""
    kept = F.collect_list(x).over(_by(order).rowsBetween(-(history - 1), 0))
    a = 2.0 / (n + 1)
    folded = F.aggregate(F.slice(kept, 2, history), F.element_at(kept, 1), lambda e, v: v * a + e * (1 - a))
    return F.when(F.size(kept) >= n, folded)


def rsi(x: str, n: int, order: str, flat_is_nan: bool = False) -> Column:
    """Relative strength from simple averages of ``n`` changes.

    Without losses it is 100; with ``flat_is_nan`` a window without any change is NaN instead.
    """
    change = F.col(x) - F.lag(x).over(_by(order))
    w = _by(order).rowsBetween(-(n - 1), 0)
    up, down = F.sum(F.greatest(F.col("_d"), F.lit(0.0))).over(w), F.sum(F.greatest(-F.col("_d"), F.lit(0.0))).over(w)
    del change
    value = F.when(down == 0, 100.0).otherwise(100 - 100 / (1 + ratio(up, down)))
    if flat_is_nan:
        value = F.when((down == 0) & (up == 0), float("nan")).otherwise(value)
    return F.when(F.count("_d").over(w) == n, value)


def indicators(closes: DataFrame, order: str = "start_ms", least: int = 20, drop_zero: bool = False) -> DataFrame:
    """``symbol, <order>`` and the indicator columns of ``close`` and ``volume``; rows from the ``least``-th on.

    ``drop_zero`` turns an SMA, EMA or RSI of exactly zero into null.
    """
    w = _by(order)
    frame = closes.withColumn("_d", F.col("close") - F.lag("close").over(w)).withColumn("_i", F.row_number().over(w))
    zero = (lambda c: F.when(c != 0, c)) if drop_zero else (lambda c: c)
    w20 = w.rowsBetween(-19, 0)
    middle, sigma = F.avg("close").over(w20), F.stddev_pop("close").over(w20)
    full = F.count("close").over(w20) == 20
    before = F.lag("close").over(w)
    volume = sma("volume", 10, order)
    out = frame.select(
        "symbol", order, "_i",
        *[zero(sma("close", n, order)).alias(f"sma_{n}") for n in (10, 20, 50)],
        *[zero(ema("close", n, order)).alias(f"ema_{n}") for n in (10, 20, 50)],
        zero(rsi("close", 14, order)).alias("rsi_14"),
        F.when(full, middle).alias("bb_middle"), F.when(full, middle + 2 * sigma).alias("bb_upper"), F.when(full, middle - 2 * sigma).alias("bb_lower"),
        F.when(full, ratio(4 * sigma, middle) * 100).alias("bb_width"),
        F.col("_d").alias("price_change"), (ratio(F.col("_d"), before) * 100).alias("price_change_pct"),
        volume.alias("volume_sma_10"), ratio(F.col("volume"), volume).alias("volume_ratio"),
    )
    return out.where(F.col("_i") >= least).drop("_i")
