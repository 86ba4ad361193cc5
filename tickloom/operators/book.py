"""Level books: each row is a whole book, so everything here is row-level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import imbalance, mid, spread_bps


def best_first(levels: Column, bids: bool) -> Column:
    """Levels sorted best first by price; stable only where prices differ."""
    rising = F.array_sort(F.transform(levels, lambda x: F.struct(x["px"].alias("px"), x["sz"].alias("sz"))))
    return F.reverse(rising) if bids else rising


def clean_levels(levels: Column, places: int = 8) -> Column:
    """Levels with positive price and size, rounded."""
    good = F.filter(levels, lambda x: (x["px"] > 0) & (x["sz"] > 0))
    return F.transform(good, lambda x: F.struct(F.round(x["px"], places).alias("px"), F.round(x["sz"], places).alias("sz")))


def parse_levels(levels: Column) -> tuple[Column, Column]:
    """Levels of text prices and sizes as doubles, and how many could not be read."""
    read = F.transform(levels, lambda x: F.struct(x["px"].try_cast("double").alias("px"), x["sz"].try_cast("double").alias("sz")))
    good = F.filter(read, lambda x: x["px"].isNotNull() & x["sz"].isNotNull())
    return good, F.size(read) - F.size(good)


def depth(levels: Column, n: int) -> Column:
    return F.slice(levels, 1, n)


def volume(levels: Column, n: int | None = None) -> Column:
    of = levels if n is None else F.slice(levels, 1, n)
    return F.aggregate(of, F.lit(0.0), lambda a, x: a + x["sz"])


def is_sorted(levels: Column, bids: bool) -> Column:
    px = F.transform(levels, lambda x: x["px"])
    rising = F.array_sort(px)
    return px == (F.reverse(rising) if bids else rising)


def totals(levels: Column, n: int = 5) -> Column:
    """``struct<all, top, levels>``: size of all levels, of the first ``n``, and how many there are, in one fold."""
    start = F.struct(F.lit(0.0).alias("all"), F.lit(0.0).alias("top"), F.lit(0).cast("long").alias("levels"))
    more = lambda a, x: F.struct((a["all"] + x["sz"]).alias("all"), F.when(a["levels"] < n, a["top"] + x["sz"]).otherwise(a["top"]).alias("top"), (a["levels"] + 1).alias("levels"))
    return F.aggregate(levels, start, more)


def metrics(books: DataFrame) -> DataFrame:
    """Best prices, mid, spread, depth volumes and imbalances; a book with an empty side has no row."""
    # each side is folded once; what follows reads the fold
    first = books.select("symbol", "t_ms", "arrival", F.get("bids", F.lit(0)).alias("b"), F.get("asks", F.lit(0)).alias("a"), totals(F.col("bids")).alias("bt"), totals(F.col("asks")).alias("at"))
    bp, ap, bv, av, b5, a5 = (F.col(c) for c in ("b.px", "a.px", "bt.all", "at.all", "bt.top", "at.top"))
    told = F.struct(
        bp.alias("best_bid"), ap.alias("best_ask"), F.col("b.sz").alias("bid_size"), F.col("a.sz").alias("ask_size"), mid(bp, ap).alias("mid"), (ap - bp).alias("spread"),
        spread_bps(bp, ap).alias("spread_bps"), bv.alias("bid_volume"), av.alias("ask_volume"), b5.alias("bid_depth_5"), a5.alias("ask_depth_5"), imbalance(bv, av).alias("imbalance"), imbalance(b5, a5).alias("imbalance_5"),
        F.col("bt.levels").alias("bid_levels"), F.col("at.levels").alias("ask_levels"), F.coalesce(bp >= ap, F.lit(False)).alias("crossed"),
    )
    # a filter would be pushed below the folds and do them again; an empty array has no rows
    whole = F.when((F.col("bt.levels") > 0) & (F.col("at.levels") > 0), F.array(told)).otherwise(F.array().cast(f"array<{first.select(told.alias('t')).schema['t'].dataType.simpleString()}>"))
    return first.select("symbol", "t_ms", "arrival", F.inline(whole))


def capture_summary(quotes: DataFrame, places: int = 9) -> DataFrame:
    """Median and interpolated 95th percentile of the spread, mean imbalance, first and last bid of each symbol.

    Spreads are counted by value (to ``places``) before they are ordered.
    """
    order = F.struct("t_ms", "arrival")
    spread = F.round(F.col("ask_px") - F.col("bid_px"), places)
    counts = quotes.groupBy("symbol", spread.alias("x")).agg(F.count("*").alias("c"))
    w = Window.partitionBy("symbol")
    run = counts.withColumns({"upto": F.sum("c").over(w.orderBy("x")), "n": F.sum("c").over(w)})
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("x")))
    out = []
    for name, q in (("spread_median", 0.5), ("spread_p95", 0.95)):
        place = (F.col("n") - 1) * q
        low, high = at(F.floor(place)), at(F.ceil(place))
        out.append((low + (high - low) * F.max(place - F.floor(place))).alias(name))
    spreads = run.groupBy("symbol").agg(*out)
    rest = quotes.groupBy("symbol").agg(F.avg(F.abs(imbalance(F.col("bid_sz"), F.col("ask_sz")))).alias("imbalance_abs"), F.min_by("bid_px", order).alias("first_bid"), F.max_by("bid_px", order).alias("last_bid"))
    return spreads.join(rest, "symbol")


def sanitize(books: DataFrame) -> DataFrame:
    """Cleaned and sorted books; empty or crossed ones go."""
    bids, asks = best_first(clean_levels(F.col("bids")), True), best_first(clean_levels(F.col("asks")), False)
    out = books.withColumns({"bids": bids, "asks": asks})
    return out.where((F.size("bids") > 0) & (F.size("asks") > 0) & (F.get("bids", F.lit(0))["px"] < F.get("asks", F.lit(0))["px"]))
