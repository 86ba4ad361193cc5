"""Sanitising and validation: row-level rules become findings, findings become quality figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import ratio
from .asof import chunked, seeded
from .book import is_sorted, sanitize

ERROR, WARNING, CRITICAL = "ERROR", "WARNING", "CRITICAL"


def _finding(when: Column, code: str, level: str) -> Column:
    return F.when(when, F.struct(F.lit(code).alias("code"), F.lit(level).alias("level")))


def _explode(frame: DataFrame, kind: str, rules: list[Column]) -> DataFrame:
    found = F.filter(F.array(*rules), lambda x: x.isNotNull())
    return frame.select("symbol", "t_ms", "arrival", F.lit(kind).alias("data_type"), F.explode(found).alias("f")).select("symbol", "t_ms", "arrival", "data_type", "f.code", "f.level")


def sanitize_trades(trades: DataFrame, venue_sides: bool = True) -> DataFrame:
    """Trades with positive price and size, rounded to eight places, sides in words.

    With ``venue_sides`` B and A count as buy and sell; without, only the words do and others are
    ``unknown``.
    """
    low = F.lower(F.col("side"))
    known = F.when(low.isin("buy", "sell", "bid", "ask"), low)
    if venue_sides:
        known = F.coalesce(known, F.when(low == "b", "buy").when(low == "a", "sell"))
    clean = {"price": F.round("price", 8), "size": F.round("size", 8), "side": F.coalesce(known, F.lit("unknown"))}
    return trades.where((F.col("price") > 0) & (F.col("size") > 0)).withColumns(clean)


def trade_findings(trades: DataFrame, jump: float = 0.10, spike: float = 10.0) -> DataFrame:
    """Bad price or size, price jumps against the previous trade, volume spikes against the last ten.

    After sizes of zero any size is a spike.
    """
    w = Window.partitionBy("symbol", "_b").orderBy("_pos")
    before = F.lag("price").over(w)
    usual = F.avg("size").over(w.rowsBetween(-10, -1))
    frame = chunked(trades, ["symbol"], ["arrival"], 10).withColumns({"_before": before, "_usual": usual}).where("not _halo")
    return _explode(frame, "trade", [
        _finding(F.col("price") <= 0, "price_not_positive", ERROR), _finding(F.col("size") <= 0, "size_not_positive", ERROR),
        _finding((F.col("_before") > 0) & (F.abs(F.col("price") - F.col("_before")) > jump * F.col("_before")), "price_change", WARNING),
        _finding(F.col("size") > spike * F.col("_usual"), "volume_spike", WARNING),
    ])


def book_findings(books: DataFrame, wide: float = 0.05) -> DataFrame:
    """Empty sides, unsorted sides, crossed tops and wide spreads."""
    bid, ask = F.get("bids", F.lit(0))["px"], F.get("asks", F.lit(0))["px"]
    return _explode(books, "orderbook", [
        _finding(F.size("bids") == 0, "empty_bids", ERROR), _finding(F.size("asks") == 0, "empty_asks", ERROR),
        _finding(~is_sorted(F.col("bids"), True), "bids_unsorted", ERROR), _finding(~is_sorted(F.col("asks"), False), "asks_unsorted", ERROR),
        _finding(bid >= ask, "crossed", CRITICAL), _finding((bid < ask) & ((ask - bid) > wide * bid), "wide_spread", WARNING),
    ])


def time_findings(points: DataFrame, as_of_ms: int, future_ms: int = 10_000, stale_ms: int = 300_000, near_ms: int = 100, back: int = 100) -> DataFrame:
    """Timestamps in the future, stale ones, and ones within ``near_ms`` of any of the last ``back`` points."""
    w = Window.partitionBy("symbol", "data_type", "_b").orderBy("_pos").rowsBetween(-back, -1)
    frame = chunked(points, ["symbol", "data_type"], ["arrival"], back).withColumn("_last", F.collect_list("t_ms").over(w)).where("not _halo")
    close = F.exists("_last", lambda t: F.abs(t - F.col("t_ms")) < near_ms)
    found = F.filter(F.array(
        _finding(F.col("t_ms") > as_of_ms + future_ms, "future", ERROR), _finding(F.col("t_ms") < as_of_ms - stale_ms, "stale", WARNING), _finding(close, "duplicate", WARNING),
    ), lambda x: x.isNotNull())
    return frame.select("symbol", "t_ms", "arrival", "data_type", F.explode(found).alias("f")).select("symbol", "t_ms", "arrival", "data_type", "f.code", "f.level")


def structure_findings(points: DataFrame) -> DataFrame:
    """Missing symbol, data type or payload (an empty object is none); a payload that can't be read is CRITICAL.

    ``data`` is JSON text.  Trades need numbers for price and size where they have these keys.
    """
    bare = F.regexp_replace(F.coalesce("data", F.lit("")), r"\s", "")
    empty = bare.isin("", "{}", "[]", "null")
    number = lambda k: F.get_json_object("data", f"$.{k}").isNotNull() & F.get_json_object("data", f"$.{k}").try_cast("double").isNull()
    broken = ~empty & (F.json_object_keys("data").isNull() | ((F.col("data_type") == "trade") & (number("price") | number("size"))))
    return _explode(points.withColumn("symbol", F.coalesce("symbol", F.lit(""))), "any", [
        _finding(F.col("symbol") == "", "missing_symbol", ERROR), _finding(F.coalesce(F.col("data_type") == "", F.lit(True)), "missing_data_type", ERROR), _finding(empty, "missing_data", ERROR),
        _finding(broken, "validation_error", CRITICAL),
    ])


def drop_critical(frame: DataFrame, findings: DataFrame) -> DataFrame:
    """Rows without a CRITICAL finding."""
    bad = findings.where(F.col("level") == CRITICAL).select("symbol", "arrival").distinct()
    return frame.join(bad, ["symbol", "arrival"], "left_anti")


def checked_books(books: DataFrame) -> DataFrame:
    """The whole chain for level books: sanitised, validated, and without those that have a CRITICAL finding."""
    clean = sanitize(books)
    return drop_critical(clean, book_findings(clean))


def checked_trades(trades: DataFrame, venue_sides: bool = True) -> DataFrame:
    """The whole chain for trades; what is sanitised can't have a CRITICAL finding."""
    clean = sanitize_trades(trades, venue_sides)
    return drop_critical(clean, trade_findings(clean))


def quality(findings: DataFrame, points: DataFrame | None = None, as_of_ms: int | None = None) -> DataFrame:
    """Per symbol counts and shares.

    Completeness is 1 less the share of errors among findings; accuracy counts a warning as half an
    error; CRITICAL findings are findings, but no errors.  Spikes and price changes are ``outliers``.  ``points`` (of all
    types) adds how many rows were looked at and, with ``as_of_ms``, how old the newest one is; a day where there is none.
    """
    n = F.count("*")
    errors, warnings = F.count_if(F.col("level") == ERROR), F.count_if(F.col("level") == WARNING)
    out = findings.groupBy("symbol").agg(
        n.alias("findings"), errors.alias("errors"), warnings.alias("warnings"), F.count_if(F.col("level") == CRITICAL).alias("criticals"),
        F.count_if(F.col("code") == "duplicate").alias("duplicates"), F.count_if(F.col("code") == "volume_spike").alias("spikes"), F.count_if(F.col("code") == "price_change").alias("price_changes"), F.count_if(F.col("code").isin("volume_spike", "price_change")).alias("outliers"),
        (1 - ratio(errors, n)).alias("completeness"), (1 - ratio(errors + warnings * 0.5, n)).alias("accuracy"),
    )
    if points is None:
        return out
    seen = points.groupBy("symbol").agg(F.count("*").alias("points"), F.max("t_ms").alias("_newest"))
    out = out.join(seen, "symbol", "left")
    age = F.coalesce(F.lit(as_of_ms) - F.col("_newest"), F.lit(86_400_000)).cast("long")
    return (out if as_of_ms is None else out.withColumn("freshness_ms", age)).drop("_newest")


def report(findings: DataFrame, points: DataFrame | None = None, as_of_ms: int | None = None) -> DataFrame:
    """``quality`` of every symbol, and one row of totals whose symbol is null."""
    each = quality(findings, points, as_of_ms)
    total = quality(findings.withColumn("symbol", F.lit("")), None if points is None else points.withColumn("symbol", F.lit("")), as_of_ms)
    return each.unionByName(total.withColumn("symbol", F.lit(None).cast("string")))


def point_warnings(findings: DataFrame, back: int = 10) -> DataFrame:
    """``symbol, data_type, arrival, findings, warnings`` of each point, of its last ``back`` findings.

    When a point has just been checked, the newest findings are its own; a point is known by symbol, type and arrival.
    """
    point = ["symbol", "data_type", "arrival"]
    last = findings.withColumn("_n", F.row_number().over(Window.partitionBy(*point).orderBy(F.desc("code")))).where(F.col("_n") <= back)
    return last.groupBy(*point).agg(F.count("*").alias("findings"), F.count_if(F.col("level") == WARNING).alias("warnings"))


def rates(points: DataFrame) -> DataFrame:
    """``symbol, data_type, n, per_second`` over the time between a feed's first and last point; null where that is none."""
    span = (F.max("t_ms") - F.min("t_ms")) / 1000
    return points.groupBy("symbol", "data_type").agg(F.count("*").alias("n"), F.try_divide(F.count("*"), span).alias("per_second"))


def recent(findings: DataFrame, as_of_ms: int, age_ms: int = 86_400_000) -> DataFrame:
    return findings.where(F.col("t_ms") >= as_of_ms - age_ms)


def gaps(frames: DataFrame, least_ms: int) -> DataFrame:
    """``symbol, start_ms, end_ms, seconds`` of silences of at least ``least_ms``."""
    before = F.lag("t_ms").over(Window.partitionBy("symbol", "_b").orderBy("t_ms", "arrival"))
    rows = seeded(frames.select("symbol", "t_ms", "arrival"), "symbol", ["t_ms", "arrival"])
    own = rows.select("symbol", before.alias("start_ms"), F.col("t_ms").alias("end_ms"), "_seed").where("not _seed").drop("_seed")
    return own.where(F.col("end_ms") - F.col("start_ms") >= least_ms).withColumn("seconds", (F.col("end_ms") - F.col("start_ms")) / 1000)


def gap_hours(gap: DataFrame) -> DataFrame:
    """Hours of the day that each gap touches."""
    hour = 3_600_000
    slots = F.sequence(F.floor(F.col("start_ms") / hour), F.floor(F.col("end_ms") / hour))
    return gap.select("symbol", "start_ms", F.explode(slots).alias("h")).select("symbol", "start_ms", F.pmod("h", F.lit(24)).alias("hour")).distinct()


def recovered(gap: DataFrame, archive: DataFrame) -> DataFrame:
    """Archive trades inside ``(start, end]`` of a gap of their symbol, without null or NaN numbers.

    Gaps of a symbol do not overlap, so the only candidate of a trade is the last gap that starts
    before it: an as-of join, not a range join.
    """
    from .asof import asof

    starts = gap.select("symbol", F.col("start_ms").alias("t_ms"), F.col("start_ms").alias("arrival"), "start_ms", "end_ms")
    met = asof(archive, starts, ["start_ms", "end_ms"], strict=True)
    good = F.col("price").isNotNull() & F.col("size").isNotNull() & ~F.isnan("price") & ~F.isnan("size")
    return met.where(F.col("end_ms").isNotNull() & (F.col("t_ms") <= F.col("end_ms")) & good)


def gap_states(gap: DataFrame, rows: DataFrame, as_of_ms: int, give_up_ms: int = 86_400_000) -> DataFrame:
    """``gap`` (``symbol, start_ms, end_ms``) with ``n`` of the ``rows`` ``recovered`` for it, and its ``state``.

    A gap is ``recovered`` with the first row; without one it is ``waiting``, as archives lag, until it has been over for
    ``give_up_ms``: then it is ``lost``.
    """
    own = rows.groupBy("symbol", "start_ms").agg(F.count("*").alias("n"))
    told = gap.select("symbol", "start_ms", "end_ms").join(own, ["symbol", "start_ms"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    late = F.lit(as_of_ms) - F.col("end_ms") > give_up_ms
    return told.select("symbol", "start_ms", "end_ms", "n", F.when(F.col("n") > 0, "recovered").when(late, "lost").otherwise("waiting").alias("state"))


def monitor(trades: DataFrame, rows: int = 100) -> DataFrame:
    """Range volatility in percent, volume and mean size over the last ``rows`` trades."""
    w = Window.partitionBy("symbol", "_b").orderBy("_pos").rowsBetween(-(rows - 1), 0)
    low = F.min("price").over(w)
    out = chunked(trades, ["symbol"], ["arrival"], rows - 1).select("_halo", "symbol", "t_ms", "arrival", (ratio(F.max("price").over(w) - low, low) * 100).alias("range_pct"), F.sum("size").over(w).alias("volume"), F.avg("size").over(w).alias("mean_size"))
    return out.where("not _halo").drop("_halo")
