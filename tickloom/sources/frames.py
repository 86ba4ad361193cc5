"""Feed frames: one JSON text per row, routed by channel into typed rows.

Every parser takes a DataFrame with ``raw`` (and any other columns, which stay) and drops what is not
its own.  Text that is no JSON has no channel and is dropped by all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import basis_bps, number, once

LEVEL = "struct<px:string,sz:string,n:int>"


def subscriptions(symbols: list[str], bbo: bool = False, user: str | None = None) -> list[dict]:
    """Subscription messages of a feed client."""
    kinds = ["l2Book", "trades", "activeAssetCtx"] + ["bbo"] * bbo
    subs = [{"type": k, "coin": s} for s in symbols for k in kinds] + [{"type": "allMids"}] + [{"type": "userEvents", "user": user}] * bool(user)
    return [{"method": "subscribe", "subscription": s} for s in subs]


def channel(frames: DataFrame) -> DataFrame:
    return frames.withColumn("channel", F.get_json_object("raw", "$.channel"))


def _data(frames: DataFrame, name: str, schema: str) -> DataFrame:
    """Frames of a channel with their ``data`` as ``_d``, parsed once; only texts that have the channel's name are."""
    rest = [c for c in frames.columns if c != "raw"]
    parsed = F.when(F.contains("raw", F.lit(f'"{name}"')), F.from_json("raw", f"channel string, data {schema}"))
    return once(frames, rest, F.struct("raw", parsed.alias("_f"))).where(F.col("_f.channel") == name).withColumn("_d", F.col("_f.data"))


def _rest(frames: DataFrame) -> list[Column]:
    return [F.col(c) for c in frames.columns if c != "raw"]


def level_books(frames: DataFrame, symbols: list[str], now_ms: int) -> DataFrame:
    """``symbol, t_ms, bids, asks``; foreign coins go, a missing time is ``now_ms``."""
    d = _data(frames, "l2Book", f"struct<coin:string,levels:array<array<{LEVEL}>>,time:bigint>")
    side = lambda i: F.coalesce(F.get("_d.levels", F.lit(i)), F.array().cast(f"array<{LEVEL}>"))
    return d.where(F.col("_d.coin").isin(symbols)).select(*_rest(frames), F.col("_d.coin").alias("symbol"), F.coalesce("_d.time", F.lit(now_ms)).alias("t_ms"), side(0).alias("bids"), side(1).alias("asks"))


def trades(frames: DataFrame, symbols: list[str]) -> DataFrame:
    """One row per trade of a frame."""
    d = _data(frames, "trades", "array<struct<coin:string,px:string,sz:string,side:string,time:bigint,tid:bigint>>")
    each = d.select(*_rest(frames), F.explode("_d").alias("t")).where(F.col("t.coin").isin(symbols))
    return each.select(*_rest(frames), F.col("t.coin").alias("symbol"), F.col("t.time").alias("t_ms"), number(F.col("t.px")).alias("price"), number(F.col("t.sz")).alias("size"), F.col("t.side").alias("side"), F.col("t.tid").alias("tid"))


def mids(frames: DataFrame, symbols: list[str], now_ms: int) -> DataFrame:
    d = _data(frames, "allMids", "struct<mids:map<string,string>>")
    each = d.select(*_rest(frames), F.explode("_d.mids").alias("symbol", "px")).where(F.col("symbol").isin(symbols))
    return each.select(*_rest(frames), "symbol", F.lit(now_ms).alias("t_ms"), number(F.col("px")).alias("mid"))


def bbo(frames: DataFrame, symbols: list[str]) -> DataFrame:
    """Either side may be null."""
    d = _data(frames, "bbo", f"struct<coin:string,time:bigint,bbo:array<{LEVEL}>>").where(F.col("_d.coin").isin(symbols))
    return d.select(*_rest(frames), F.col("_d.coin").alias("symbol"), F.col("_d.time").alias("t_ms"), F.get("_d.bbo", F.lit(0)).alias("bid"), F.get("_d.bbo", F.lit(1)).alias("ask"))


def contexts(frames: DataFrame, symbols: list[str], now_ms: int) -> DataFrame:
    """Asset contexts: numbers or null (booleans are no numbers), all-null rows go; the basis in points needs an oracle above zero."""
    fields = {"mark": "markPx", "oracle": "oraclePx", "mid": "midPx", "open_interest": "openInterest", "funding": "funding", "premium": "premium"}
    texts = ",".join(f"{p}:string" for p in fields.values())
    d = _data(frames, "activeAssetCtx", f"struct<coin:string,ctx:struct<{texts}>>").where(F.col("_d.coin").isin(symbols))
    own = d.select(*_rest(frames), F.col("_d.coin").alias("symbol"), F.lit(now_ms).alias("t_ms"), *[number(F.col(f"_d.ctx.{p}")).alias(n) for n, p in fields.items()])
    mark, oracle = F.col("mark"), F.col("oracle")
    return own.where(F.coalesce(*fields).isNotNull()).withColumns({"basis": mark - oracle, "basis_bps": basis_bps(mark, oracle)})


def user_events(frames: DataFrame) -> DataFrame:
    own = frames.where(F.get_json_object("raw", "$.channel").isin("user", "userEvents"))
    return own.select(*_rest(frames), F.lit("USER_EVENT").alias("symbol"), F.parse_json(F.get_json_object("raw", "$.data")).alias("data"))


def unwrap(lines: DataFrame) -> DataFrame:
    """Archive lines with or without their wrapper."""
    return lines.withColumn("raw", F.coalesce(F.get_json_object("raw", "$.raw.data"), F.col("raw")))


def archive_books(lines: DataFrame) -> DataFrame:
    d = unwrap(lines).withColumn("_d", F.from_json("raw", f"coin string, time bigint, levels array<array<{LEVEL}>>")).where("_d.coin is not null")
    return d.select("_d.coin", F.timestamp_millis("_d.time").alias("ts"), F.col("_d.time").alias("t_ms"), F.get("_d.levels", F.lit(0)).alias("bids"), F.get("_d.levels", F.lit(1)).alias("asks")).withColumnRenamed("coin", "symbol")


def archive_trades(lines: DataFrame) -> DataFrame:
    """Lines that hold a trade or a list of trades."""
    raw = F.trim("raw")
    many = unwrap(lines).withColumn("raw", F.when(raw.startswith("["), raw).otherwise(F.concat(F.lit("["), raw, F.lit("]"))))
    each = many.select(F.explode(F.from_json("raw", "array<struct<coin:string,px:string,sz:string,side:string,time:bigint,tid:bigint>>")).alias("t")).where("t.coin is not null")
    return each.select(F.col("t.coin").alias("symbol"), F.timestamp_millis("t.time").alias("ts"), F.col("t.time").alias("t_ms"), number(F.col("t.px")).alias("price"), number(F.col("t.sz")).alias("size"), F.col("t.side").alias("side"), F.col("t.tid").alias("tid"))


def capture_quotes(lines: DataFrame, symbol: str | None = None) -> DataFrame:
    """Best bids and asks of capture and archive lines of any known shape; others are skipped.

    ``lines`` has ``raw`` and ``ordinal``.  Top-of-book records, level records, wrapped archive lines and
    bare archive lines are told apart by which paths they have.
    """
    at = lambda p: F.get_json_object("raw", p)
    coin = F.coalesce(at("$.symbol"), at("$.raw.data.coin"), at("$.coin"))
    t = F.coalesce(at("$.data.timestamp_ms"), at("$.raw.data.time"), at("$.time")).try_cast("bigint")
    side = lambda i, f: F.coalesce(at(f"$.data.{('bid', 'ask')[i]}.{f}"), at(f"$.data.{('bids', 'asks')[i]}[0].{f}"), at(f"$.raw.data.levels[{i}][0].{f}"), at(f"$.levels[{i}][0].{f}")).try_cast("double")
    out = lines.select(coin.alias("symbol"), t.alias("t_ms"), F.col("ordinal").alias("arrival"), side(0, "px").alias("bid_px"), side(0, "sz").alias("bid_sz"), side(1, "px").alias("ask_px"), side(1, "sz").alias("ask_sz"))
    out = out.dropna(subset=["symbol", "t_ms", "bid_px", "bid_sz", "ask_px", "ask_sz"])
    return out if symbol is None else out.where(F.col("symbol") == symbol)


def capture_trades(lines: DataFrame, symbol: str | None = None) -> DataFrame:
    """Trades of capture lines; a zero or missing time is dropped."""
    at = lambda p: F.get_json_object("raw", p)
    out = lines.where(at("$.data_type") == "trade").select(at("$.symbol").alias("symbol"), at("$.data.timestamp_ms").try_cast("bigint").alias("t_ms"), F.col("ordinal").alias("arrival"), at("$.data.price").try_cast("double").alias("price"), at("$.data.size").try_cast("double").alias("size"), at("$.data.side").alias("side"))
    out = out.where(F.coalesce(F.col("t_ms") != 0, F.lit(False)) & F.col("price").isNotNull())
    return out if symbol is None else out.where(F.col("symbol") == symbol)
