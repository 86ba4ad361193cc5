"""``spark-submit tickloom/cli.py COMMAND ...``: the offline commands.

Results are small reports and go to standard output as JSON lines, or as Parquet to ``--out``.
"""

from __future__ import annotations

import argparse
import inspect
import json
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import timeframe_ms
from tickloom.operators import backtest, blocks, candles, l4, ofi, validate
from tickloom.sources import archive, diffs, frames, sinks
from tickloom.streaming import live

def _default(operator, name: str):
    return inspect.signature(operator).parameters[name].default


#: defaults of every threshold, as the operators have them
SETTINGS = {
    "ofi_windows_ms": [1000, 10_000], "ofi_horizons_ms": [1000, 5000], "rolling_window_ms": _default(ofi.rolling_signal, "window_ms"), "rolling_halflife": _default(ofi.rolling_signal, "halflife"), "fee_bps": _default(backtest.run, "fee_bps"),
    "slippage_bps": _default(backtest.run, "slippage_bps"), "capital": _default(backtest.run, "capital"), "price_jump": _default(validate.trade_findings, "jump"), "volume_spike": _default(validate.trade_findings, "spike"), "wide_spread": _default(validate.book_findings, "wide"),
    "future_ms": _default(validate.time_findings, "future_ms"), "stale_ms": _default(validate.time_findings, "stale_ms"), "retention_days": _default(sinks.expire, "days"), "buffer_rows": _default(candles.retained, "most"), "anomalies_kept": _default(l4.newest_anomalies, "n"),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickloom")
    top.add_argument("--out", help="write Parquet here instead of printing")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("ofi", help="order-flow imbalance read of capture or archive lines")
    p.add_argument("paths", nargs="+")
    p.add_argument("--symbol")
    p.add_argument("--windows", default=",".join(f"{x / 1000:g}" for x in SETTINGS["ofi_windows_ms"]), help="seconds")
    p.add_argument("--horizons", default=",".join(f"{x / 1000:g}" for x in SETTINGS["ofi_horizons_ms"]), help="seconds")
    p = sub.add_parser("replay", help="final order book of diff lines, with anomaly counts")
    p.add_argument("paths", nargs="+")
    p.add_argument("--snapshot")
    p.add_argument("--strict", action="store_true")
    p = sub.add_parser("validate", help="strict read of diff lines and a verdict on each coin's book; exit code 1 if one is not sound")
    p.add_argument("paths", nargs="+")
    p.add_argument("--coins", help="comma-separated; all if left out")
    p = sub.add_parser("candles", help="candles of a trades table")
    p.add_argument("path")
    p.add_argument("--timeframe", default="1m")
    p = sub.add_parser("backtest", help="backtest of OHLCV CSV files")
    p.add_argument("path")
    p.add_argument("--symbol", default="?")
    p.add_argument("--strategy", choices=["hold", "sma", "rsi"], default="hold")
    p.add_argument("--fee-bps", type=float, default=SETTINGS["fee_bps"])
    p.add_argument("--slippage-bps", type=float, default=SETTINGS["slippage_bps"])
    p = sub.add_parser("collect", help="archive paths of symbols and days")
    p.add_argument("symbols")
    p.add_argument("start")
    p.add_argument("end", nargs="?", help="yesterday if left out")
    p.add_argument("--types", default="l2Book,trades")
    p = sub.add_parser("stream", help="candles of spooled trades, once over what is there")
    p.add_argument("path")
    p.add_argument("checkpoint")
    p.add_argument("--width", default="1 minute")
    sub.add_parser("settings", help="the defaults")
    return top


def feed(spark: SparkSession, paths: list[str], strict: bool) -> tuple[DataFrame, DataFrame]:
    """Events and blocks of diff files, with the place of their line over all files, in the order given, as ``arrival``."""
    own = []
    for i, path in enumerate(paths):
        lines = archive.lz4_lines(spark, path) if path.endswith(".lz4") else diffs.lines(spark, path)
        own.append(lines.select("raw", (F.col("ordinal") + (i << 40)).alias("ordinal")))
    lines = reduce(DataFrame.unionByName, own)
    at = F.col("ordinal").alias("arrival")
    return diffs.events(lines, strict).select("*", at).withColumn("pos", F.col("pos").cast("bigint")), diffs.blocks(lines).select("*", at)


def frame(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.command == "ofi":
        lines = None
        for path in args.paths:
            own = archive.lz4_lines(spark, path).drop("file") if path.endswith(".lz4") else diffs.lines(spark, path).select("raw", "ordinal")
            lines = own if lines is None else lines.unionByName(own)
        ms = lambda text: [round(float(x) * 1000) for x in text.split(",")]
        return ofi.analyze(frames.capture_quotes(lines, args.symbol), ms(args.windows), ms(args.horizons))
    if args.command == "replay":
        events, seen = feed(spark, args.paths, args.strict)
        events, loads = events.where("reason is null").drop("ordinal", "time_ms", "reason"), None
        calendar, last = blocks.calendar(seen), seen.agg(F.max_by("height", "arrival").alias("height"))
        if args.snapshot:
            # what the files say comes after the snapshot, whatever its height
            whole = diffs.snapshots(spark.read.text(args.snapshot, wholetext=True).select(F.col("value").alias("raw"))).withColumn("arrival", F.lit(-1).cast("long"))
            events, loads = l4.with_snapshot(whole, events, "arrival"), whole.select("coin", "arrival", "height").distinct()
        orders = l4.final_orders(events, "arrival")
        tops = l4.top(l4.levels(orders, l4.level_texts(events, "arrival"), "arrival")).groupBy("coin").pivot("side", ["B", "A"]).agg(F.first("px").alias("px"), F.first(F.col("size").cast("double")).alias("size"))
        odd = l4.anomalies(events, calendar, loads, "arrival").groupBy("coin").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("type", "n")))).alias("anomalies"))
        stale = blocks.gap_counts(blocks.epochs(events.where("arrival >= 0"), calendar, loads), calendar).select("coin", (F.col("n") > 0).alias("stale"))
        heights = events.select("coin", F.lit(0).alias("_k")).distinct().join(F.broadcast(last.withColumn("_k", F.lit(0))), "_k")
        return l4.checksum(orders, events, heights, "arrival").join(tops, "coin", "left").join(odd, "coin", "left").join(stale, "coin", "left")
    if args.command == "validate":
        events, seen = feed(spark, args.paths, strict=True)
        if args.coins:
            events = events.where(F.col("coin").isin(args.coins.split(",")))
        return l4.integrity(events, blocks.calendar(seen)).orderBy("coin")
    if args.command == "candles":
        return candles.tumbling(spark.read.parquet(args.path), timeframe_ms(args.timeframe))
    if args.command == "backtest":
        strategy = {"hold": backtest.buy_and_hold, "sma": backtest.crossover(), "rsi": backtest.rsi_bands()}[args.strategy]
        return backtest.metrics(backtest.run(archive.price_csv(spark, args.path, args.symbol), strategy, args.fee_bps, args.slippage_bps, SETTINGS["capital"]))
    if args.command == "collect":
        end = F.lit(args.end).cast("date") if args.end else F.date_sub(F.current_date(), 1)
        spans = spark.createDataFrame([(s,) for s in args.symbols.split(",")], "symbol string").select("symbol", F.lit(args.start).cast("date").alias("first_day"), end.alias("last_day"))
        return archive.requests(spans, args.types.split(","))
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in SETTINGS.items()], "name string, value string")


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tickloom {args.command}").getOrCreate()
    if args.command == "stream":
        stream = live.candles(live.read(spark, args.path, live.TRADES), args.width)
        query = live.write(stream, (lambda df: df.write.mode("append").parquet(args.out)) if args.out else (lambda df: df.show(50, False)), args.checkpoint)
        query.awaitTermination()
        return 0
    if args.command == "validate":
        try:
            told = frame(spark, args).toJSON().collect()  # a row a coin
        except Exception as e:  # noqa: BLE001 - a line that drifted from the format is a verdict
            print(f"strict read failed: {e}", file=sys.stderr)
            return 1
        print("\n".join(told))
        return int(not all(json.loads(x)["sound"] for x in told))
    out = frame(spark, args)
    if args.out:
        out.write.parquet(args.out)
    else:
        for row in out.toJSON().toLocalIterator():
            print(row)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
