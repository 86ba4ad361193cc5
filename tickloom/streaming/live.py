"""Structured Streaming: spooled frames in, candles, findings, books and points out.

Sources are files (a spool), the tail of a growing file (``sources.tail``) or any stream with the same columns, so offsets can be replayed and no row is
shed under pressure: ``maxFilesPerTrigger`` limits a batch instead.  Event time is a TIMESTAMP column
``ts`` made from ``t_ms``.

Keyed state is kept by entry (``transformWithState``): a batch reads and writes the entries its rows touch.
It needs the RocksDB state store: ``stateful(spark)`` sets it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from decimal import Decimal, InvalidOperation
from itertools import groupby

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from ..operators.candles import ohlcv
from ..operators.validate import gap_states, recovered
from ..sources.sinks import BatchSink, Sink, parquet_once

TRADES = "symbol string, t_ms long, price double, size double, side string, tid long, arrival long"
DIFFS = "coin string, arrival long, height long, pos long, oid long, side string, px string, kind string, sz string, new_sz string, orig_sz string"
BLOCKS = "arrival long, height long"


def stateful(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def read(spark: SparkSession, path: str, schema: str, files: int = 100, kind: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(path)


def timed(points: DataFrame, late: str = "1 hour") -> DataFrame:
    return points.withColumn("ts", F.timestamp_millis("t_ms")).withWatermark("ts", late)


def candles(trades: DataFrame, width: str = "1 minute", late: str = "1 hour") -> DataFrame:
    """Tumbling candles; a window is final once the watermark has passed it."""
    per = timed(trades, late).groupBy("symbol", F.window("ts", width).alias("w")).agg(*ohlcv(F.struct("t_ms", "arrival")))
    return per.select("symbol", F.unix_millis("w.start").alias("start_ms"), "open", "high", "low", "close", "volume", "trades", "vwap")


def dedup(trades: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each trade id once within the watermark, for batches that may be delivered twice."""
    return timed(trades, late).dropDuplicatesWithinWatermark(["symbol", "tid"])


TRAILING = "symbol string, t_ms long, arrival long, open double, high double, low double, close double, volume double, trades long, vwap double"


class Trailing(StatefulProcessor):
    """The trades of the last two widths of a symbol, in one entry per width of time.

    An entry goes when all of it has left the window of every later trade, and all of them
    when the watermark passes the last one.
    """

    def __init__(self, width_ms: int) -> None:
        self.width = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getMapState("spans", "span long", "arrival array<long>, t array<long>, p array<double>, s array<double>")
        self.newest = handle.getValueState("newest", "t long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = sorted(rows, key=lambda r: r.arrival)
        newest = self.newest.get()[0] if self.newest.exists() else 0
        kept = range((newest - 2 * self.width) // self.width, newest // self.width + 1)
        held = {k: self.spans.getValue((k,)) for k in kept if self.spans.containsKey((k,))} if self.spans.exists() else {}
        old = sorted(x for v in held.values() for x in zip(*v))
        arrival, t, p, s = (np.array(c) for c in zip(*old, *((r.arrival, r.t_ms, r.price, r.size) for r in rows)))
        n, first = len(old), 0
        # what no later row of the batch asks for is passed over
        needed = np.minimum.accumulate((t[n:] - self.width)[::-1])[::-1]
        for i in range(n, len(t)):
            while t[first] < needed[i - n]:
                first += 1
            own = first + np.flatnonzero((t[first:i] >= t[i] - self.width) & (t[first:i] < t[i]))
            if len(own):
                px, vol = p[own], s[own].sum()
                vwap = (px * s[own]).sum() / vol if vol > 0 else px[-1]
                yield Row(symbol=key[0], t_ms=int(t[i]), arrival=int(arrival[i]), open=float(px[0]), high=float(px.max()), low=float(px.min()), close=float(px[-1]), volume=float(vol), trades=len(own), vwap=float(vwap))
        newest = int(max(newest, t[n:].max()))
        span = t // self.width
        for k in set(held) - set(range((newest - 2 * self.width) // self.width, newest // self.width + 1)):
            self.spans.removeKey((k,))
        for k in np.unique(span[n:]):
            if k >= (newest - 2 * self.width) // self.width:
                own = span == k
                self.spans.updateValue((int(k),), tuple(c[own].tolist() for c in (arrival, t, p, s)))
        self.newest.update((newest,))
        self.handle.registerTimer(newest + 2 * self.width)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.newest.exists() and expiredTimerInfo.getExpiryTimeInMs() >= self.newest.get()[0] + 2 * self.width:
            self.spans.clear()
            self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def trailing(trades: DataFrame, width_ms: int = 60_000, late: str = "1 hour") -> DataFrame:
    """Trailing candles per trade: of the trades that came before it, those of the ``width_ms`` before its time."""
    return timed(trades, late).groupBy("symbol").transformWithState(Trailing(width_ms), TRAILING, "Append", "EventTime")


TOPS = "coin string, arrival long, height long, n_diffs long, bid_px string, bid_sz double, ask_px string, ask_sz double, mid double, crossed boolean, stale boolean, anomalies long"


def _number(text: str | None) -> Decimal | None:
    try:
        x = Decimal(text)
    except (InvalidOperation, TypeError):
        return None
    return x if x.is_finite() else None


class Books(StatefulProcessor):
    """A coin's book: an entry per open order and one per price level, written only where a diff touches them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.orders = handle.getMapState("orders", "oid long", "side string, price string, size string")
        self.levels = handle.getMapState("levels", "side string, price string", "px string, size string, orders long")
        self.head = handle.getValueState("head", "height long, stale boolean, anomalies long")

    def _load(self) -> None:
        """The levels of the batch's book; orders are looked up one by one."""
        self.sides: dict[str, dict[Decimal, list]] = {"B": {}, "A": {}}
        if self.levels.exists():
            for (side, price), (px, size, n) in self.levels.iterator():
                self.sides[side][Decimal(price)] = [px, Decimal(size), n]
        self.touched: set[tuple[str, Decimal]] = set()

    def _save(self) -> None:
        for side, price in self.touched:
            level, key = self.sides[side].get(price), (side, f"{price.normalize():f}")
            if level:
                self.levels.updateValue(key, (level[0], f"{level[1]:f}", level[2]))
            elif self.levels.exists() and self.levels.containsKey(key):
                self.levels.removeKey(key)

    def _order(self, oid: int) -> tuple[str, Decimal, Decimal] | None:
        if not (self.orders.exists() and self.orders.containsKey((oid,))):
            return None
        side, price, size = self.orders.getValue((oid,))
        return side, Decimal(price), Decimal(size)

    def _move(self, side: str, price: Decimal, px: str, by: Decimal, count: int) -> None:
        level = self.sides[side].setdefault(price, [px, Decimal(0), 0])
        level[1] += by
        level[2] += count
        if not level[2]:
            del self.sides[side][price]
        self.touched.add((side, price))

    def _drop(self, oid: int, held: tuple[str, Decimal, Decimal]) -> None:
        self._move(held[0], held[1], "", -held[2], -1)
        self.orders.removeKey((oid,))

    def _apply(self, r: Row) -> int:
        """One diff; returns how many anomalies it was."""
        held = self._order(r.oid)
        if r.kind == "new":
            size, price = _number(r.sz), _number(r.px)
            if size is None or price is None:
                return 1
            if held:  # replaced: to the back of its queue
                self._drop(r.oid, held)
            self.orders.updateValue((r.oid,), (r.side, f"{price.normalize():f}", f"{size:f}"))
            self._move(r.side, price, r.px, size, 1)
            return int(held is not None)
        if r.kind == "update" and held:
            size = _number(r.new_sz)
            if size is None:
                return 1
            odd = int(r.orig_sz is not None and _number(r.orig_sz) != held[2])
            if size <= 0:
                self._drop(r.oid, held)
                return odd + 1
            self.orders.updateValue((r.oid,), (held[0], f"{held[1].normalize():f}", f"{size:f}"))
            self._move(held[0], held[1], "", size - held[2], 0)
            return odd
        if r.kind == "remove" and held:
            self._drop(r.oid, held)
            return 0
        return 1

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        height, stale, anomalies = self.head.get() if self.head.exists() else (None, False, 0)
        self._load()
        for arrival, block in groupby(sorted(rows, key=lambda r: (r.arrival, r.pos)), lambda r: r.arrival):
            block = list(block)
            given = [r for r in block if r.kind not in ("block", "reset")]
            if any(r.kind == "reset" for r in block):
                self.touched |= {(side, price) for side in "BA" for price in self.sides[side]}
                self.sides, stale, anomalies = {"B": {}, "A": {}}, False, 0
                self.orders.clear()
            elif height is None and not given:
                continue  # no book yet
            elif height is not None and block[0].height != height + 1:
                stale, anomalies = True, anomalies + 1
            height = block[0].height
            anomalies += sum(self._apply(r) for r in given)
            if given and len(given) == sum(r.kind != "block" for r in block):
                bid, ask = max(self.sides["B"], default=None), min(self.sides["A"], default=None)
                told = lambda side, price: (None, None) if price is None else (self.sides[side][price][0], float(self.sides[side][price][1]))
                (bid_px, bid_sz), (ask_px, ask_sz), both = told("B", bid), told("A", ask), bid is not None and ask is not None
                yield Row(coin=key[0], arrival=arrival, height=height, n_diffs=len(given), bid_px=bid_px, bid_sz=bid_sz, ask_px=ask_px, ask_sz=ask_sz, mid=float((bid + ask) / 2) if both else None, crossed=both and bid >= ask, stale=stale, anomalies=anomalies)
        self._save()
        if height is not None:
            self.head.update((height, stale, anomalies))

    def close(self) -> None:
        pass


def book_tops(diffs: DataFrame, blocks: DataFrame | None = None, coins: list[str] | None = None) -> DataFrame:
    """Top of the book after each block with a coin's diffs, and whether the book is ``stale``.

    With ``blocks`` (the chain's, also quiet ones) each of the ``coins`` sees every block, so only
    a block the chain misses, repeats or rewinds makes a book stale; without them a coin knows the blocks of its own diffs only and
    ``stale`` stays false unless diffs skip heights.  A row of kind ``reset`` empties the book and makes it good again: a
    snapshot is a reset and its orders as new ones, of one arrival and at the snapshot's height.
    """
    if blocks is not None:
        if not coins:
            raise ValueError("blocks are dealt to the coins that are followed: name them")
        none = lambda t: F.lit(None).cast(t)
        seen = blocks.select(F.explode(F.array(*[F.lit(c) for c in coins])).alias("coin"), "arrival", "height", F.lit(-1).cast("long").alias("pos"), none("long").alias("oid"), none("string").alias("side"), none("string").alias("px"), F.lit("block").alias("kind"), *[none("string").alias(c) for c in ("sz", "new_sz", "orig_sz")])
        diffs = diffs.where(F.col("coin").isin(*coins)).select(seen.columns).unionByName(seen)
    return diffs.groupBy("coin").transformWithState(Books(), TOPS, "Append", "None")


GAPS = "symbol string, start_ms long, end_ms long"


class Silences(StatefulProcessor):
    """The last time of a symbol, and the silences of at least ``least_ms`` between its frames."""

    def __init__(self, least_ms: int) -> None:
        self.least = least_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "t long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        for t in sorted(r.t_ms for r in rows):
            if last is not None and t - last >= self.least:
                yield Row(symbol=key[0], start_ms=last, end_ms=t)
            last = t if last is None else max(last, t)
        self.last.update((last,))

    def close(self) -> None:
        pass


def silences(frames: DataFrame, least_ms: int) -> DataFrame:
    """``symbol, start_ms, end_ms`` of silences, as they end; a frame that comes later than its successors opens none."""
    return frames.select("symbol", "t_ms").groupBy("symbol").transformWithState(Silences(least_ms), GAPS, "Append", "None")


def attempt(due: DataFrame, archive: DataFrame, sink: BatchSink, pending: str, number: int, as_of_ms: int) -> None:
    """Store what ``archive`` has of the gaps ``due`` as batch ``number``, and keep those that wait in ``pending/batch=number``.

    What is recovered goes to the sink only, not through operators that hold the present.
    """
    rows = recovered(due, archive).persist()
    try:
        sink(rows.select(*archive.columns).withColumn("backfilled", F.lit(True)), number)
        parquet_once(pending)(gap_states(due, rows, as_of_ms).where("state = 'waiting'").select("symbol", "start_ms", "end_ms"), number)
    finally:
        rows.unpersist()


def backfill(gaps: DataFrame, archive: Callable[[SparkSession], DataFrame], sink: BatchSink, pending: str, checkpoint: str, now: Callable[[], int]) -> StreamingQuery:
    """Try to fill the gaps of a stream from the archive; each batch tries those that still wait once more.

    The sink has to know a batch again, as ``parquet_once`` does.
    """

    def each(new: DataFrame, batch: int) -> None:
        spark = new.sparkSession
        try:
            new = new.unionByName(spark.read.schema(GAPS).parquet(f"{pending}/batch={batch - 1}"))
        except AnalysisException:  # the first batch
            pass
        attempt(new, archive(spark), sink, pending, batch, now())

    return write_once(gaps, each, checkpoint)


def write(stream: DataFrame, sink: Sink, checkpoint: str) -> StreamingQuery:
    """Run over what is there and stop; the checkpoint makes retries exact per batch."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: sink(df)).start()


def write_once(stream: DataFrame, sink: BatchSink, checkpoint: str) -> StreamingQuery:
    """As ``write``, for sinks that know a batch again when a run that failed is begun anew."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()


class FeedStats(StreamingQueryListener):
    """What the queries of a session have counted: ``batches``, ``rows``, ``late`` ones and all ``observe``d sums.

    A row is late if a stateful operator drops it because the watermark has passed it; aggregations put rows
    together first, so count late rows where rows are still single, as in ``dedup``.
    """

    def __init__(self) -> None:
        self.totals: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.totals.update(batches=1, rows=p.numInputRows, late=sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
        for row in p.observedMetrics.values():
            self.totals.update({k: v for k, v in row.asDict().items() if v})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
