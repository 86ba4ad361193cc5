"""Order-level books from diffs: final state, queues, anomalies and tops of all blocks, as queries.

An order's life: its last valid ``new`` gives side, price and place in the queue; later valid updates
resize it in place; a removal, or an update to zero or less, ends it.  Diffs of a coin are ordered by
(``clock``, pos), where ``clock`` is the height or, for feeds that repeat or rewind heights, the arrival of
the block.  Diffs of other coins never matter: everything is keyed by coin.

Prices and sizes are texts (``px, sz, new_sz, orig_sz``; numbers are taken by their text) and stay exact:
``key`` is the price as DECIMAL(38,18), so "100.0" and "100" are one level, and sizes are DECIMAL(38,18) with the text
they came as beside them.  A text that is no number of at most 20 digits before and 18 after the point is bad.
A level is called by the price text of the order that opened it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import DECIMAL, exact, once, plain
from . import blocks as chain
from .asof import newest

LEVEL = ["coin", "side", "key"]
#: blocks whose nodes above are looked up together, as a power of two (even)
COARSE = 6


def _rules() -> tuple[Column, Column, Column]:
    """Which diffs place an order, which resize it, and which end it if it is there."""
    new = (F.col("kind") == "new") & exact("sz").isNotNull() & exact("px").isNotNull()
    update = (F.col("kind") == "update") & exact("new_sz").isNotNull()
    return F.coalesce(new, F.lit(False)), F.coalesce(update, F.lit(False)), F.coalesce((F.col("kind") == "remove") | (update & (exact("new_sz") <= 0)), F.lit(False))


def _read(diffs: DataFrame, clock: str, *more: str) -> DataFrame:
    """``diffs`` with their prices and sizes read once (``key, size, to``, and ``_more`` of ``more``), and ``new, update, ends`` of ``_rules``."""
    kind, texts = F.col("kind"), ("px", "sz", "new_sz", *more)
    casts = [F.when(kind == "new", exact("px")).alias("key"), F.when(kind == "new", exact("sz")).alias("size"), F.when(kind == "update", exact("new_sz")).alias("to"), *[exact(c).alias(f"_{c}") for c in more]]
    read = once(diffs, ["coin", "oid", "side", "kind", clock, "pos", *[F.col(c).cast("string").alias(c) for c in texts]], F.struct(*casts))
    sure = lambda c: F.coalesce(c, F.lit(False))
    return read.withColumns({"new": sure(F.col("size").isNotNull() & F.col("key").isNotNull()), "update": F.col("to").isNotNull(), "ends": sure((kind == "remove") | (F.col("to") <= 0))})


def _dealt(diffs: DataFrame) -> DataFrame:
    """``diffs`` by order, in as many partitions as a shuffle has.

    Diffs compress well and a window's rows don't: partitions that are put together by the bytes shuffled hold many times that in memory.
    """
    return diffs.repartition(int(diffs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "coin", "oid")


def _lives(rows: DataFrame, clock: str, *more: Column) -> DataFrame:
    """``coin, oid, alive, side, px, key, size, size_text``, ``clock`` and ``pos`` of every order of ``_read`` rows, and ``more`` aggregates.

    One pre-aggregated group per order: no diff history is collected.
    """
    placed = F.struct(clock, "pos", "side", "px", "key", "size", F.col("sz").alias("size_text"))
    resize = F.struct(clock, "pos", F.col("to").alias("size"), F.col("new_sz").alias("size_text"))
    life = rows.groupBy("coin", "oid").agg(F.max(F.when(F.col("new"), placed)).alias("n"), F.max(F.when(F.col("ends"), F.struct(clock, "pos"))).alias("r"), F.max(F.when(F.col("update"), resize)).alias("u"), *more)
    names = [c for c in life.columns if c not in ("coin", "oid", "n", "r", "u")]
    born = F.struct(F.col(f"n.{clock}"), F.col("n.pos"))
    alive = F.col("n").isNotNull() & (F.col("r").isNull() | (F.col("r") < born))
    resized = F.col("u").isNotNull() & (F.struct(F.col(f"u.{clock}"), F.col("u.pos")) > born)
    now = lambda c: F.when(resized, F.col(f"u.{c}")).otherwise(F.col(f"n.{c}")).alias(c)
    return life.select("coin", "oid", F.coalesce(alive, F.lit(False)).alias("alive"), "n.side", "n.px", "n.key", now("size"), now("size_text"), f"n.{clock}", "n.pos", *names)


def final_orders(diffs: DataFrame, clock: str = "height") -> DataFrame:
    """``coin, oid, side, px, key, size, size_text``, ``clock`` and ``pos`` of the orders alive after all diffs."""
    # most orders have few diffs: they are dealt out first and ordered once, not per task before
    return _lives(_read(_dealt(diffs), clock), clock).where("alive").drop("alive")


def level_texts(diffs: DataFrame, clock: str = "height") -> DataFrame:
    """``coin, side, key, px``, ``clock`` and ``pos``: what each price level is called from when on.

    The order that meets a level empty names it, that is one before which all earlier ones of the level have died.  A level that
    is called the same again and again has one row for it.
    """
    rows = _read(_dealt(diffs), clock).where("new or ends")
    lives = rows.withColumn("died", F.lead(F.struct(clock, "pos")).over(Window.partitionBy("coin", "oid").orderBy(clock, "pos"))).where("new").select(*LEVEL, "px", clock, "pos", "died")
    w, at = Window.partitionBy(*LEVEL).orderBy(clock, "pos"), F.struct(clock, "pos")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    # at one moment the order that goes goes first
    gone = F.coalesce(F.max(F.col("died").isNull()).over(past), F.lit(False)), F.max("died").over(past)
    opened = lives.withColumns({"_stands": gone[0], "_last": gone[1]}).where(~F.col("_stands") & (F.col("_last").isNull() | (F.col("_last") <= at)))
    return opened.withColumn("_was", F.lag("px").over(w)).where(~F.col("px").eqNullSafe(F.col("_was"))).select(*LEVEL, "px", clock, "pos")


def queue_positions(orders: DataFrame, clock: str = "height") -> DataFrame:
    """``orders`` with ``orders_ahead, size_ahead`` in their price level."""
    w = Window.partitionBy(*LEVEL).orderBy(clock, "pos").rowsBetween(Window.unboundedPreceding, -1)
    return orders.withColumns({"orders_ahead": F.count("*").over(w), "size_ahead": F.coalesce(F.sum("size").over(w), F.lit(0).cast(DECIMAL))})


def levels(orders: DataFrame, texts: DataFrame | None = None, clock: str = "height") -> DataFrame:
    """``coin, side, key, px, size, orders`` per price level.

    Levels are called as ``texts`` of ``level_texts`` has it, without it as their oldest order says.
    """
    per = orders.groupBy(*LEVEL).agg(F.min_by("px", F.struct(clock, "pos")).alias("px"), F.sum("size").cast(DECIMAL).alias("size"), F.count("*").alias("orders"))
    if texts is None:
        return per
    last = texts.groupBy(*LEVEL).agg(F.max_by("px", F.struct(clock, "pos")).alias("px"))
    return per.drop("px").join(last, LEVEL).select(*LEVEL, "px", "size", "orders")


def top(levels_: DataFrame, n: int = 1) -> DataFrame:
    """The best ``n`` levels of each side, with their rank."""
    rank = F.row_number().over(Window.partitionBy("coin", "side").orderBy(F.when(F.col("side") == "B", -F.col("key")).otherwise(F.col("key"))))
    return levels_.withColumn("rank", rank).where(F.col("rank") <= n)


def allocate(orders: DataFrame, printed: Column, ahead: Column, keys: list[str], order: list[str]) -> DataFrame:
    """``orders`` with ``filled``: what a print leaves for each order of a queue, first come first served.

    ``printed`` is the size traded at the level of ``keys``, ``ahead`` what stood before all of its orders.
    """
    size = F.col("size")
    prior = F.coalesce(F.sum(size).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return orders.withColumn("filled", F.greatest(F.lit(0), F.least(size, printed - ahead - prior)))


def checksum(orders: DataFrame, diffs: DataFrame, heights: DataFrame | None = None, clock: str = "height") -> DataFrame:
    """``coin, checksum``: SHA-256 over a coin's whole book.

    The text is ``coin=C;height=H;``, then ``B|px|oid:size,...;`` for each bid level from the best, then
    ``A|...`` for each ask level, orders in queue order, sizes with the decimals they came with.  The height is that of the last
    block: of ``heights`` (``coin, height``; None where there was no block), or the largest in the diffs of any coin.  A coin's
    resting orders are one group here: they don't grow with the history.
    """
    queue = F.array_sort(F.collect_list(F.struct(clock, "pos", "oid", plain(F.col("size"), F.col("size_text")).alias("size"))))
    rows = F.array_join(F.transform("q", lambda o: F.concat(o["oid"].cast("string"), F.lit(":"), o["size"])), ",")
    queues = orders.groupBy(*LEVEL).agg(queue.alias("q")).select(*LEVEL, rows.alias("q"))
    called = level_texts(diffs, clock).groupBy(*LEVEL).agg(F.max_by("px", F.struct(clock, "pos")).alias("px"))
    line = F.concat(F.col("side"), F.lit("|"), F.col("px"), F.lit("|"), F.col("q"), F.lit(";"))
    away = F.when(F.col("side") == "B", -F.col("key")).otherwise(F.col("key"))
    by_level = queues.join(called, LEVEL).select("coin", F.struct((F.col("side") != "B").alias("asks"), away.alias("away"), line.alias("line")).alias("level"))
    text = by_level.groupBy("coin").agg(F.array_join(F.transform(F.array_sort(F.collect_list("level")), lambda x: x["line"]), "").alias("text"))
    if heights is None:
        last = diffs.agg(F.max("height").alias("height")).withColumn("_k", F.lit(0))
        heights = diffs.select("coin", F.lit(0).alias("_k")).distinct().join(F.broadcast(last), "_k")
    whole = F.concat(F.lit("coin="), F.col("coin"), F.lit(";height="), F.coalesce(F.col("height").cast("string"), F.lit("None")), F.lit(";"), F.coalesce("text", F.lit("")))
    return heights.join(text, "coin", "left").select("coin", F.sha2(whole, 256).alias("checksum"))


def _checked(diffs: DataFrame, clock: str) -> tuple[DataFrame, dict[str, Column]]:
    """The rows of ``_read``, and by type of anomaly whether a row has it."""
    if "orig_sz" not in diffs.columns:
        diffs = diffs.withColumn("orig_sz", F.lit(None).cast("string"))
    past = Window.partitionBy("coin", "oid").orderBy(clock, "pos").rowsBetween(Window.unboundedPreceding, -1)
    kind, zero = F.col("kind"), F.lit(0)
    good, update, ended = F.col("new"), F.col("update"), F.col("ends")
    alive = F.coalesce(F.last(F.when(good, 1).when(ended, 0), ignorenulls=True).over(past), zero) == 1
    stands = F.last(F.when(good, F.col("size")).when(kind == "update", F.col("to")), ignorenulls=True).over(past)
    rows = _read(_dealt(diffs), clock, "orig_sz").withColumns({"_alive": alive, "_stands": stands})
    alive, stands = F.col("_alive"), F.col("_stands")
    resized, orig = alive & update, F.col("_orig_sz")
    types = {
        "new_without_sz": (kind == "new") & F.col("sz").isNull(),
        "bad_decimal": ((kind == "new") & F.col("sz").isNotNull() & ~good) | ((kind == "update") & alive & ~update) | (resized & F.col("orig_sz").isNotNull() & orig.isNull()),
        "duplicate_new": good & alive,
        "unknown_oid_update": (kind == "update") & ~alive,
        "unknown_oid_remove": (kind == "remove") & ~alive,
        "orig_sz_mismatch": resized & (orig != stands),
        "update_to_zero": resized & (F.col("to") <= 0),
        "unknown_kind": F.coalesce(~kind.isin("new", "update", "remove"), F.lit(True)),
    }
    return rows, {name: F.coalesce(when, F.lit(False)) for name, when in types.items()}


def _odd(types: dict[str, Column]) -> Column:
    """How many anomalies a row has."""
    return reduce(Column.__add__, [when.cast("long") for when in types.values()])


def anomaly_rows(diffs: DataFrame, coin: str | None = None, clock: str = "height") -> DataFrame:
    """``coin``, ``clock``, ``pos, oid, type`` of every diff that does not fit the book it meets.

    ``new_without_sz``, ``bad_decimal`` (a price or size that is no number), ``duplicate_new`` (the order is
    alive), ``unknown_oid_update`` and ``unknown_oid_remove`` (it is not), ``orig_sz_mismatch``,
    ``update_to_zero``, ``unknown_kind``, and, for the book of one ``coin``, ``coin_mismatch`` of all others.
    """
    rows, types = _checked(diffs, clock)
    found, some = F.array(*[F.when(when, name) for name, when in types.items()]), reduce(Column.__or__, types.values())
    if coin is not None:
        own = F.coalesce(F.col("coin") == coin, F.lit(False))
        found, some = F.when(own, found).otherwise(F.array(F.lit("coin_mismatch"))), some | ~own
    # few diffs are odd: the others have no array
    return rows.where(some).select("coin", clock, "pos", "oid", F.explode(found).alias("type")).where("type is not null")


def newest_anomalies(diffs: DataFrame, coin: str | None = None, n: int = 1000, clock: str = "height") -> DataFrame:
    """The newest ``n`` rows of ``anomaly_rows`` of each coin."""
    return newest(anomaly_rows(diffs, coin, clock), ["coin"], [clock, "pos", "type"], n).drop("_rank")


def anomalies(diffs: DataFrame, calendar: DataFrame | None = None, snapshots: DataFrame | None = None, clock: str = "height") -> DataFrame:
    """``coin, type, n``: anomalies by type, and ``height_gap``, the blocks that did not follow the one before.

    Heights are the chain's: a block without diffs of a coin is none the less a block its book sees.
    Without a ``calendar`` (see ``blocks``) the blocks are those that have a diff of any coin.
    """
    begun = diffs
    if calendar is None:
        # one shuffle tells the blocks and where books begin
        begun = once(diffs.select("coin", F.col(clock).alias("arrival"), "height").distinct(), [], F.struct("coin", "arrival", "height"))
        calendar, begun = chain.calendar(begun.select("arrival", "height").distinct()), begun.withColumn(clock, F.col("arrival"))
    per = anomaly_rows(diffs, clock=clock).groupBy("coin", "type").agg(F.count("*").alias("n"))
    gaps = chain.gap_counts(chain.epochs(begun, calendar, snapshots, clock), calendar).where("n > 0")
    return per.unionByName(gaps.select("coin", F.lit("height_gap").alias("type"), "n"))


def feed_stats(events: DataFrame, blocks: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """One row ``blocks, diffs, parse_skips, anomalies_total, stale_coins`` of a feed of ``diffs.events`` and ``diffs.blocks``.

    Both have an ``arrival`` beside what they are read with; bare events belong to the block before them.
    """
    checked, types = _checked(events.where("reason is null"), "arrival")
    sums = checked.groupBy("coin").agg(F.count("*").alias("diffs"), F.sum(_odd(types)).alias("odd"), F.min("arrival").alias("arrival"))
    # all uses take all of these few rows, so that diffs are ordered once
    per = once(sums, ["coin"], F.struct("diffs", "odd", "arrival"))
    calendar = chain.calendar(blocks)
    gaps = chain.gap_counts(chain.epochs(per, calendar, snapshots), calendar)
    counts = per.agg(F.coalesce(F.sum("diffs"), F.lit(0)).alias("diffs"), F.sum("odd").alias("odd"))
    skips = events.where("reason is not null").agg(F.count("*").alias("parse_skips"))
    stale = gaps.agg(F.array_sort(F.collect_set(F.when(F.col("n") > 0, F.col("coin")))).alias("stale_coins"), F.sum("n").alias("gaps"))
    rows = [blocks.agg(F.count("*").alias("blocks")), counts, skips, stale]
    names = ["blocks", "diffs", "parse_skips", "odd", "gaps", "stale_coins"]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows).agg(*[F.max(c).alias(c) for c in names])
    total = F.coalesce("odd", F.lit(0)) + F.coalesce("gaps", F.lit(0))
    return whole.select("blocks", "diffs", "parse_skips", total.alias("anomalies_total"), "stale_coins")


def integrity(diffs: DataFrame, calendar: DataFrame, snapshots: DataFrame | None = None, clock: str = "arrival") -> DataFrame:
    """``coin, orders, size, empty_levels, bid, ask, crossed, stale, anomalies, sound`` of each book after all diffs.

    A book is ``sound`` unless it is crossed.  Anomalies alone are no fault: a feed without a snapshot
    speaks of orders from before it began; ``stale`` and levels without size are told.  Diffs are dealt out and ordered once.
    """
    rows, types = _checked(diffs, clock)
    lives = _lives(rows, clock, F.sum(_odd(types)).alias("odd"), F.min(clock).alias("begun"))
    of = lambda c: F.when(F.col("alive"), F.col(c))
    levels_ = lives.groupBy("coin", of("side").alias("side"), of("key").alias("key")).agg(F.count_if("alive").alias("orders"), F.sum(of("size")).alias("size"), F.sum("odd").alias("odd"), F.min("begun").alias("begun"))
    side = lambda s: F.when(F.col("side") == s, F.col("key"))
    sums = levels_.groupBy("coin").agg(F.sum("orders").alias("orders"), F.sum("size").alias("size"), F.count_if((F.col("orders") > 0) & (F.col("size") <= 0)).alias("empty_levels"), F.max(side("B")).alias("bid"), F.min(side("A")).alias("ask"), F.sum("odd").alias("odd"), F.min("begun").alias("begun"))
    # all uses take all of these few rows
    per = once(sums, ["coin"], F.struct("orders", "size", "empty_levels", "bid", "ask", "odd", "begun"))
    gaps = chain.gap_counts(chain.epochs(per.select("coin", F.col("begun").alias(clock)), calendar, snapshots, clock), calendar)
    whole = per.join(gaps, "coin", "left")
    crossed = F.coalesce(F.col("bid") >= F.col("ask"), F.lit(False))
    none = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind).alias(c)
    anomalies_ = (F.coalesce("odd", F.lit(0)) + F.coalesce("n", F.lit(0))).cast("long").alias("anomalies")
    return whole.select("coin", none("orders", "long"), none("size", "double"), none("empty_levels", "long"), F.col("bid").cast("double").alias("bid"), F.col("ask").cast("double").alias("ask"), crossed.alias("crossed"), F.coalesce(F.col("n") > 0, F.lit(False)).alias("stale"), anomalies_, (~crossed).alias("sound"))


def snapshot_mismatches(snapshot: DataFrame, coin: str) -> DataFrame:
    """``coin, height, type``: snapshots of another coin that are loaded into the book of ``coin``."""
    return snapshot.where(F.col("coin") != coin).select("coin", "height").distinct().withColumn("type", F.lit("snapshot_coin_mismatch"))


def with_snapshot(snapshot: DataFrame, diffs: DataFrame, clock: str = "height") -> DataFrame:
    """Snapshot orders (bids then asks, each in queue order, at their ``clock``) as the first news; older diffs go."""
    none = F.lit(None).cast("string")
    texts = {c: F.col(c).cast("string") for c in ("px", "sz", "new_sz", "orig_sz") if c in diffs.columns}
    at = [clock] if clock == "height" or "height" not in snapshot.columns else [clock, "height"]
    news = snapshot.select("coin", *at, (F.col("ordinal") - (1 << 40)).alias("pos"), "oid", "side", F.col("px").cast("string").alias("px"), F.lit("new").alias("kind"), F.col("sz").cast("string").alias("sz"), none.alias("new_sz"))
    # one row a coin: the diffs, of which a coin may have most, stay where they are
    since = F.broadcast(snapshot.groupBy("coin").agg(F.max(clock).alias("_h")))
    later = diffs.withColumns(texts).join(since, "coin", "left").where(F.col("_h").isNull() | (F.col(clock) > F.col("_h"))).drop("_h")
    return news.unionByName(later, allowMissingColumns=True)


def sizes_over_time(diffs: DataFrame, clock: str = "height") -> DataFrame:
    """``coin, oid, side, px, key, size``, ``clock``, ``pos, placed, end, end_pos``: each size an order has had, until the next change.

    ``placed`` rows are those of a ``new``.  ``end`` is the ``clock`` of the change, null for what still stands.  Orders are sorted once.
    """
    new, update, ends = _rules()
    w = Window.partitionBy("coin", "oid").orderBy(clock, "pos")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    size = F.when(new, exact("sz")).when(update, exact("new_sz"))
    rows = diffs.select("coin", "oid", clock, "pos", F.when(new, F.struct("side", F.col("px").cast("string").alias("px"), exact("px").alias("key"))).alias("of"), size.alias("size"), F.when(new, 1).when(ends, 0).alias("turn"), (new | update | ends).alias("_counts"))
    # an update or end counts only while the order is there
    rows = rows.where("_counts").withColumns({"alive": F.coalesce(F.last("turn", ignorenulls=True).over(past), F.lit(0)), "of": F.coalesce("of", F.last("of", ignorenulls=True).over(past))}).where("coalesce(turn, 0) = 1 or alive = 1")
    after = {"end": F.lead(clock).over(w), "end_pos": F.lead("pos").over(w)}
    return rows.withColumns(after).where("coalesce(turn, 1) = 1").select("coin", "oid", "of.side", "of.px", "of.key", "size", clock, "pos", (F.coalesce("turn", F.lit(0)) == 1).alias("placed"), *after)


def level_spans(diffs: DataFrame, clock: str = "height") -> DataFrame:
    """``coin, side, key, px, size``, ``clock``, ``end``: what stands at a level from a block on, until before ``end`` (null: still)."""
    each = sizes_over_time(diffs, clock)
    moves = each.select(*LEVEL, clock, "pos", "size", F.lit(1).alias("orders"), F.when(F.col("placed"), F.col("px")).alias("px"))
    moves = moves.unionByName(each.where("end is not null").select(*LEVEL, F.col("end").alias(clock), F.col("end_pos").alias("pos"), (-F.col("size")).alias("size"), F.lit(-1).alias("orders")), allowMissingColumns=True)
    # the order that meets a level empty names it; at one moment what goes goes first
    before = F.sum("orders").over(Window.partitionBy(*LEVEL).orderBy(clock, "pos", "orders").rowsBetween(Window.unboundedPreceding, -1))
    named = moves.withColumn("px", F.when(F.coalesce(before, F.lit(0)) == 0, F.col("px")))
    told = named.groupBy(*LEVEL, clock).agg(F.sum("size").cast(DECIMAL).alias("size"), F.sum("orders").alias("orders"), F.max(F.when(F.col("px").isNotNull(), F.struct("pos", "px"))).alias("n"))
    w = Window.partitionBy(*LEVEL).orderBy(clock)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    told = told.select(*LEVEL, F.last("n.px", ignorenulls=True).over(upto).alias("px"), F.sum("size").over(upto).cast("double").alias("size"), F.sum("orders").over(upto).alias("orders"), clock, F.lead(clock).over(w).alias("end"))
    return told.where("orders > 0").drop("orders")


def block_tops(diffs: DataFrame, blocks: DataFrame | None = None, calendar: DataFrame | None = None, snapshots: DataFrame | None = None, clock: str = "height") -> DataFrame:
    """``coin``, ``clock``, ``n_diffs, bid_px, bid_sz, ask_px, ask_sz, mid, crossed`` after each block.

    ``blocks`` has the ``coin`` and ``clock`` to tell; without it every coin is told at every block that has
    diffs of its own.  With a ``calendar`` of the chain's blocks (see ``blocks``) a column ``stale`` tells whether the book has
    met a gap since it was last loaded.  A level stands over a span of blocks.  Spans are cut into nodes of 1, 4, 16, ... blocks,
    the best level of a node is one aggregate, and a block takes the best of the nodes above it, those of ``2^COARSE`` blocks
    and more together with its neighbours: no book is replayed, and neither a busy coin nor a long history is one task's work.
    """
    counts = diffs.groupBy("coin", clock).agg(F.count("*").alias("n_diffs"))
    wanted = counts if blocks is None else blocks.select("coin", clock).distinct().join(counts, ["coin", clock], "left").fillna(0, ["n_diffs"])
    if calendar is not None:
        wanted = chain.staleness(wanted, chain.epochs(diffs, calendar, snapshots, clock), calendar, clock)
    stale = ["stale"] if calendar is not None else []
    low, high = wanted.agg(F.min(clock), F.max(clock)).first()
    if low is None:
        return wanted.select("coin", clock, "n_diffs", *[F.lit(None).cast(t).alias(c) for c, t in (("bid_px", "string"), ("bid_sz", "double"), ("ask_px", "string"), ("ask_sz", "double"), ("mid", "double"), ("crossed", "boolean"))], *stale)
    bits = (high - low + 1).bit_length()
    spans = level_spans(diffs, clock).select("coin", "side", "key", "px", "size", F.greatest(F.col(clock) - low, F.lit(0)).alias("a"), (F.least(F.coalesce("end", F.lit(high + 1)), F.lit(high + 1)) - low).alias("b")).where("a < b")
    # a node of level k is 2^k blocks; levels are two bits apart, and a span has what its ends leave of four nodes, level by level
    shift = lambda x, k: F.call_function("shiftright", x, k)
    k, first, last = F.col("k"), F.col("first"), F.col("last")
    levels_ = F.sequence(F.lit(0), F.least(F.lit(bits), F.ceil(F.log2(F.col("b") - F.col("a"))).cast("int") + 1), F.lit(2))
    cut = spans.select("*", F.explode(levels_).alias("k")).withColumns({"first": shift(F.col("a") + F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, k), "last": shift(F.col("b"), k)}).where("first < last")
    run = lambda start, stop: F.when(start < stop, F.sequence(start, stop - 1)).otherwise(F.array().cast("array<bigint>"))
    left = F.least(last, F.ceil(first / 4) * 4)
    ends = F.concat(run(first, left), run(F.greatest(left, F.floor(last / 4) * 4), last))
    level = F.struct(F.when(F.col("side") == "B", F.col("key")).otherwise(-F.col("key")).alias("key"), "px", "size")
    best = lambda side: F.max(F.when(F.col("side") == side, F.col("level"))).alias("bid" if side == "B" else "ask")
    nodes = cut.select("coin", "side", "k", level.alias("level"), F.explode(ends).alias("node")).groupBy("coin", "k", "node").agg(best("B"), best("A"))
    # what stands above is looked up once for every node of level COARSE, and then by blocks from there
    own, most = [F.max("bid").alias("bid"), F.max("ask").alias("ask")], max(bits, COARSE)
    coarse = wanted.select("coin", shift(F.col(clock) - low, F.lit(COARSE)).alias("_c")).distinct().select("*", F.explode(F.sequence(F.lit(COARSE), F.lit(most), F.lit(2))).alias("k"))
    coarse = coarse.withColumn("node", shift(F.col("_c"), k - COARSE)).join(nodes.where(k >= COARSE), ["coin", "k", "node"]).groupBy("coin", "_c").agg(*own)
    near = nodes.where(k < COARSE).unionByName(coarse.select("coin", F.lit(COARSE).alias("k"), F.col("_c").alias("node"), "bid", "ask"))
    above = wanted.select("coin", clock, F.explode(F.sequence(F.lit(0), F.lit(COARSE), F.lit(2))).alias("k")).withColumn("node", shift(F.col(clock) - low, k))
    tops = above.join(near, ["coin", "k", "node"]).groupBy("coin", clock).agg(*own)
    return wanted.join(tops, ["coin", clock], "left").select(
        "coin", clock, "n_diffs", F.col("bid.px").alias("bid_px"), F.col("bid.size").alias("bid_sz"), F.col("ask.px").alias("ask_px"), F.col("ask.size").alias("ask_sz"),
        ((F.col("bid.key") - F.col("ask.key")) / 2).cast("double").alias("mid"), F.coalesce(F.col("bid.key") >= -F.col("ask.key"), F.lit(False)).alias("crossed"), *stale,
    )
