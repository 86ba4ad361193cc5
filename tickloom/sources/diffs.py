"""Lines of order-book diffs and snapshots: shapes are told apart per line, bad parts are kept apart.

A line is a bare event or a block, with its events nested in ``data`` or flat; a quiet block has none.  In
tolerant mode a bad event or line is a row with ``reason`` and nothing else; strict mode raises.  Prices and
sizes stay the texts they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import once, side

REQUIRED = ("oid", "coin", "side", "px")
KNOWN = (*REQUIRED, "user", "raw_book_diff", "rawBookDiff")
#: fixed values: what a block line may say
BLOCK_KEYS, DATA_KEYS = ("time", "height", "data", "book_diffs", "order_statuses"), ("book_diffs", "order_statuses")
TIMES, HEIGHTS = ("time", "time_ms", "blockTime"), ("height", "block_height", "blockHeight")


def lines(spark, path: str) -> DataFrame:
    """``raw, file, ordinal`` of text files.

    The ordinal is the place in the file, by a window over the ids Spark gives in reading order; files
    of one feed are numbered one by one, in parallel.
    """
    read = spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_id"))
    return read.withColumn("ordinal", F.row_number().over(Window.partitionBy("file").orderBy("_id"))).drop("_id")


def _texts(names: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _has(keys: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(keys, name), F.lit(False))


def _first(of: str, keys: Column, *names: str) -> Column:
    """Value of the first of ``names`` that is among ``keys``, even if it is null."""
    out = F.lit(None).cast("string")
    for name in reversed(names):
        out = F.when(_has(keys, name), F.col(f"{of}.{name}")).otherwise(out)
    return out


def _shaped(frame: DataFrame) -> DataFrame:
    """``ordinal, raw, keys, event, block, height, time_ms, listed`` of every line that is not blank.

    A line is an ``event``, a ``block`` (of a whole height and time, with its events ``listed``), or neither.
    """
    fields = ", ".join(f"{n} string" for n in (*TIMES, *HEIGHTS))
    shape = f"{fields}, data struct<book_diffs:array<string>, order_statuses:string>, book_diffs array<string>, order_statuses string"
    read = once(frame, ["ordinal"], F.struct("raw", F.json_object_keys("raw").alias("keys"), F.from_json("raw", shape).alias("p"))).where(F.trim("raw") != "")
    event = _has(F.col("keys"), "raw_book_diff") | _has(F.col("keys"), "rawBookDiff")
    # a key with a null value is there too; it is looked for only where the values tell nothing
    inner = F.json_object_keys(F.get_json_object("raw", "$.data"))
    nested = F.when(F.col("p.data.book_diffs").isNotNull() | F.col("p.data.order_statuses").isNotNull(), True).when(F.col("p.data").isNotNull(), _has(inner, "book_diffs") | _has(inner, "order_statuses")).otherwise(False)
    flat = _has(F.col("keys"), "book_diffs") | (_has(F.col("keys"), "order_statuses") & _has(F.col("keys"), "height"))
    text = F.when(nested, F.get_json_object("raw", "$.data.book_diffs")).otherwise(F.get_json_object("raw", "$.book_diffs"))
    listed = F.when(nested, F.col("p.data.book_diffs")).otherwise(F.col("p.book_diffs"))
    whole = lambda names: _first("p", F.col("keys"), *names).try_cast("bigint")
    told = read.select("raw", "ordinal", "keys", event.alias("event"), (nested | flat).alias("shaped"), listed.alias("listed"), whole(HEIGHTS).alias("height"), whole(TIMES).alias("time_ms"), F.when(listed.isNull(), text).alias("other"))
    block = ~F.col("event") & F.col("shaped") & F.col("height").isNotNull() & F.col("time_ms").isNotNull() & F.col("other").isNull()
    return told.withColumn("block", F.coalesce(block, F.lit(False)))


def blocks(frame: DataFrame) -> DataFrame:
    """``ordinal, height, time_ms, n_events`` of every block line, also of quiet blocks."""
    return _shaped(frame).where("block").select("ordinal", "height", "time_ms", F.coalesce(F.size("listed"), F.lit(0)).cast("long").alias("n_events"))


def counted(frame: DataFrame, name: str = "feed") -> DataFrame:
    """``frame``, observed: ``blocks, diffs, skipped`` (lines) and ``bytes``, for an ``Observation`` or ``live.FeedStats``."""
    told = _shaped(frame)
    diffs = F.when(F.col("block"), F.coalesce(F.size("listed"), F.lit(0))).when(F.col("event"), 1).otherwise(0)
    sums = [F.count_if(F.col("block")).alias("blocks"), F.sum(diffs).alias("diffs"), F.count_if(~F.col("block") & ~F.col("event")).alias("skipped"), F.sum(F.octet_length("raw")).alias("bytes")]
    return told.observe(name, *sums).select("raw", "ordinal")


def events(frame: DataFrame, strict: bool = False) -> DataFrame:
    """``height, time_ms, ordinal, pos, oid, coin, side, px, kind, sz, orig_sz, new_sz, reason`` per event.

    Events of a block have its height and time; bare events have null.  Quiet blocks have no rows here (see ``blocks``);
    lines that are neither event nor block have one, with a reason.
    """
    line = _shaped(frame)
    odd = F.array_except("keys", _texts(BLOCK_KEYS))
    drift = F.when(F.col("block") & (F.size(odd) > 0), F.concat(F.lit("unknown "), F.array_join(odd, ",")))
    reason = F.when(F.col("event") | F.col("block"), drift if strict else None).when(F.col("keys").isNull(), "not an object").when(F.col("shaped"), "bad block").otherwise("unknown line")
    if strict:
        reason = F.when(reason.isNotNull(), F.raise_error(reason).cast("string"))
    line = line.withColumn("_reason", reason)
    listed = F.when(F.col("block") & F.col("_reason").isNull(), F.coalesce("listed", F.array().cast("array<string>"))).otherwise(F.array("raw"))
    of_block = lambda c: F.when(F.col("block"), F.col(c)).alias(c)
    each = line.select(of_block("height"), of_block("time_ms"), "ordinal", "_reason", F.posexplode(listed).alias("pos", "e"))
    return parse_event(each, strict)


EVENT = "oid string, coin string, side string, px string, raw_book_diff string, rawBookDiff string"
DIFF = "map<string,map<string,string>>"


def parse_event(each: DataFrame, strict: bool = False) -> DataFrame:
    """The event in text ``e``; a ``_reason`` that is there already stands.

    An event and its diff are parsed once each.  Keys are looked for only where a value is null or none, and by strict mode.
    """
    base = [c for c in ("height", "time_ms", "ordinal", "pos") if c in each.columns]
    given = F.col("_reason") if "_reason" in each.columns else F.lit(None).cast("string")
    read = once(each.withColumn("_given", given), [*base, "_given"], F.struct("e", F.from_json("e", EVENT).alias("_e")))
    # a list of one event would be read as that event
    whole = F.col("e").rlike(r"^[ \t\r\n]*\{") & reduce(Column.__and__, [F.col(f"_e.{c}").isNotNull() for c in (*REQUIRED, "raw_book_diff")])
    seen = F.when(~F.coalesce(whole, F.lit(False)) | F.lit(strict), F.json_object_keys("e"))
    read = once(read.withColumn("_whole", F.coalesce(whole, F.lit(False))), [*base, "_given", "_whole", "_e"], F.struct(seen.alias("_keys")))
    keys = F.col("_keys")
    diff = F.coalesce("_e.raw_book_diff", F.when(~_has(keys, "raw_book_diff"), F.col("_e.rawBookDiff")))
    read = read.withColumn("_diff", diff)
    each = once(read, [*base, "_given", "_whole", "_e", "_keys", "_diff"], F.struct(F.when(F.col("_diff") != "remove", F.from_json("_diff", DIFF)).alias("_d")))
    each = each.withColumns({"_said": F.when(F.size("_d") == 1, F.get(F.map_keys("_d"), F.lit(0))), "_of": F.when(F.size("_d") == 1, F.get(F.map_values("_d"), F.lit(0)))})
    each = each.withColumns({"_names": F.reverse(F.map_keys("_of")), "_values": F.reverse(F.map_values("_of"))})
    said, of = F.col("_said"), F.col("_names")
    # of keys that are there twice the last one counts
    last = lambda name: F.get("_values", F.array_position(of, name).cast("int") - 1)
    named = lambda *names: F.when(said == "update", F.when(_has(of, names[0]), last(names[0])).otherwise(F.when(_has(of, names[1]), last(names[1]))))
    only = lambda *names: F.size(F.array_except(of, _texts(names))) == 0
    each = each.withColumns({"_new": F.when((said == "new") & only("sz"), F.get("_values", F.lit(0))), "_new_sz": named("newSz", "new_sz"), "_orig": named("origSz", "orig_sz")})
    new, new_sz, orig = F.col("_new"), F.col("_new_sz"), F.col("_orig")
    told_kind = F.when(F.col("_diff") == "remove", "remove").when((said == "new") & new.isNotNull(), "new").when((said == "update") & new_sz.isNotNull() & orig.isNotNull() & only("origSz", "orig_sz", "newSz", "new_sz"), "update")
    each = each.withColumn("_kind", told_kind)
    kind = F.col("_kind")
    field = lambda name: F.col(f"_e.{name}")
    way = F.col("_way")
    each = each.withColumn("_way", side(field("side")))
    unknown, missing = F.array_except(keys, _texts(KNOWN)), F.array_except(_texts(REQUIRED), keys)
    reason = (
        F.when(F.col("_given").isNotNull(), F.col("_given")).when(~F.col("_whole") & keys.isNull(), "not an object").when(~F.col("_whole") & (F.size(missing) > 0), F.concat(F.lit("missing "), F.array_join(missing, ",")))
        .when(way.isNull(), "bad side").when(field("oid").try_cast("bigint").isNull(), "bad oid").when(kind.isNull(), "unsupported diff")
    )
    if strict:
        reason = reason.when(F.size(unknown) > 0, F.concat(F.lit("unknown "), F.array_join(unknown, ",")))
        reason = F.when(reason.isNotNull(), F.raise_error(reason).cast("string"))
    names = ("oid", "coin", "side", "px", "kind", "sz", "orig_sz", "new_sz", "reason")
    values = (field("oid").try_cast("bigint"), field("coin"), way, field("px"), kind, new, orig, new_sz, reason)
    told = once(each, base, F.struct(*[v.alias(n) for n, v in zip(names, values)]))
    ok = F.col("reason").isNull()
    of_kind = {"sz": "new", "orig_sz": "update", "new_sz": "update"}
    keep = lambda c: F.when(ok & (F.col("kind") == of_kind[c]) if c in of_kind else ok, F.col(c)).alias(c)
    return told.select(*base, *[keep(c) for c in ("oid", "coin", "side", "px", "kind", "sz", "orig_sz", "new_sz")], "reason")


def counters(parsed: DataFrame) -> DataFrame:
    """What a replay reports: diffs, rejects, blocks, and diffs per coin."""
    good = F.col("reason").isNull()
    return parsed.groupBy(F.coalesce("coin", F.lit("")).alias("coin")).agg(F.count_if(good).alias("diffs"), F.count_if(~good).alias("rejected"), F.count_distinct("height").alias("blocks"), *[F.count_if(F.col("kind") == k).alias(k) for k in ("new", "update", "remove")])


ORDER = "array<struct<user:string,coin:string,side:string,limit_px:string,limitPx:string,px:string,sz:string,size:string,oid:bigint,timestamp:bigint>>"


def snapshots(frame: DataFrame, parts: bool = False) -> DataFrame:
    """``coin, height, ordinal, oid, side, px, sz`` of whole-file snapshots in ``raw``; bids first, in queue order.

    A snapshot is always read strictly: without coin, height, or an order's id, price or size it raises.  With
    ``parts`` a book may come in several lines, each with its number as ``part``, so that none need hold all of it: its ordinals go through
    the bids of all parts, in their order, and then through the asks.  Only the sizes of parts are ordered by book.
    """
    at = lambda p: F.get_json_object("raw", p)
    lost = F.when(at("$.coin").isNull(), "coin").when(at("$.height").isNull(), "height")
    if parts:
        lost = lost.when(at("$.part").try_cast("bigint").isNull(), "part")
    listed = lambda p: F.coalesce(F.from_json(at(p), ORDER), F.array().cast(ORDER))
    sides = F.struct(listed("$.bids").alias("bids"), listed("$.asks").alias("asks"))
    orders = F.when(lost.isNotNull(), F.raise_error(F.concat(F.lit("snapshot without "), lost)).cast(f"struct<bids:{ORDER},asks:{ORDER}>")).otherwise(sides)
    book, number = ["coin", "height"], ["part"] if parts else []
    whole = frame.select(at("$.coin").alias("coin"), at("$.height").cast("bigint").alias("height"), *[at("$.part").try_cast("bigint").alias(c) for c in number], orders.alias("s"))
    n_bids, at_ = F.size("s.bids").cast("bigint").alias("_bids"), F.col("at").cast("bigint")
    each = whole.select(*book, *number, n_bids, F.posexplode(F.concat("s.bids", "s.asks")).alias("at", "o"))
    ordinal = at_
    if parts:
        sizes = whole.groupBy(*book, "part").agg(F.max(n_bids).alias("b"), F.max(F.size("s.asks").cast("bigint")).alias("a"))
        of = Window.partitionBy(*book)
        before = of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        shift = sizes.select(*book, "part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("_b"), (F.sum("b").over(of) + F.coalesce(F.sum("a").over(before), F.lit(0))).alias("_a"))
        # one row a part
        each = each.join(F.broadcast(shift), [*book, "part"])
        ordinal = F.when(at_ < F.col("_bids"), F.col("_b") + at_).otherwise(F.col("_a") + at_ - F.col("_bids"))
    sure = lambda name, kind, *fields: F.coalesce(*fields, F.raise_error(F.lit(f"snapshot order without {name}")).cast(kind))
    px, sz = sure("price", "string", "o.limit_px", "o.limitPx", "o.px"), sure("size", "string", "o.sz", "o.size")
    return each.select("coin", "height", ordinal.alias("ordinal"), sure("oid", "bigint", "o.oid").alias("oid"), _side("o.side").alias("side"), px.alias("px"), sz.alias("sz"))


def _side(name: str) -> Column:
    return side(F.col(name), strict=True)
