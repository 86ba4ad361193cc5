"""As-of joins: the last observation at or before a time, without a non-equi join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: rows of a key are dealt out by time bucket, so that one busy key is many tasks' work
BUCKET_MS = 86_400_000


def seeded(frame: DataFrame, key: str, order: list[str], t: str = "t_ms", bucket: int = BUCKET_MS) -> DataFrame:
    """``frame`` with ``_b`` (time bucket) and, first in each bucket of a key, its last row before that.

    Such rows have ``_seed`` true.  Windows by (key, ``_b``) then see the row before their first one.  Only
    one pre-aggregated row per key and bucket is ordered by key alone.
    """
    rows = frame.withColumns({"_b": F.floor(F.col(t) / bucket), "_seed": F.lit(False)})
    last = rows.groupBy(key, "_b").agg(F.max_by(F.struct(*frame.columns), F.struct(*order)).alias("_r"))
    seeds = last.withColumn("_n", F.lead("_b").over(Window.partitionBy(key).orderBy("_b"))).where("_n is not null").select("_r.*", F.col("_n").alias("_b"), F.lit(True).alias("_seed"))
    return rows.unionByName(seeds)


#: numbers of an ordering column that make one bucket of ``numbered``, rows that make one chunk of ``chunked``
SPAN, CHUNK = 1_000_000, 100_000


def numbered(frame: DataFrame, keys: list[str], order: list[str], span: int = SPAN) -> DataFrame:
    """``frame`` with ``_pos``, the place of a row in its key from 0 on.

    Rows are ordered inside (keys, bucket of the first ordering column); one count per bucket is summed
    by key alone.
    """
    rows = frame.withColumn("_b", F.floor(F.col(order[0]) / span))
    counts = rows.groupBy(*keys, "_b").agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_ob"), before.alias("_before"))
    same = F.col("_b").eqNullSafe(F.col("_ob"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    own = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order)) - 1
    placed = rows.withColumn("_own", own).join(offsets, same)
    return placed.withColumn("_pos", F.col("_own") + F.col("_before")).select(*frame.columns, "_pos")


def chunked(frame: DataFrame, keys: list[str], order: list[str], back: int, chunk: int = CHUNK) -> DataFrame:
    """``frame`` numbered and cut into chunks ``_b`` of rows; the last ``back`` rows of a chunk are also in the
    next one, as ``_halo``, so that windows of up to ``back`` rows never leave their chunk."""
    size = max(chunk, 4 * back)
    own = F.floor(F.col("_pos") / size)
    both = F.when(F.col("_pos") >= (own + 1) * size - back, F.array(own, own + 1)).otherwise(F.array(own))
    return numbered(frame, keys, order).withColumn("_b", F.explode(both)).withColumn("_halo", F.col("_b") != F.floor(F.col("_pos") / size))


def newest(frame: DataFrame, keys: list[str], order: list[str], n: int, shares: int = 64) -> DataFrame:
    """The last ``n`` rows of each key by ``order``, with their rank from 1 on as ``_rank``.

    Each of ``shares`` shares of a key keeps its own last ``n`` first, so a busy key is never ordered whole.
    """
    down = [F.desc(c) for c in order]
    share = F.pmod(F.xxhash64(*order), F.lit(shares)).alias("_share")
    rows = frame.select("*", share)
    first = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_share").orderBy(*down))).where(F.col("_rank") <= n).drop("_rank", "_share")
    return first.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*down))).where(F.col("_rank") <= n)


def asof(left: DataFrame, right: DataFrame, values: list[str], key: str = "symbol", t: str = "t_ms", order: str = "arrival", strict: bool = False, bucket: int = BUCKET_MS) -> DataFrame:
    """``left`` with ``values`` of the last ``right`` row of its key at or before its time.

    Both sides are united and ordered once by time, side and ``order`` within (key, time bucket); ``last``
    carries values forward, from bucket to bucket by one row each.  Ties on time take the right row with
    the largest ``order``.  With ``strict`` only earlier rows count.
    """
    b = F.floor(F.col(t) / bucket).alias("_b")
    marked = left.select(F.col(key).alias("_k"), b, F.col(t).alias("_t"), F.lit(0 if strict else 1).alias("_s"), F.lit(None).cast("long").alias("_o"), F.struct(*[F.col(c) for c in left.columns]).alias("_l"), F.lit(None).alias("_r"))
    kind = F.struct(*[F.col(c) for c in values])
    given = right.select(F.col(key).alias("_k"), b, F.col(t).alias("_t"), F.lit(1 if strict else 0).alias("_s"), F.col(order).cast("long").alias("_o"), F.lit(None).alias("_l"), kind.alias("_r"))
    both = marked.unionByName(given)
    ends = both.groupBy("_k", "_b").agg(F.max_by("_r", F.when(F.col("_l").isNull(), F.struct("_t", "_o"))).alias("_r"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    seeds = ends.select("_k", "_b", F.lit(None).cast("long").alias("_t"), F.lit(-1).alias("_s"), F.lit(None).cast("long").alias("_o"), F.lit(None).cast(both.schema["_l"].dataType).alias("_l"), F.last("_r", ignorenulls=True).over(before).alias("_r"))
    w = Window.partitionBy("_k", "_b").orderBy(F.asc_nulls_first("_t"), "_s", "_o").rowsBetween(Window.unboundedPreceding, 0)
    done = both.unionByName(seeds).withColumn("_v", F.last("_r", ignorenulls=True).over(w)).where(F.col("_l").isNotNull())
    return done.select("_l.*", *[F.col(f"_v.{c}").alias(c) for c in values])


def merge_events(trades: DataFrame, books: DataFrame) -> DataFrame:
    """One ordered tape: trades before books of the same millisecond, then input order.

    ``rank`` is 0 for trades and 1 for books, ``place`` numbers a symbol's events from 0 on.  Rows are range
    partitioned by symbol, time, rank and input order, so a busy symbol is many tasks' work.
    """
    t = trades.select("symbol", "t_ms", F.lit(0).alias("rank"), "arrival", F.struct("price", "size", "side").alias("trade"), F.lit(None).alias("book"))
    b = books.select("symbol", "t_ms", F.lit(1).alias("rank"), "arrival", F.lit(None).alias("trade"), F.struct("bids", "asks").alias("book"))
    tape = numbered(t.unionByName(b), ["symbol"], ["t_ms", "rank", "arrival"], BUCKET_MS).withColumnRenamed("_pos", "place")
    return tape.repartitionByRange("symbol", "t_ms", "rank", "arrival").sortWithinPartitions("symbol", "t_ms", "rank", "arrival")
