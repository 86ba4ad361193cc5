"""Feed latency: bucketed histograms, bucket percentiles and exact summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: fixed values: upper bounds of the histogram in milliseconds
BOUNDS = (1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000, 10000)


def histogram(deltas: DataFrame, bounds=BOUNDS, by: str = "symbol") -> DataFrame:
    """``by, bucket, bound_ms, n, total_ms, least_ms, most_ms, negatives``.

    The bucket is the first whose bound is at least the delta, the last one has no bound.  Negative
    deltas count as zero and are counted apart.  Rows of partial histograms merge by summing.
    """
    d = F.greatest(F.col("delta_ms").cast("double"), F.lit(0.0))
    bucket = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        bucket = F.when(d <= bounds[i], i).otherwise(bucket)
    bound = F.get(F.array(*[F.lit(float(b)) for b in bounds]), F.col("bucket"))
    out = deltas.where("delta_ms is not null").withColumns({"_d": d, "bucket": bucket}).groupBy(by, "bucket").agg(
        F.count("*").alias("n"), F.sum("_d").alias("total_ms"), F.min("_d").alias("least_ms"), F.max("_d").alias("most_ms"), F.sum((F.col("delta_ms") < 0).cast("long")).alias("negatives")
    )
    return out.withColumn("bound_ms", bound)


def percentiles(hist: DataFrame, qs=(0.5, 0.95, 0.99), by: str = "symbol") -> DataFrame:
    """``by, q, value_ms``: bound of the first bucket that reaches ``q`` of the count; the maximum beyond the last."""
    w = Window.partitionBy(by)
    run = hist.withColumns({"upto": F.sum("n").over(w.orderBy("bucket")), "all": F.sum("n").over(w), "top": F.max("most_ms").over(w)})
    each = run.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))).where(F.col("upto") >= F.col("q") * F.col("all"))
    return each.groupBy(by, "q").agg(F.min_by(F.coalesce("bound_ms", "top"), "bucket").alias("value_ms"))


#: nearest-rank percentiles of the exact summary
EXACT = (1, 50, 90, 95, 99)


def summary(deltas: DataFrame, offset_ms: float | None = None, by: str = "symbol") -> DataFrame:
    """``by, count, negative_count, raw, adjusted``: exact figures, rounded to three places.

    ``raw`` and ``adjusted`` are structs of least, most, mean and nearest-rank percentiles; ``adjusted`` has
    the clock offset added and is null without one.  Rows are counted by value before they are ordered.
    """
    d = F.col("delta_ms").cast("double")
    counts = deltas.where("delta_ms is not null").groupBy(by, d.alias("_d")).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(by)
    run = counts.withColumns({"_upto": F.sum("_c").over(w.orderBy("_d")), "_n": F.sum("_c").over(w)})
    reached = lambda q: F.min(F.when(F.col("_upto") >= F.greatest(F.lit(1), F.ceil(F.col("_n") * q / 100)), F.col("_d"))).alias(f"p{q}_ms")
    per = run.groupBy(by).agg(
        F.sum("_c").alias("count"), F.coalesce(F.sum(F.when(F.col("_d") < 0, F.col("_c"))), F.lit(0)).alias("negative_count"),
        F.min("_d").alias("min_ms"), F.max("_d").alias("max_ms"), (F.sum(F.col("_d") * F.col("_c")) / F.sum("_c")).alias("mean_ms"), *[reached(q) for q in EXACT],
    )
    names = ["min_ms", *[f"p{q}_ms" for q in EXACT], "max_ms", "mean_ms"]
    raw = F.struct(*[F.round(c, 3).alias(c) for c in names])
    moved = F.struct(*[F.round(F.col(c) + (offset_ms or 0.0), 3).alias(c) for c in names])
    return per.select(by, "count", "negative_count", raw.alias("raw"), (moved if offset_ms is not None else F.lit(None)).cast(f"struct<{', '.join(f'{c}:double' for c in names)}>").alias("adjusted"))


def snapshot(hist: DataFrame, by: str = "symbol") -> DataFrame:
    """``by, count, mean_ms, p50_ms, p95_ms, p99_ms, min_ms, max_ms, negative_count`` of a histogram."""
    per = hist.groupBy(by).agg(F.sum("n").alias("count"), F.round(F.sum("total_ms") / F.sum("n"), 3).alias("mean_ms"), F.min("least_ms").alias("min_ms"), F.max("most_ms").alias("max_ms"), F.sum("negatives").alias("negative_count"))
    at = percentiles(hist, by=by).groupBy(by).agg(*[F.max(F.when(F.col("q") == q, F.col("value_ms"))).alias(f"p{round(q * 100)}_ms") for q in (0.5, 0.95, 0.99)])
    return per.join(at, by)


def skip_first_frames(frames: DataFrame) -> DataFrame:
    """Frames without the first trades frame of each connection and coin, which replays history."""
    n = F.row_number().over(Window.partitionBy("conn_id", "symbol").orderBy("arrival"))
    return frames.withColumn("_n", n).where("_n > 1").drop("_n")
