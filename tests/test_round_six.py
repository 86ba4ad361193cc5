"""Books of a feed: how often diffs are read, and how they are dealt out."""

from pyspark.sql import functions as F

from tickloom.operators import blocks, l4

ROW = "coin string, arrival long, height long, pos long, oid long, side string, px string, kind string, sz string, new_sz string, orig_sz string, reason string"


def feed(spark, n=300):
    new = [("XYZ"[i % 3], i, i + i // 50, 0, i, "AB"[i % 2], str(100 + i % 9 * (1 if i % 2 == 0 else -1)), "new", "2", None, None, None) for i in range(n)]
    gone = [(c, a + 5, h + 5, 1, i if i % 4 else -i, s, p, "remove", None, None, None, None) for c, a, h, _, i, s, p, *_ in new[: n - 10 : 2]]
    d = spark.createDataFrame(new + gone, ROW).repartition(3)
    return d, d.select("arrival", (F.col("arrival") + F.floor(F.col("arrival") / 50)).alias("height")).distinct()


def watched(spark, d):
    """``d``, and how many of its rows were read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return d.mapInArrow(count, d.schema), seen


def test_points_of_staleness_stay_where_they_are(spark):
    d, b = feed(spark)
    calendar = blocks.calendar(b)
    points = d.select("coin", "arrival").repartition(7)
    loads = spark.createDataFrame([("X", 70, 71), ("Y", 71, 70)], "coin string, arrival long, height long")
    told = blocks.staleness(points, blocks.epochs(d, calendar, loads), calendar)
    assert told.rdd.getNumPartitions() == 7
    # X is loaded before the gap at 100, Y with a snapshot that is old, Z never
    stale = lambda c, a: a >= {"X": 100, "Y": 72}[c] or 50 <= a <= (70 if c == "X" else 71) if c != "Z" else a >= 50
    assert all(r.stale == stale(r.coin, r.arrival) for r in told.collect())


def test_a_calendar_goes_on_over_empty_buckets(spark):
    rows = [(0, 5), (1, 6), (9, 7), (40, 9), (41, 10), (95, 11), (96, 11)]
    got = blocks.calendar(spark.createDataFrame(rows, "arrival long, height long"), span=8).orderBy("arrival").collect()
    assert [(r.expected, r.broken, r.breaks) for r in got] == [(None, False, 0), (6, False, 0), (7, False, 0), (8, True, 1), (10, False, 1), (11, False, 1), (12, True, 2)]


def test_diffs_are_checked_in_as_many_parts_as_a_shuffle_has(spark):
    assert l4.anomaly_rows(feed(spark)[0].drop("reason")).rdd.getNumPartitions() == 4


def test_integrity_reads_the_diffs_once(spark):
    d, b = feed(spark)
    d, seen = watched(spark, d.drop("reason"))
    loads = spark.createDataFrame([("X", 70, 71)], "coin string, arrival long, height long")
    got = l4.integrity(d, blocks.calendar(b), loads).collect()
    assert seen.value == 445, got
    # unknown removals, and the gaps since a book began or was loaded
    assert {r.coin: (r.orders + r.size / 2, r.anomalies) for r in got} == {"X": (150.0, 28), "Y": (152.0, 29), "Z": (152.0, 29)}


def test_feed_statistics_read_the_events_once_and_the_skips_once(spark):
    d, b = feed(spark)
    d, seen = watched(spark, d.withColumn("reason", F.when(F.col("oid") == 7, "bad side")))
    told = l4.feed_stats(d, b).first()
    assert seen.value <= 2 * 445 and told.diffs == 444 and told.parse_skips == 1 and told.stale_coins == ["X", "Y", "Z"]
