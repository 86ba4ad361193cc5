"""Where results go: partitioned files, databases, capped tables, several at once."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import closing

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import newest

Sink = Callable[[DataFrame], None]
#: stores a batch under its number, once
BatchSink = Callable[[DataFrame, int], None]


def dated(points: DataFrame) -> DataFrame:
    """Points with the UTC ``date`` and ``hour`` of their time."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("t_ms") / 86_400_000).cast("int"))
    return points.withColumns({"date": day, "hour": F.pmod(F.floor(F.col("t_ms") / 3_600_000), F.lit(24)).cast("int")})


def jsonl(path: str) -> Sink:
    return lambda points: dated(points).drop("hour").write.mode("append").partitionBy("symbol", "data_type", "date").json(path)


def spool(path: str) -> Sink:
    """Raw frames as they came, by day and hour."""
    return lambda frames: dated(frames).write.mode("append").partitionBy("date", "hour").json(path)


def parquet(path: str, *by: str) -> Sink:
    return lambda points: points.write.mode("append").partitionBy(*by).parquet(path)


def with_capture(points: DataFrame) -> DataFrame:
    """Payload text with the capture stamps folded in as ``_capture``."""
    stamps = F.to_json(F.struct("recv_ts_ms", "recv_mono_ns"))
    merged = F.concat(F.expr("substring(data, 1, length(data) - 1)"), F.lit(',"_capture":'), stamps, F.lit("}"))
    return points.withColumn("data", F.when(F.col("recv_ts_ms").isNotNull(), merged).otherwise(F.col("data")))


def jdbc(url: str, table: str, **properties: str) -> Sink:
    return lambda points: with_capture(points).write.jdbc(url, table, "append", properties)


def parquet_once(path: str) -> BatchSink:
    """Batches as folders ``batch=N`` of ``path``: staged, then renamed, so that a batch is there whole or not at all.

    A batch that is there already is passed over; what a failed try has staged is hidden from readers and
    written anew.  The file system has to rename a folder at once.
    """

    def write(points: DataFrame, batch: int) -> None:
        spark = points.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path
        final, staged = where(f"{path}/batch={batch}"), where(f"{path}/_staged-{batch}")
        files = final.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(final):
            return
        points.write.mode("overwrite").parquet(staged.toString())
        if not files.rename(staged, final):
            raise OSError(f"batch {batch} could not be moved to {final}")

    return write


def jdbc_once(url: str, table: str, feed: str = "feed", **properties: str) -> BatchSink:
    """Batches of ``with_capture`` points in a database, each exactly once.

    The tasks write to a staging table, which a failed try leaves behind and the next one overwrites.  One transaction then moves
    its rows to ``table`` and puts the batch into the ledger ``<table>_batches``; a batch that is
    in the ledger is passed over.  ``feed`` tells apart the streams that share a table.
    """

    def write(points: DataFrame, batch: int) -> None:
        spark, points = points.sparkSession, with_capture(points)
        given = spark._jvm.java.util.Properties()
        for k, v in properties.items():
            given.setProperty(k, v)
        with closing(spark._jvm.java.sql.DriverManager.getConnection(url, given)) as db, closing(db.createStatement()) as do:
            there = lambda name: any(db.getMetaData().getTables(None, None, n, None).next() for n in (name, name.upper(), name.lower()))
            if not there(f"{table}_batches"):
                do.execute(f"CREATE TABLE {table}_batches (batch VARCHAR(200) NOT NULL PRIMARY KEY)")
            with closing(db.prepareStatement(f"SELECT batch FROM {table}_batches WHERE batch = ?")) as ask:
                ask.setString(1, f"{feed} {batch}")
                if ask.executeQuery().next():
                    return
            if not there(table):
                points.limit(0).write.jdbc(url, table, "append", properties)
            points.write.jdbc(url, f"{table}_staged_{feed}", "overwrite", properties)
            db.setAutoCommit(False)
            try:
                with closing(db.prepareStatement(f"INSERT INTO {table}_batches VALUES (?)")) as mark:
                    mark.setString(1, f"{feed} {batch}")
                    mark.executeUpdate()
                do.executeUpdate(f"INSERT INTO {table} SELECT * FROM {table}_staged_{feed}")
                db.commit()
            except Exception:
                db.rollback()
                raise
            finally:
                db.setAutoCommit(True)

    return write


CLUSTERED = ("symbol", "data_type", "date")


def clustered(path: str, files: int = 8) -> Sink:
    """Points by symbol, type and day, ranges of time in a file, so that a read of a range opens few files."""

    def write(points: DataFrame) -> None:
        order = [*CLUSTERED, "t_ms"]
        rows = dated(points).drop("hour").repartitionByRange(files, *order).sortWithinPartitions(*order)
        rows.write.mode("append").partitionBy(*CLUSTERED).parquet(path)

    return write


def compact(spark: SparkSession, path: str, most: int = 1, files: int = 8) -> int:
    """Rewrite the days of a ``clustered`` store that have more than ``most`` files; returns how many had.

    A day's rows are replaced when all of them have been written again.  Nothing else may write to these days meanwhile.
    """
    stored = spark.read.parquet(path)
    many = stored.select(*CLUSTERED, F.col("_metadata.file_path").alias("_f")).distinct().groupBy(*CLUSTERED).count().where(F.col("count") > most).select(*CLUSTERED)
    days = many.count()
    if days:
        order = [*CLUSTERED, "t_ms"]
        rows = stored.join(many, list(CLUSTERED), "left_semi").repartitionByRange(files, *order).sortWithinPartitions(*order)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*CLUSTERED).parquet(path)
    return days


def type_points(points: DataFrame) -> DataFrame:
    """Flat fields of points of all types for a time-series database, from their payload ``data`` (JSON text).

    Books and top-of-book events have their best levels, where there are some; a top-of-book event without
    any is marked.  Trades and mids without a number have 0.
    """
    at = lambda p: F.get_json_object("data", p)
    kind = F.col("data_type")
    book, top = kind == "orderbook", kind == "bbo"
    best = lambda side, field: F.when(book, at(f"$.{side}s[0].{field}")).when(top, at(f"$.{side}.{field}")).try_cast("double")
    depth = lambda side: F.when(book, F.coalesce(F.json_array_length(at(f"$.{side}s")), F.lit(0)))
    number = lambda of, field: F.when(kind == of, F.coalesce(at(f"$.{field}").try_cast("double"), F.lit(0.0)))
    return points.select(
        "symbol", "t_ms", "data_type", best("bid", "px").alias("best_bid_price"), best("bid", "sz").alias("best_bid_size"), best("ask", "px").alias("best_ask_price"), best("ask", "sz").alias("best_ask_size"),
        depth("bid").alias("bid_levels"), depth("ask").alias("ask_levels"), number("trade", "price").alias("price"), number("trade", "size").alias("size"), F.when(kind == "trade", F.coalesce(at("$.side"), F.lit(""))).alias("side"),
        number("ticker", "mid_price").alias("mid_price"), F.when(top & at("$.bid").isNull() & at("$.ask").isNull(), 1).alias("empty_book"),
    )


def book_points(books: DataFrame) -> DataFrame:
    """Flat fields of level books for a time-series database; empty books are marked."""
    bid, ask = F.get("bids", F.lit(0)), F.get("asks", F.lit(0))
    return books.select("symbol", "t_ms", bid["px"].alias("best_bid"), bid["sz"].alias("best_bid_size"), ask["px"].alias("best_ask"), ask["sz"].alias("best_ask_size"), F.size("bids").alias("bid_levels"), F.size("asks").alias("ask_levels"), ((F.size("bids") == 0) & (F.size("asks") == 0)).alias("empty_book"))


def capped(points: DataFrame, n: int = 1000) -> DataFrame:
    """The newest ``n`` rows per symbol and type."""
    return newest(points, ["symbol", "data_type"], ["t_ms", "arrival"], n).drop("_rank")


def fan_out(*sinks: Sink) -> Sink:
    """Write to all; it fails only if all of them do."""

    def write(points: DataFrame) -> None:
        points = points.persist()
        failed = []
        try:
            for sink in sinks:
                try:
                    sink(points)
                except Exception as e:  # noqa: BLE001 - another sink may still succeed
                    failed.append(e)
            if sinks and len(failed) == len(sinks):
                raise failed[0]
        finally:
            points.unpersist()

    return write


def expire(points: DataFrame, as_of_ms: int, days: int = 30) -> DataFrame:
    return points.where(F.col("t_ms") >= as_of_ms - days * 86_400_000)
