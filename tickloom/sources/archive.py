"""Archive locations, request expansion, price files, and reads of stored data."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import millis
from ..operators.asof import newest
from . import lz4

#: fixed values: where the archive keeps each kind of data
TEMPLATES = {
    "l2Book": "market_data/{day}/{hour}/l2Book/{symbol}.lz4",
    "trades": "market_data/{day}/{hour}/trades/{symbol}.lz4",
    "asset_ctxs": "asset_ctxs/{day}.csv.lz4",
    "node_fills": "node_fills_by_block/{day}/",
}
HOURLY = ("l2Book", "trades")


def requests(spans: DataFrame, kinds: list[str]) -> DataFrame:
    """``symbol, day, hour, data_type, path`` of spans ``symbol, first_day, last_day`` (inclusive days).

    Daily kinds have one row per day with hour 0; the path of node fills is a prefix.
    """
    unknown = set(kinds) - set(TEMPLATES)
    if unknown:
        raise ValueError(f"unknown data type: {', '.join(sorted(unknown))}")
    days = spans.select("symbol", F.explode(F.sequence("first_day", "last_day")).alias("d")).select("symbol", F.date_format("d", "yyyyMMdd").alias("day"))
    each = days.withColumn("data_type", F.explode(F.array(*[F.lit(k) for k in kinds])))
    hours = F.when(F.col("data_type").isin(*HOURLY), F.sequence(F.lit(0), F.lit(23))).otherwise(F.array(F.lit(0)))
    each = each.withColumn("hour", F.explode(hours))
    path = F.create_map(*[F.lit(x) for k in kinds for x in (k, TEMPLATES[k])])[F.col("data_type")]
    for name in ("symbol", "day", "hour"):
        path = F.replace(path, F.lit("{" + name + "}"), F.col(name).cast("string"))
    return each.select("symbol", "day", "hour", "data_type", path.alias("path"))


def price_csv(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    """OHLCV bars of CSV files with a header; times are UTC."""
    schema = T.StructType.fromDDL("timestamp string, open double, high double, low double, close double, volume double")
    read = spark.read.csv(path, header=True, schema=schema)
    return read.select(F.lit(symbol).alias("symbol"), millis(F.col("timestamp").cast("timestamp_ntz")).alias("t_ms"), "open", "high", "low", "close", "volume")


def check_bars(bars: DataFrame) -> DataFrame:
    """Bars with a numeric close, in order of time."""
    kinds = dict(bars.dtypes)
    if "t_ms" not in kinds or kinds.get("close") not in ("double", "float", "int", "bigint") and not kinds.get("close", "").startswith("decimal"):
        raise ValueError("bars need t_ms and a numeric close")
    return bars.orderBy("t_ms")


def between(stored: DataFrame, symbol: str, data_type: str, start_ms: int, end_ms: int) -> DataFrame:
    """Rows of a symbol and type with ``start <= t <= end``, in order; pushed to the scan or to partitions.

    Of a store by ``date`` (see ``sinks.clustered``) only the days of the range are listed.
    """
    rows = stored.where((F.col("symbol") == symbol) & (F.col("data_type") == data_type) & F.col("t_ms").between(start_ms, end_ms))
    if "date" in stored.columns:
        day = lambda ms: F.date_add(F.lit("1970-01-01").cast("date"), ms // 86_400_000)
        rows = rows.where(F.col("date").between(day(start_ms), day(end_ms)))
    return rows.orderBy("t_ms")


def latest(stored: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` rows of each symbol."""
    return newest(stored, ["symbol"], ["t_ms", "arrival"], n).withColumnRenamed("_rank", "rank")


def days(spark: SparkSession, root: str) -> list[str]:
    """Day folders under ``root``, or ``root`` itself where it is a day."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(str(s.getPath().toString()) for s in fs.listStatus(path) if s.isDirectory())
    return found or [root]


def lz4_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, ordinal, raw`` of LZ4-frame text files, which Spark's own text reader does not know; see ``lz4``."""
    return lz4.lines(lz4.files(spark, path))


def collected(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """``symbol, day, hour, data_type, file, ordinal, raw`` of the lines of all ``wanted`` files (of ``requests``) under ``root``.

    Files that are missing or empty have no lines.  Only requested files are opened, each by as many tasks as it has runs.
    """
    where = root.rstrip("/") + "/"
    listed = lz4.files(spark, root).withColumn("_p", F.expr(f"substring(path, instr(path, '{where}') + {len(where)})"))
    found = listed.join(wanted.withColumnRenamed("path", "_p"), "_p").drop("_p")
    return lz4.lines(found.select("path").distinct()).join(found.withColumnRenamed("path", "file"), "file").select("symbol", "day", "hour", "data_type", "file", "ordinal", "raw")


def mirror(wanted: DataFrame, source: str, cache: str) -> DataFrame:
    """``path, state`` of each distinct ``wanted`` path, after what the ``cache`` lacks has been copied from ``source``, by many tasks.

    What the cache has is not asked for again (``cached``), unless it is empty.  Empty files are not kept (``empty``), so that they
    are asked for again; ``missing`` ones have not been published yet.  A copy is written beside its place and moved there whole, so a task that
    is run twice does no harm.
    """
    states = {True: "copied", False: "empty", None: "missing"}

    def run(batches):
        for batch in batches:
            told = []
            for path in batch.column("path").to_pylist():
                to, at = pa.fs.FileSystem.from_uri(f"{cache.rstrip('/')}/{path}")
                if to.get_file_info(at).size:
                    told.append("cached")
                    continue
                from_, name = pa.fs.FileSystem.from_uri(f"{source.rstrip('/')}/{path}")
                size = from_.get_file_info(name).size
                if size:
                    to.create_dir(at.rpartition("/")[0], recursive=True)
                    beside = f"{at}.{uuid.uuid4().hex}"
                    pa.fs.copy_files(name, beside, source_filesystem=from_, destination_filesystem=to)
                    to.move(beside, at)
                told.append(states[None if size is None else size > 0])
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(told, pa.string())], ["path", "state"])

    return wanted.select("path").distinct().mapInArrow(run, "path string, state string")
