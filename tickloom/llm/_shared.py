"""Where intermediate tables go, and connected components over an edge table."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = f"{spark.conf.get('spark.sql.warehouse.dir')}/.tickloom"
    return where.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_path(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/tickloom/{uuid.uuid4().hex}"


def passing(spark: SparkSession, path: str) -> None:
    """What has been written to ``path`` goes with the application."""
    where, files = _file_system(spark, path)
    files.deleteOnExit(where)


def settle(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The table goes with the application, or before that with ``release``.
    """
    spark = df.sparkSession
    path = shared_path(spark)
    df.write.option("compression", codec).parquet(path)
    passing(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete settled tables that nothing reads any more; other frames are passed over."""
    for df in frames:
        path = getattr(df, "_settled", None)
        if path:
            where, files = _file_system(df.sparkSession, path)
            files.delete(where, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_BLOCK_BITS = 12


def bit_table(hashes: DataFrame, column: str, n: int) -> np.ndarray:
    """A table, for ``in_table``, of the low bits of the hashes in ``column``, of which there are about ``n``.

    It has 16 to 32 bits to a hash, 2^16 at least and 2^28 (32 MB) at most; Spark sets the bits.
    """
    bits = min(28, max(16, (16 * n).bit_length()))
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = hashes.select(F.shiftright(low, 5).alias("word"), low.alias("low")).select("word", F.expr("shiftleft(1L, int(low & 31))").alias("mask"))
    words = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).withColumn("block", F.shiftright("word", _BLOCK_BITS))
    table = np.zeros(1 << bits - 5, np.uint32)
    # a row has 16 KB of the table
    for block, part in grouped(words, "block", _block, "block long, words binary").collect():
        own = np.frombuffer(part, np.uint32)
        table[block << _BLOCK_BITS : (block << _BLOCK_BITS) + len(own)] = own[: len(table)]
    return table


def _block(table: pa.Table) -> pa.Table:
    word, mask = table.column("word").to_numpy(), table.column("mask").to_numpy()
    out = np.zeros(1 << _BLOCK_BITS, np.uint32)
    out[word & (1 << _BLOCK_BITS) - 1] = mask
    return pa.table({"block": pa.array(word[:1] >> _BLOCK_BITS), "words": pa.array([out.tobytes()], pa.binary())})


def grouped(df: DataFrame, key: str, kernel, schema: str, **options) -> DataFrame:
    """``kernel(table, **options)`` on each group of ``df`` by ``key``, as Arrow tables."""

    def run(table: pa.Table) -> pa.Table:
        return kernel(table, **options)

    return df.groupBy(key).applyInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large and small stars.

    ``edges`` has two columns of node ids, in any direction and with repeats.  Returns ``node``,
    ``component`` (smallest node reachable) for the nodes that have an edge to another node.
    Minima are pre-aggregated before the shuffle and joined back, so a node with very many
    neighbours is never gathered in one place.
    """
    a, b = edges.columns
    now = settle(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u < v").distinct())
    seen = None
    while True:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select("v", F.col("m").alias("u"))
        large = large.where("u < v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(low.select("v", F.col("m").alias("u")))
        before, now = now, settle(small.where("u < v").distinct())
        release(before)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            told = now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
            told._settled = now._settled  # reads that table
            return told
        seen = mark
