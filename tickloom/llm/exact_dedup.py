"""Exact dedup by progressive refinement: length, then prefix, then the whole text.

Texts are equal when they are after each run of ``[\\x20\\x09-\\x0D]`` has become one space.  A first scan
leaves one row of about 24 bytes per document: length and hash of the first ``prefix`` characters.  Lengths
that occur once are done; of the others, pairs of length and prefix hash that occur once are done.  A second scan
digests (SHA-256) only texts whose length and prefix another document has: a bit table of those pairs (32 MB at most, sized
by their number) lets a task pass over the others, and an exact join on the small rows settles what it let through.  No text
is shuffled.  Counts and smallest ids are pre-aggregated; a group of copies of any size is joined back by
broadcast while there are at most ``BROADCAST_GROUPS`` groups; beyond that only the largest are, and the others by a shuffle.

Null counts as the empty text.  Very long texts count whole.  The smallest doc_id of equal texts stays; a null doc_id is
larger than any other.  Rows that repeat both id and text stay or go together and all count in
``group_size``.  An empty table gives an empty one.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._bytes import in_table
from ._shared import bit_table, release, settle

#: rows of about 70 bytes
BROADCAST_GROUPS = 200_000
#: a group of copies of so many rows, or of more in a very large table, is joined by broadcast in any case
HOT_ROWS = 100_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _digest(batches: Iterator[pa.RecordBatch], table, everything: bool) -> Iterator[pa.RecordBatch]:
    table = table.value
    for batch in batches:
        ask = in_table(table, batch.column("mark").to_numpy().view(np.uint64))
        texts = batch.column("text")
        full = [hashlib.sha256(texts[i].as_buffer()).digest() if everything or hit else None for i, hit in enumerate(ask.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("size"), batch.column("head"), pa.array(ask), pa.array(full, pa.binary())], ["doc_id", "size", "head", "ask", "digest"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 256, digests: bool = False) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` of every row.

    ``keep_id`` is the smallest doc_id with an equal text.  ``digest`` is the SHA-256 of the
    normalised text: of all rows if ``digests``, else only of those the refinement had to read whole.
    """
    text = normalised(F.col(f"`{text_col}`"))
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    size, head = F.octet_length("text").cast("long"), F.xxhash64(F.substring("text", 1, prefix))
    sketch = settle(own.select(size.alias("size"), head.alias("head")))
    lengths = sketch.groupBy("size").agg(F.count("*").alias("n")).where("n > 1").select("size")
    few = lengths.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    again = sketch.join(F.broadcast(lengths) if few else lengths, "size", "left_semi")
    pairs = settle(again.groupBy("size", "head").agg(F.count("*").alias("n")).where("n > 1").select("size", "head", F.xxhash64("size", "head").alias("mark")))
    release(sketch)
    n_pairs = pairs.count()
    table = docs.sparkSession.sparkContext.broadcast(bit_table(pairs, "mark", n_pairs))
    asked = own.select("doc_id", size.alias("size"), head.alias("head"), "text").withColumn("mark", F.xxhash64("size", "head"))
    told = settle(asked.mapInArrow(partial(_digest, table=table, everything=digests), f"doc_id {own.schema['doc_id'].dataType.simpleString()}, size long, head long, ask boolean, digest binary"))

    told_pairs = F.broadcast(pairs) if n_pairs <= BROADCAST_GROUPS else pairs
    maybe = told.where("ask")
    groups = maybe.join(told_pairs, ["size", "head"], "left_semi").groupBy("size", "head", "digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = settle(groups.where("group_size > 1").select("digest", "keep_id", "group_size"))
    release(pairs)
    if groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        met = maybe.join(F.broadcast(groups), "digest", "left")
    else:
        # at most BROADCAST_GROUPS groups can be that large
        least = max(HOT_ROWS, told.count() // BROADCAST_GROUPS)
        hot, rest = groups.where(F.col("group_size") >= least), groups.where(F.col("group_size") < least)
        met = maybe.join(F.broadcast(hot), "digest").unionByName(maybe.join(F.broadcast(hot), "digest", "left_anti").join(rest.hint("shuffle_hash"), "digest", "left"))
    met = met.unionByName(told.where("not ask"), allowMissingColumns=True)
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return met.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), "digest")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = 256) -> DataFrame:
    """``docs`` without the rows whose text a smaller doc_id has too."""
    gone = exact_groups(docs, id_col, text_col, prefix).where("not kept").select(F.col("doc_id").alias("_gone"), F.col("digest").alias("_digest")).distinct()
    digest = F.unhex(F.sha2(normalised(F.col(f"`{text_col}`")), 256))
    return docs.join(gone, F.col(f"`{id_col}`").eqNullSafe(F.col("_gone")) & (digest == F.col("_digest")), "left_anti")
