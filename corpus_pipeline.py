"""The training-data pipeline: language ID, line dedup, near duplicates, decontamination, token ids.

Each stage works on all documents its predecessor kept and returns the columns of ``documents``; the
last returns the digests of the encoded texts.  Between stages documents are written as Parquet.

Null texts have no letter and go in the first stage; so do texts without one.  Very long texts are
worked on whole in every stage.  Of repeated rows of one doc_id all stay or all go; of ties and copies
under several ids the smallest doc_id stays.  Rows with a null doc_id have no partner to be a copy of
and stay, unless they are contaminated.  An empty table passes through; null values in other columns
and extra columns, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm._shared import release, settle
from tickloom.llm.decontaminate import decontaminate
from tickloom.llm.langid import fit, predict
from tickloom.llm.line_dedup import drop_repeated_lines
from tickloom.llm.ngram_join import ngram_components
from tickloom.llm.sentencepieces import digests

#: a document is rejected whose best language has less than so many times the mean share of a language
LEAST_LIFT = 1.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; the model learns from this stage's labelled rows."""
    model = fit(docs)
    done = predict(docs, model)
    least = LEAST_LIFT / len(model.languages) if model and len(model.languages) > 1 else 0.0
    return done.where((F.col("lang_id.lang") != "und") & (F.col("lang_id.score") >= least)).drop("lang_id")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines; ``n_chars`` follows the text."""
    return drop_repeated_lines(docs).drop("line_counts").withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component."""
    gone = ngram_components(docs).where("component_id <> doc_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by the benchmark; a document is its doc_id, null or not, and its text."""
    bad = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"))
    return docs.join(bad, docs.doc_id.eqNullSafe(bad["_id"]) & (F.xxhash64(docs.text) == bad["_body"]), "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("decontaminate", decontamination),
    ("sentencepiece", encode),
]

#: the first and last stages can't be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        before, docs = docs, settle(stage(spark, docs, sf_dir), "snappy")
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
