"""Corpus pipeline: the documents pass through five operators in turn.

Each stage works on all documents that its predecessor kept, and its decisions
take effect: the quality classifier drops what it rejects, MinHash near-dedup
keeps one document of each group, substring dedup removes the words of repeated
passages, benchmark decontamination drops documents that leak an item, and the
last stage encodes what is left.  All but the last return the columns of
``documents``.  Null ids, null, empty and very long texts and repeated rows pass
every stage as its operator states; empty tables give empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bpe_tree import encode_decode
from strata.llm.graph import few
from strata.llm.importance_filter import resample
from strata.llm.minhash_postings import near_duplicates
from strata.llm.relative_factors import parsed
from strata.llm.template_leaks import judged
from strata.operators.ranking import dense_index
from strata.session import ensure_checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    docs = docs.select(*COLUMNS)
    gone = few(resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter("not kept")
               .select(F.col("doc_id").alias("__id"), F.col("version").alias("__version")).distinct())
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__version")), "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles,
    similarity 0.8 or more): the one with the smallest doc_id.  Where an id
    stands on several texts, rows are told apart by id and text, so that every
    text keeps a representative; equal rows stay or go together."""
    docs = docs.select(*COLUMNS)
    version = F.xxhash64("text").alias("__version")
    rows = docs.select("doc_id", version).distinct()
    if rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        gone = few(near_duplicates(docs, words=5, percent=80).filter("not kept").select("doc_id").distinct())
        return docs.join(gone, "doc_id", "left_anti")
    numbered = dense_index(rows.filter("doc_id is not null"), ["doc_id", "__version"], name="__row").toDF("__id", "__v", "__row").checkpoint()
    tagged = docs.join(numbered, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__v")), "left").drop("__id", "__v")
    found = near_duplicates(tagged.select(F.col("__row").alias("doc_id"), "text"), words=5, percent=80)
    gone = few(found.filter("not kept").select(F.col("doc_id").alias("__row")).distinct())
    return tagged.join(gone, "__row", "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages of ``WINDOW`` or more words that
    occur earlier; a document with nothing removed keeps its text as it is."""
    return parsed(docs.select(*COLUMNS), keep_text=True).select(
        "doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return judged(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("__items is null").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian u32) and whether they decode to the
    text."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return encode_decode(text, keep_decoded=False)


STAGES = [("quality classifier", quality), ("minhash near-dedup", near_dedup), ("substring dedup", substring_dedup),
          ("benchmark decontamination", decontaminate), ("byte-level bpe", encode)]
#: Stages 1, 2, 3 and 5 are beyond SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared
    checkpoint folder and read again by the next."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
