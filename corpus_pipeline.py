"""A corpus pipeline of five of the training-data operators.

Each stage takes the documents its predecessor kept, as a Parquet table, and
returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonflow.llm import line_dedup, mixing, ngram_join, packing, quality
from seasonflow.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; rejected ones go."""
    return quality.keep_good(docs).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars`` follows the new text.
    Every document stays, also one whose lines all went."""
    out = line_dedup.dedup_lines(docs).drop("n_lines", "n_dropped")
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.length("text").cast(kind)).select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard
    similarity of 0.8 or more) stays."""
    return ngram_join.keep_one(docs, words=5, min_pct=80).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of at most 4096 ids."""
    packed = packing.pack(packing.pieces(docs, with_ids=False))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage), ("near duplicates", near_duplicate_stage),
          ("source mixing", mixing_stage), ("packing", packing_stage)]

# Pivotal rounding and tokenizing have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared
    folder and read again, so that a lost executor repeats tasks of one stage."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        before, docs = docs, scratch.save(out, "stage")
        scratch.drop(before)
    return docs
