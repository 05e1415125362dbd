"""A corpus from raw documents to packed sequences: quality, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes what the one before kept, as written and read again, and its decisions take effect: rejected documents
are gone, one document of each group of near duplicates stays (the smallest id; equal rows of one id are one),
repeated passages are cut out of all but the first document that holds them, documents that hold a benchmark item are gone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import decontamination, near_dedup, packing, quality_model, substring_dedup
from fleetlake.llm.common import discard, prepare, read_table, scratch, small_or_not, staged, without_ids
from fleetlake.llm.queries import tokenizer_file


def stage(fn: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage whose result names, as ``reads``, the tables staged for it: they may go once the result is written."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        with scratch() as made:
            out = fn(spark, docs, sf_dir)
        out.reads = made
        return out
    return run_stage


FEW = 1_000_000  # ids (16 bytes each) that are broadcast at most; more join by a shuffle


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. A row is judged by its own text, also where ids repeat or are null."""
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    judged = quality_model.scored_documents(docs, read_table(spark, sf_dir, "labels"), also={"text_hash": own})
    rejected = small_or_not(staged(judged.where("not kept").select("doc_id", "text_hash").distinct(), "rejected"), FEW)
    return docs.join(rejected, docs["doc_id"].cast("bigint").eqNullSafe(rejected["doc_id"]) & (own == rejected["text_hash"]), "left_anti")


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    found = staged(near_dedup.near_duplicates(docs, k=5, percent=80).select("doc_id", "kept").where("doc_id is not null"), "kept")
    gone = staged(found.where("not kept").select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    left = without_ids(docs, gone, FEW)
    again = staged(found.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "again")
    if not again.limit(1).count():
        return left
    return without_ids(left, again, FEW).unionByName(without_ids(left, again, FEW, "left_semi").dropDuplicates(["doc_id", "text"]))


@stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one of smaller id holds too."""
    return substring_dedup.cut_passages(docs, substring_dedup.repeated_passages(docs))


@stage
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: its sequence and place there."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality_classifier", quality), ("minhash_near_dedup", near_duplicates), ("substring_dedup", repeated_passages),
          ("benchmark_decontamination", decontaminated), ("best_fit_packing", packed)]

# a fitted model, sketches and alignments: no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again, and then what it and the one before had staged goes."""
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, fn in STAGES[:-1]:
        out = fn(spark, docs, sf_dir)
        docs = staged(out, name)
        discard(*out.reads, *([last] if last is not None else []))
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
