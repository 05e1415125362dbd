"""Token counts through a digest cache (operator 7).

Every text's digest is joined with a stored table of counts per tokenizer version; only distinct texts that
the table lacks are encoded, and their counts are appended to it. Each call appends a folder of its own, so a call that fails
leaves nothing that is read, and two that run at once don't disturb each other; a digest that both stored counts once.

Defined results: a null text counts as empty (0 tokens); null or repeated ids are kept, one row in, one row
out; equal texts are encoded once however many rows share them; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import batches_of_bytes, prepare, texts
from fleetlake.llm.tokenize import byte_level_counts, file_digest
from fleetlake.session import ensure_checkpoint_dir

CACHE_SCHEMA = "digest binary, n_tokens bigint"


def normalised(text):
    """Content whose digest is the cache key. Counts must be those of the text as it stands, so only null
    and empty are made alike."""
    return F.coalesce(text, F.lit(""))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stored_counts(spark: SparkSession, cache_dir: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for one tokenizer version; a digest that two calls found missing at once is there twice."""
    path = f"{cache_dir}/tokenizer={version}"
    if not _exists(spark, path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).option("recursiveFileLookup", "true").parquet(path)


def lasting_cache(spark: SparkSession, of: str) -> str:
    """The cache folder for texts of the tables at ``of``: the same on every call and in every application that shares
    ``spark.checkpoint.dir``. Tables at another place have a cache of their own."""
    own = ensure_checkpoint_dir(spark)
    return os.path.join(spark.conf.get("spark.checkpoint.dir", own), "token-cache", hashlib.sha256(of.rstrip("/").encode()).hexdigest()[:16])


def _counted(path: str):
    def run(batches):
        for part, _ in batches_of_bytes(batches, uses="tokenizers"):
            counts = byte_level_counts(path, part.column(part.schema.get_field_index("text")))
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("digest")), pa.array(counts, pa.int64())],
                                             ["digest", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, cache_dir: str) -> DataFrame:
    """(doc_id, digest, n_bytes, n_tokens) for every row of ``docs``; appends what it had to encode to the cache.

    The distinct texts are found by a map-side aggregate, so a text that a third of all rows share is reduced
    in each task before it moves; the counts join back to narrow rows, whose skew AQE can split.
    """
    spark = docs.sparkSession
    prepare(spark)
    version = file_digest(tokenizer_path)
    keyed = texts(docs).withColumn("text", normalised(F.col("text"))).withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
    known = stored_counts(spark, cache_dir, version)
    missing = keyed.groupBy("digest").agg(F.first("text").alias("text")).join(known, "digest", "left_anti")
    fresh = missing.select("digest", "text").mapInArrow(_counted(tokenizer_path), CACHE_SCHEMA)
    fresh.write.parquet(f"{cache_dir}/tokenizer={version}/call={uuid.uuid4().hex}")
    narrow = keyed.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes"))
    # the join needs the counts by digest anyway: making each one row adds no shuffle
    counts = stored_counts(spark, cache_dir, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return narrow.join(counts, "digest").select("doc_id", "digest", "n_bytes", "n_tokens")
