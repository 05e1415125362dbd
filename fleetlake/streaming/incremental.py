"""The daily incremental load as a file stream over landed pages.

``readStream`` picks up new page files; the stream checkpoint (on shared storage) replaces the fetch
offset, so a restarted job continues where it stopped and never re-applies a committed batch. Each
micro-batch runs the same steps as the batch loader — normalise, keep-last, upsert, verify, run log —
inside ``foreachBatch``. Upserts are idempotent by key, so replaying a batch after a failure between
the write and the checkpoint commit leaves the same table. Late data: any lateness is accepted, the
upsert by key places it.

Files arrive in any order, but the newest record of a key is the one that was landed last. With ``ordered`` the
stream keeps the last record per key as state (a streaming ``max_by`` over the landing order, update mode): a key that a
micro-batch touches comes out with its newest record so far, so a landing that arrives late doesn't overwrite
a later one, and the table is that of one batch over all landings. The state holds one row per key, in RocksDB where the
session names no other store. Pages of one file that carry no offset count as one place in that order.

``trigger(availableNow=True)`` processes what is landed and stops (the scheduled daily run); without
it the same query runs continuously.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from fleetlake.config import EndpointConfig, endpoint_config
from fleetlake.operators.dedup import keep_last
from fleetlake.operators.normalize import normalize
from fleetlake.plans.ingest import LoadResult, dedup_keys, load_daily, merge_keys, verify
from fleetlake.sources.pages import SEQ, page_records
from fleetlake.sources.tables import Lake

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class StreamLoad:
    query: StreamingQuery
    verified: LoadResult | None = None     # the table check after an availableNow run


def newest_records(pages: DataFrame, cfg: EndpointConfig) -> DataFrame:
    """The records of a stream of pages, normalised; of each key the last one landed so far, whenever a micro-batch touches it."""
    records = normalize(page_records(pages), cfg, keep=(SEQ,), blank_all_null=False)
    keys = dedup_keys(cfg, records.columns)
    # whole-row dedup has no order to keep: equal rows are one wherever they come from
    return records if keys is None else keep_last(records.withColumn("_order", records[SEQ]), keys, ["_order"]).drop("_order")


def run_incremental_stream(spark: SparkSession, lake: Lake, landing_dir: str, endpoint: str,
                           checkpoint_dir: str, page_schema: T.StructType, available_now: bool = True,
                           max_files_per_trigger: int | None = None, now: _dt.datetime | None = None,
                           verify_each_batch: bool | None = None, ordered: bool = True) -> StreamLoad:
    """Start the stream; with ``available_now`` it returns after all landed files are loaded.

    The whole-table check (row count, duplicate keys) is a full pass over the table, so an
    ``available_now`` run does it once after the last micro-batch instead of after every one; a
    continuous stream checks per batch unless ``verify_each_batch=False``. Every micro-batch still
    appends its run-log row."""
    cfg = endpoint_config(endpoint)  # unknown endpoints get the empty config, like the batch loader
    per_batch = (not available_now) if verify_each_batch is None else verify_each_batch
    loaded = [0]                           # rows merged by this run's micro-batches (foreachBatch runs here)

    def apply(batch: DataFrame, batch_id: int) -> None:
        res = load_daily(spark, lake, landing_dir, endpoint, now=now, records=batch if ordered else page_records(batch),
                         use_watermark=False, verify_table=per_batch)
        loaded[0] += res.records

    reader = spark.readStream.schema(page_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # the file of each page goes along: it orders the records within the batch
    pages = reader.option("mode", "FAILFAST").json(landing_dir).select("*", "_metadata")
    if ordered:
        pages = newest_records(pages, cfg)
    w = pages.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    store = spark.conf.get(STATE_STORE, DEFAULT_STORE)
    if store == DEFAULT_STORE:
        spark.conf.set(STATE_STORE, ROCKSDB)                   # fixed for the query at its start
    q = w.start()
    if store == DEFAULT_STORE:
        spark.conf.unset(STATE_STORE)
    if not available_now:
        return StreamLoad(q)
    q.awaitTermination()
    verified = None
    if not per_batch and lake.exists(cfg.table):
        verified = verify(lake, cfg, merge_keys(cfg, lake.read(cfg.table).columns), loaded[0])
    return StreamLoad(q, verified)
