"""Loaders: static full refresh (E1) and daily incremental load (E2) from landed pages into a ``Lake``.

E1  pages -> records -> normalise (one select) -> overwrite table -> metrics; after all tables
    succeeded, stamp the control row. Any failure aborts before the stamp.
E2  last successful run (I1) -> watermark = newest loaded date, else the run's date (I2) -> landings that no load has
    taken in (I3, ``ledger``) -> their records with date >= watermark (inclusive: the last day is re-read) -> normalise -> keep-last
    per merge key / (asset_id, date) / whole row (I4-I6) -> stage (rows counted) -> empty: stop, no log
    (S13) -> upsert (I7-I9) or create partitioned by date (S6) -> row count + duplicates in one pass (I10, I11) -> warn (I12) ->
    append the run log (I13) and the load's metrics (S12). A failing write raises and logs nothing (I14).
A batch is complete or it fails: there is no "keep the partial pages and log success".
Driver traffic: the watermark scalar, the metric row, the touched dates (bounded by days).
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlake.config import EndpointConfig, STATIC_ENDPOINTS, endpoint_config
from fleetlake.operators.dedup import keep_last
from fleetlake.operators.normalize import blank_candidates, blank_columns, normalize
from fleetlake.operators.quality import table_profile
from fleetlake.operators.upsert import upsert_table
from fleetlake.sources import landings
from fleetlake.sources.pages import SEQ, read_known, read_pages
from fleetlake.sources.tables import RUN_LOG_TABLE, Lake, write_with_metrics

log = logging.getLogger("fleetlake.ingest")


@dataclass
class LoadResult:
    table: str
    records: int            # rows written from this batch (after dedup)
    table_rows: int = 0
    duplicates: int = 0
    columns: int = 0
    skipped: bool = False


def _now(spark: SparkSession) -> _dt.datetime:
    """The session's clock, as the instant that ``createDataFrame`` stores for a naive local time."""
    return _dt.datetime.now(_dt.timezone.utc).astimezone()


# I1 - I3 -------------------------------------------------------------------------------------------------
def last_successful_run(lake: Lake, endpoint: str):
    """Newest ``last_run_time`` of ``endpoint`` in the run log, or None."""
    if not lake.exists(RUN_LOG_TABLE):
        return None
    return _runs_of(lake, endpoint).agg(F.max("last_run_time").alias("m")).first()["m"]


def _runs_of(lake: Lake, endpoint: str) -> DataFrame:
    """The endpoint's run log, read from its own folder."""
    return lake.read(RUN_LOG_TABLE).where(F.col("endpoint") == endpoint)


def watermark(lake: Lake, cfg: EndpointConfig):
    """The day to re-read from. None (full load) when there is no successful run."""
    last = last_successful_run(lake, cfg.endpoint)
    if last is None:
        return None
    if lake.exists(cfg.table):
        newest = newest_date(lake, cfg.table)
        if newest is not None:
            return newest.date() if isinstance(newest, _dt.datetime) else newest
    # the run's day in the session's zone, not the driver's
    return _runs_of(lake, cfg.endpoint).agg(F.to_date(F.max("last_run_time")).alias("d")).first()["d"]


def newest_date(lake: Lake, table: str, date_col: str = "date"):
    """``MAX(date)`` of a loaded table. Daily tables are partitioned by date, so the folder names
    answer it without reading a file; an unpartitioned table is scanned (date column only)."""
    values = lake.partition_values(table, date_col)
    if values is not None:
        parsed = [_dt.datetime.fromisoformat(v) for v in values if v != "__HIVE_DEFAULT_PARTITION__"]
        return max(parsed) if parsed else None
    return lake.read(table).agg(F.max(date_col).alias("m")).first()["m"]


def since(df: DataFrame, wm, date_col: str = "date") -> DataFrame:
    """Rows on or after the watermark day (inclusive). Rows without a date are kept by every load: they
    can't be told to be old, and the upsert places them by key."""
    if wm is None:
        return df
    return df.where(F.col(date_col).isNull() | (F.to_date(F.col(date_col)) >= F.lit(wm).cast("date")))


# dedup choice ------------------------------------------------------------------------------------------
def dedup_keys(cfg: EndpointConfig, columns: list[str]) -> list[str] | None:
    """I4 merge key; I5 (asset_id, date) when the key is unset or absent; None = whole row."""
    if cfg.merge_key and cfg.merge_key in columns:
        return [cfg.merge_key]
    if "asset_id" in columns and "date" in columns:
        return ["asset_id", "date"]
    return None


def merge_keys(cfg: EndpointConfig, columns: list[str]) -> list[str]:
    """Keys of the upsert: the merge key when it is in the data, else (asset_id, date)."""
    keys = dedup_keys(cfg, columns)
    return keys if keys is not None else [c for c in columns if c != SEQ]


def prepare(records: DataFrame, cfg: EndpointConfig, blank_all_null: bool = True, wm=None) -> DataFrame:
    """Normalise, drop what is older than the watermark (a date that can't be read is NULL by then), keep the last record per key (dedup after casts, so two spellings of a day
    are one key). Drops ``_seq``. ``blank_all_null=False`` leaves N2 to the caller."""
    norm = normalize(records, cfg, keep=(SEQ,), blank_all_null=blank_all_null)
    if "date" in norm.columns:
        norm = since(norm, wm)
    keys = dedup_keys(cfg, norm.columns)
    if keys is None:
        keys = [c for c in norm.columns if c != SEQ]
    return keep_last(norm, keys, [SEQ]).drop(SEQ)


# E2 -------------------------------------------------------------------------------------------------------
def load_daily(spark: SparkSession, lake: Lake, landed: str, endpoint: str, now: _dt.datetime | None = None,
               evolve: bool = False, records: DataFrame | None = None, use_watermark: bool = True,
               verify_table: bool = True, ledger: bool = False) -> LoadResult:
    """E2 for one endpoint. With ``ledger``, ``landed`` is a root of landing folders and only what no earlier load has
    taken in is opened (I3). ``records`` replaces reading ``landed`` (the stream passes its batch and
    turns the watermark off: a file stream only ever sees new files). ``verify_table=False`` skips
    the whole-table check (I10-I12), for a caller that verifies once after several batches."""
    cfg = endpoint_config(endpoint)
    now = now or _now(spark)
    wm = watermark(lake, cfg) if use_watermark else None
    fresh = landings.unread(lake, endpoint, landed) if ledger else []
    if ledger and not fresh:
        return _nothing_new(cfg)
    with lake.staging():                                                 # staged copies go on success
        present = None
        if records is None:
            records, present = _landed_records(spark, lake, cfg, [x for s in fresh for x in s.landings] if ledger else landed, evolve)
        if not [c for c in records.columns if c != SEQ]:                    # nothing landed at all
            res = _nothing_new(cfg)
        else:
            res = _load_batch(lake, cfg, records, endpoint, now, evolve, verify_table, wm, present)
    landings.record(lake, endpoint, fresh, now)                          # taken in, whether or not it held new rows
    return res


def _landed_records(spark: SparkSession, lake: Lake, cfg: EndpointConfig, landed, evolve: bool) -> tuple[DataFrame, Callable[[str], bool] | None]:
    """The landed records and, where the table's columns were read, which of them the batch holds at all.

    A table that exists says which columns to read and as what, so its loads parse each landed byte once and stage no text.
    ``evolve`` must see every key, so it infers, as the first load does."""
    if evolve or not lake.exists(cfg.table):
        return read_pages(spark, landed, stage=lake.stage_lines), None
    sent_as = {v: k for k, v in cfg.renames.items()}
    types = {sent_as.get(f.name, f.name): f.dataType for f in lake.read(cfg.table).schema}
    seen = Observation("cells")
    records = read_known(spark, landed, types, as_text=[c for c in types if c in cfg.configured], seen=seen)
    places = {cfg.renames.get(c, c): f"p{i}" for i, c in enumerate(types)}
    return records, lambda column: seen.get[places[column]] > 0


def _load_batch(lake: Lake, cfg: EndpointConfig, recs: DataFrame, endpoint: str, now: _dt.datetime, evolve: bool,
                verify_table: bool, wm, present: Callable[[str], bool] | None = None) -> LoadResult:
    # the deduplicated batch is staged (lineage cut); the non-NULL count of every column N2 may blank is observed while it
    # is written, and its rows come from the written files' footers, so neither costs a pass of its own. An
    # observed count may be too high after a retried task: it only tells none from some
    candidates = blank_candidates(recs, cfg, keep=(SEQ,))
    obs = Observation("batch")
    staged = lake.stage(cfg.table + "_batch", prepare(recs, cfg, blank_all_null=False, wm=wm), observation=obs,
                        metrics=[F.count(F.col(f"`{c}`")).alias(f"nn{i}") for i, c in enumerate(candidates)])
    m = obs.get
    n = staged.count()
    if n == 0:                                                           # S13: no write, no run-log row
        return _nothing_new(cfg)
    # N2, on the first load or where the table's column is text: an all-NULL number stays NULL, as does a column the batch lacks
    stored = {f.name: f.dataType.simpleString() for f in lake.read(cfg.table).schema} if lake.exists(cfg.table) else {}
    src = blank_columns(staged, {c for i, c in enumerate(candidates) if m[f"nn{i}"] == 0 and stored.get(c, "string") == "string"
                                 and (present is None or present(c))})
    keys = merge_keys(cfg, src.columns)
    upsert_table(lake, cfg.table, src, keys, partition_col="date" if "date" in src.columns else None,
                 evolve=evolve, source_staged=True)
    res = verify(lake, cfg, keys, n, src if "date" in keys else None) if verify_table else LoadResult(cfg.table, n, columns=len(src.columns))
    lake.log_run(endpoint, now, n)                                       # only after a successful write
    lake.log_metrics(endpoint, now, res, checked=verify_table)
    return res


def _nothing_new(cfg: EndpointConfig) -> LoadResult:
    log.info("%s: no new or updated data", cfg.endpoint)
    return LoadResult(cfg.table, 0, skipped=True)


def verify(lake: Lake, cfg: EndpointConfig, keys: list[str], records: int, batch: DataFrame | None = None) -> LoadResult:
    """I10-I12. Keys that hold the date repeat only within a date, so with the ``batch`` just loaded its dates alone
    are checked (the others were when they were loaded), and the row count comes from the files' footers."""
    t = lake.read(cfg.table)
    checked = t
    if batch is not None:
        day = F.col("date").cast("string").alias("day")
        days = [r["day"] for r in batch.select(day).distinct().collect()]          # bounded by the calendar
        known = [F.lit(d).cast(t.schema["date"].dataType) for d in sorted(d for d in days if d is not None)]
        checked = t.where((F.col("date").isin(*known) if known else F.lit(False)) | (F.col("date").isNull() if None in days else F.lit(False)))
    row = table_profile(checked, keys=keys).first()
    rows = t.count() if batch is not None else row["row_count"]
    res = LoadResult(cfg.table, records, rows, row["duplicates"], len(t.columns))
    if res.duplicates > 0:
        log.warning("%s: %d duplicate keys in table", cfg.table, res.duplicates)
    return res


# E1 -------------------------------------------------------------------------------------------------------
def load_static(spark: SparkSession, lake: Lake, landed: str, endpoint: str, records: DataFrame | None = None,
                now: _dt.datetime | None = None) -> LoadResult:
    """E1 for one endpoint. N2 is decided by the write itself: the non-NULL count of every column it
    may blank is observed while the table is written; only if a column turns out all-NULL (rare) is
    the table rewritten, from a staged copy, with that column as ""."""
    cfg = endpoint_config(endpoint)
    with lake.staging():
        recs = records if records is not None else read_pages(spark, landed, stage=lake.stage_lines)
        keep = (SEQ,) if SEQ in recs.columns else ()
        candidates = blank_candidates(recs, cfg, keep=keep)
        df = normalize(recs, cfg, keep=keep, blank_all_null=False).drop(*keep)
        m = write_with_metrics(df, lambda d: lake.overwrite(cfg.table, d),
                               metrics=[F.count(F.col(f"`{c}`")).alias(f"nn{i}") for i, c in enumerate(candidates)])
        blanks = {c for i, c in enumerate(candidates) if m[f"nn{i}"] == 0}
        if blanks:                                                        # N2
            lake.overwrite(cfg.table, lake.stage(cfg.table, blank_columns(lake.read(cfg.table), blanks)))
    rows = lake.read(cfg.table).count()                                   # from the footers
    res = LoadResult(cfg.table, rows, rows, 0, m["columns"])
    lake.log_metrics(endpoint, now or _now(spark), res, checked=False)
    return res


def refresh_static(spark: SparkSession, lake: Lake, landing_root: str, pipeline: str = "fleet_static_tables",
                   endpoints=STATIC_ENDPOINTS, now: _dt.datetime | None = None) -> list[LoadResult]:
    """All static endpoints in turn; the control row says 'success' only if every one loaded."""
    now = now or _now(spark)
    lake.init_control(pipeline, now)
    results = [load_static(spark, lake, f"{landing_root}/{c.endpoint}", c.endpoint, now=now) for c in endpoints]
    lake.stamp_control(pipeline, now, "success")
    return results
