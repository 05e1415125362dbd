"""Registered ingestion checks: land data derived from the given tables as API pages / CSV, load it
with the real loaders into a lake on shared storage, and return what was loaded.

Each builder writes under a fresh folder of ``spark.checkpoint.dir`` (the cluster's shared storage).
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.config import EndpointConfig, endpoint_config
from fleetlake.functions.dates import day_start
from fleetlake.operators.dedup import keep_last
from fleetlake.operators.normalize import normalize
from fleetlake.operators.upsert import upsert_table
from fleetlake.plans.ingest import load_daily, load_static, prepare, refresh_static
from fleetlake.plans.oracle import QUERY_SQL
from fleetlake.plans.queries import q14_site_rollup, q16_daily_consistency
from fleetlake.plans.views import TestDataFleet
from fleetlake.session import shared_dir
from fleetlake.sources import landings
from fleetlake.sources.catalog import CatalogLake
from fleetlake.sources.csv import UTILIZATION_CSV_SCHEMA, read_csv, write_csv
from fleetlake.sources.pages import SEQ, land_pages, page_schema_of, read_pages
from fleetlake.sources.tables import CONTROL_TABLE, CatalogTables, Lake
from fleetlake.streaming.incremental import run_incremental_stream

CUT_TARGET = "2024-01-20 00:00:00"      # first load: days before this
CUT_SOURCE = "2024-01-18 12:00:00"      # second load: events from here on (day 18 is partial -> changed)


def _events_daily_rows(events: DataFrame) -> DataFrame:
    """Daily utilisation rows (asset_id, date, ...) from a slice of events; seq from (asset, day)."""
    g = events.groupBy(F.col("user_id").alias("asset_id"), day_start("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("ts").cast("timestamp")).alias("updated_at"))
    return g.select("asset_id", "date", (F.col("n") * 3600).cast("bigint").alias("active_run_seconds"),
                    (F.col("n").cast("double") * 100.0 / 24.0).alias("utilization_percentage"), "updated_at",
                    (F.col("asset_id") * 100000 + F.datediff(F.to_date("date"), F.lit("1990-01-01").cast("date")))
                    .alias("seq"))


def s1_pages_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + N: events served as pages with a nested ``props`` object, read back and normalised."""
    ev = TestDataFleet(spark, sf_dir)["events"]
    landing = shared_dir(spark, "landing-events")
    land_pages(ev.select("event_id", "ts", "user_id", "event_type", "value",
                         F.from_json("props", "k bigint").alias("props"), F.col("event_id").alias("seq")),
               landing, "seq")
    cfg = EndpointConfig("events", "events", datetime_cols=("ts",), long_int_cols=("event_id", "user_id"))
    return normalize(read_pages(spark, landing), cfg, keep=(SEQ,)).drop(SEQ)


def i4_keep_last_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of every (user, day), by event order."""
    ev = TestDataFleet(spark, sf_dir)["events"]
    rows = ev.select(F.col("user_id").alias("asset_id"), day_start("ts").alias("date"), "event_id",
                     "event_type", "value")
    return keep_last(rows, ["asset_id", "date"], ["event_id"])


def _land_two_batches(spark, sf_dir, landing):
    ev = TestDataFleet(spark, sf_dir)["events"]
    first = _events_daily_rows(ev.where(F.col("ts") < F.lit(CUT_TARGET).cast("timestamp_ntz")))
    second = _events_daily_rows(ev.where(F.col("ts") >= F.lit(CUT_SOURCE).cast("timestamp_ntz")))
    land_pages(first, f"{landing}/batch1", "seq")
    land_pages(second, f"{landing}/batch2", "seq")


def e2_daily_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 twice: initial load of days before the cut, then an incremental run whose watermark is the
    newest loaded day, so only source rows on or after that day are merged."""
    root = shared_dir(spark, "e2")
    _land_two_batches(spark, sf_dir, f"{root}/landing")
    lake = Lake(spark, f"{root}/lake")
    ep = "asset-utilizations-daily"
    load_daily(spark, lake, f"{root}/landing/batch1", ep, now=_dt.datetime(2024, 1, 20, 2))
    load_daily(spark, lake, f"{root}/landing/batch2", ep, now=_dt.datetime(2024, 1, 31, 2))
    return lake.read("asset_utilizations_daily")


def t1_stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both landed batches through the file stream (availableNow); every landed row is merged."""
    root = shared_dir(spark, "t1")
    landing = f"{root}/landing"
    _land_two_batches(spark, sf_dir, landing)
    lake = Lake(spark, f"{root}/lake")
    schema = page_schema_of(spark, f"{landing}/*")
    run_incremental_stream(spark, lake, f"{landing}/*", "asset-utilizations-daily", f"{root}/checkpoint",
                           schema, max_files_per_trigger=None, now=_dt.datetime(2024, 1, 31, 2))
    return lake.read("asset_utilizations_daily")


def t1_late_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 over two runs of one stream: the later landing arrives first, the earlier one after it; the later one's records stay."""
    root = shared_dir(spark, "t1-late")
    _land_two_batches(spark, sf_dir, f"{root}/made")
    schema = page_schema_of(spark, f"{root}/made/*")
    lake = Lake(spark, f"{root}/lake")
    for i, batch in enumerate(("batch2", "batch1")):
        spark.read.text(f"{root}/made/{batch}").write.text(f"{root}/landing/{batch}")
        run_incremental_stream(spark, lake, f"{root}/landing/*", "asset-utilizations-daily", f"{root}/checkpoint", schema, now=_utc(2024, 1, 30 + i, 2))
    return lake.read("asset_utilizations_daily")


def i8_upsert_moved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I7 single key with rows that move to another date partition (and partitions left empty)."""
    ev = TestDataFleet(spark, sf_dir)["events"]
    root = shared_dir(spark, "i8")
    lake = Lake(spark, f"{root}/lake")
    base = ev.select("event_id", F.col("user_id").alias("asset_id"), "event_type", "value",
                     day_start("ts").alias("date"))
    target = base.where(F.col("date") < F.lit(CUT_TARGET).cast("timestamp"))
    source = (base.where(F.col("date") >= F.lit("2024-01-15").cast("timestamp"))
              .select("event_id", "asset_id", "event_type", (F.col("value") + 1).alias("value"),
                      (F.col("date") + F.expr("INTERVAL 1 DAY")).alias("date")))
    lake.overwrite("dt_events", target, partition_by=["date"])
    upsert_table(lake, "dt_events", source, ["event_id"], partition_col="date")
    return lake.read("dt_events")


def s2_csv_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The asset sheet exported as CSV (M/d/yyyy dates, Yes/No flags) and read back."""
    from pyspark.sql import types as T

    a = TestDataFleet(spark, sf_dir)["assets"]
    path = shared_dir(spark, "csv-assets")
    write_csv(a.select("asset_id", "name", "make", "model", "status", "purchase_price", "billable",
                       F.col("updated_at").alias("updated_on")), path,
              date_cols=("updated_on",), bool_cols=("billable",))
    schema = T.StructType([T.StructField("asset_id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("make", T.StringType()), T.StructField("model", T.StringType()),
                           T.StructField("status", T.StringType()), T.StructField("purchase_price", T.DoubleType()),
                           T.StructField("billable", T.StringType()), T.StructField("updated_on", T.StringType())])
    return read_csv(spark, path, schema, date_cols=("updated_on",), bool_cols=("billable",))


def e1_static_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The asset table served as pages, loaded by full refresh with the 'assets' endpoint config."""
    a = TestDataFleet(spark, sf_dir)["assets"]
    root = shared_dir(spark, "e1")
    land_pages(a.select("*", F.col("asset_id").alias("seq")), f"{root}/landing/assets", "seq")
    lake = Lake(spark, f"{root}/lake")
    load_static(spark, lake, f"{root}/landing/assets", "assets")
    return lake.read("assets")


def i6_exact_row_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An endpoint with neither merge key nor (asset_id, date) — the status of every order line
    (order, return flag, line status) served as pages; the loader's own dedup step collapses
    whole-row duplicates (lines of one order with the same flags) to one row each."""
    li = TestDataFleet(spark, sf_dir)["lineitem"]
    landing = shared_dir(spark, "landing-line-status")
    rows = li.select("l_orderkey", "l_returnflag", "l_linestatus",
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"))
    land_pages(rows, landing, "seq")
    cfg = endpoint_config("order-line-status")            # unknown endpoint: empty config, whole-row dedup
    return prepare(read_pages(spark, landing), cfg)


def n14_flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events served with ``props`` as a nested object, loaded with struct fields promoted to
    top-level columns (``props_k``) instead of JSON text."""
    ev = TestDataFleet(spark, sf_dir)["events"]
    landing = shared_dir(spark, "landing-events-nested")
    land_pages(ev.select("event_id", "ts", "user_id", "event_type", "value",
                         F.from_json("props", "k bigint").alias("props"), F.col("event_id").alias("seq")),
               landing, "seq")
    cfg = EndpointConfig("events", "events", datetime_cols=("ts",), long_int_cols=("event_id", "user_id"))
    return normalize(read_pages(spark, landing, structs=True), cfg, keep=(SEQ,), flatten_structs=True).drop(SEQ)


def s2_csv_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The utilisation sheet, its columns in another order, with quotes, commas and line breaks in cells."""
    u = TestDataFleet(spark, sf_dir)["asset_utilizations_daily"]
    path = shared_dir(spark, "csv-utilization")
    site = F.concat(F.lit('Pit "'), F.col("asset_id").cast("string"), F.lit('", north'))
    sheet = u.select("date", F.col("asset_id").cast("string").alias("asset_id"), F.col("active_run_seconds").cast("double").alias("active_hours"),
                     "utilization_percentage", F.when(F.col("asset_id") % 3 > 0, F.concat(F.lit("line 1\nline "), F.col("asset_id").cast("string"))).alias("assignee_name"),
                     F.when(F.col("asset_id") % 2 > 0, site).alias("site_name"))
    write_csv(sheet, path, date_cols=("date",))
    return read_csv(spark, path, UTILIZATION_CSV_SCHEMA, date_cols=("date",))


def n8_normalize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2-N11 over order lines with nested, binary, decimal, small and all-NULL columns, and cells that do not fit their configured type."""
    li = TestDataFleet(spark, sf_dir)["lineitem"]
    odd = F.col("l_linenumber") % 2 > 0
    rows = li.select(
        "l_orderkey", "l_linenumber", F.encode("l_returnflag", "UTF-8").alias("flag_bytes"), F.col("l_quantity").cast("decimal(12,2)").alias("amount"),
        F.col("l_linenumber").cast("smallint").alias("small"), F.struct(F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("flag")).alias("nested"),
        F.array("l_orderkey", "l_partkey").alias("keys"), F.lit(None).cast("string").alias("never"), F.lit(None).alias("void"),
        F.when(odd, "12.7").otherwise("n/a").alias("count_text"), F.when(odd, "2025-01-02T03:04:05Z").otherwise("soon").alias("at"),
        F.when(odd, "Yes").otherwise("maybe").alias("ok"), F.struct(F.col("l_partkey").alias("v")).alias("year"))
    cfg = EndpointConfig("lines", "lines", datetime_cols=("at",), long_int_cols=("count_text", "year", "absent"), boolean_cols=("ok",))
    return normalize(rows, cfg)


def _utc(*args) -> _dt.datetime:
    return _dt.datetime(*args, tzinfo=_dt.timezone.utc)


def s7_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after a first load, an incremental one, and one that brings nothing."""
    root = shared_dir(spark, "s7")
    _land_two_batches(spark, sf_dir, f"{root}/landing")
    lake, ep = Lake(spark, f"{root}/lake"), "asset-utilizations-daily"
    nothing = spark.read.json(f"{root}/landing/batch1").select("offset", F.slice("results", 1, 0).alias("results"))
    nothing.write.json(f"{root}/landing/empty")
    for i, batch in enumerate(("batch1", "batch2", "empty")):
        load_daily(spark, lake, f"{root}/landing/{batch}", ep, now=_utc(2024, 1, 20 + i, 2))
    return lake.runs()


def s8_static_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three static tables refreshed twice; each loaded table's rows beside the control row."""
    t = TestDataFleet(spark, sf_dir)
    root = shared_dir(spark, "s8")
    lake, names = Lake(spark, f"{root}/lake"), {"assets": "asset_id", "asset-labels": "asset_label_id", "asset-registrations": "asset_id"}
    endpoints = [endpoint_config(e) for e in names]
    for run in (0, 1):
        for cfg in endpoints:
            rows = t[cfg.table].select("*", F.col(names[cfg.endpoint]).alias("seq"))
            land_pages(rows if run else rows.where("seq % 2 = 0"), f"{root}/landing{run}/{cfg.endpoint}", "seq")
        refresh_static(spark, lake, f"{root}/landing{run}", endpoints=endpoints, now=_utc(2024, 2, 1 + run, 2))
    counts = [lake.read(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count", F.lit("fleet_static_tables").alias("pipeline_name"))
              for n in lake.tables() if n != CONTROL_TABLE]
    return reduce(DataFrame.unionAll, counts).join(lake.read(CONTROL_TABLE), "pipeline_name")


def i4_surrogate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: a daily endpoint with a key of its own; the second landing moves its readings a day on and repeats each, last one wins."""
    ev = TestDataFleet(spark, sf_dir)["events"]
    root = shared_dir(spark, "i4")
    lake, ep = Lake(spark, f"{root}/lake"), "asset-readings-daily"
    rows = ev.select(F.col("event_id").alias("asset_reading_daily_id"), F.col("user_id").alias("asset_id"), day_start("ts").alias("date"),
                     F.floor("value").cast("bigint").alias("cumulative_hours_end_of_day"), F.col("event_id").alias("seq"))
    land_pages(rows.where(F.col("date") < F.lit(CUT_TARGET).cast("timestamp")), f"{root}/day1", "seq")
    later = rows.where(F.col("date") >= F.lit(CUT_SOURCE).cast("timestamp")).withColumn("date", F.col("date") + F.expr("INTERVAL 1 DAY"))
    twice = later.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "asset_reading_daily_id", "asset_id", "date", (F.col("cumulative_hours_end_of_day") * F.col("n")).alias("cumulative_hours_end_of_day"),
        (F.col("seq") * 2 + F.col("n")).alias("seq"))
    land_pages(twice, f"{root}/day2", "seq")
    load_daily(spark, lake, f"{root}/day1", ep, now=_utc(2024, 1, 20, 2))
    load_daily(spark, lake, f"{root}/day2", ep, now=_utc(2024, 1, 31, 2))
    return lake.read("asset_readings_daily")


def e2_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch whose count has a fraction, whose configured column is an object, and that lacks a column: stored types stay."""
    ev = TestDataFleet(spark, sf_dir)["events"]
    root = shared_dir(spark, "e2-drift")
    lake, ep = Lake(spark, f"{root}/lake"), "asset-utilizations-daily"
    level = (F.col("active_run_seconds") / 3600).cast("bigint")
    first = _events_daily_rows(ev.where(F.col("ts") < F.lit(CUT_TARGET).cast("timestamp_ntz"))).withColumn("level", level)
    second = _events_daily_rows(ev.where(F.col("ts") >= F.lit(CUT_SOURCE).cast("timestamp_ntz")))
    second = second.select("asset_id", "date", "seq", (level + 0.5).alias("level"), F.struct(F.col("active_run_seconds").alias("v")).alias("active_run_seconds"))
    land_pages(first, f"{root}/day1", "seq")
    land_pages(second, f"{root}/day2", "seq")
    load_daily(spark, lake, f"{root}/day1", ep, now=_utc(2024, 1, 20, 2))
    load_daily(spark, lake, f"{root}/day2", ep, now=_utc(2024, 1, 31, 2))
    return lake.read("asset_utilizations_daily")


CUTS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", "2024-01-25 12:00:00")


def i3_landing_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings under one root, a load after each and one more when nothing is new. A landing is read by one load: its
    row holds the records of that load alone (an earlier landing read again would add its last day's)."""
    ev = TestDataFleet(spark, sf_dir)["events"]
    root = shared_dir(spark, "i3")
    lake, ep = Lake(spark, f"{root}/lake"), "asset-utilizations-daily"
    at = [F.lit(c).cast("timestamp_ntz") for c in CUTS]
    slices = (F.col("ts") < at[0], (F.col("ts") >= at[0]) & (F.col("ts") < at[1]), F.col("ts") >= at[2])
    for i, part in enumerate(slices):
        land_pages(_events_daily_rows(ev.where(part)), f"{root}/landing/batch{i}", "seq")
        load_daily(spark, lake, f"{root}/landing", ep, now=_utc(2024, 2, 1 + i, 2), ledger=True)
        load_daily(spark, lake, f"{root}/landing", ep, now=_utc(2024, 2, 1 + i, 3), ledger=True)
    taken = landings.ledger(lake).select("endpoint_name", "landing", F.col("load_time").alias("last_run_time"))
    return taken.join(lake.runs(), ["endpoint_name", "last_run_time"])


def i12_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics rows of a refresh and of two daily loads, where rows without an asset repeat."""
    t = TestDataFleet(spark, sf_dir)
    root = shared_dir(spark, "i12")
    lake = Lake(spark, f"{root}/lake")
    land_pages(t["assets"].select("*", F.col("asset_id").alias("seq")), f"{root}/landing/assets", "seq")
    load_static(spark, lake, f"{root}/landing/assets", "assets", now=_utc(2024, 2, 1, 2))
    ev = t["events"]
    for i, part in enumerate((F.col("ts") < F.lit(CUT_TARGET).cast("timestamp_ntz"), F.col("ts") >= F.lit(CUT_SOURCE).cast("timestamp_ntz"))):
        rows = _events_daily_rows(ev.where(part)).withColumn("asset_id", F.nullif("asset_id", F.lit(1)))
        land_pages(rows, f"{root}/landing/daily{i}", "seq")
        load_daily(spark, lake, f"{root}/landing/daily{i}", "asset-utilizations-daily", now=_utc(2024, 2, 2 + i, 2))
    return lake.metrics()


def s3_catalog_site_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14 over tables loaded into the catalog, read by their names; the asset table is loaded, then refreshed."""
    t = TestDataFleet(spark, sf_dir)
    root = shared_dir(spark, "s3")
    lake = CatalogLake(spark, f"{root}/lake", "fleet_" + root.rsplit("-", 1)[-1])
    for endpoint, key in (("asset-site-history", "asset_site_history_id"), ("asset-site-daily-utilizations", "asset_site_daily_utilization_id"), ("assets", "asset_id")):
        cfg = endpoint_config(endpoint)
        rows = t[cfg.table].select("*", F.col(key).alias("seq"))
        if endpoint == "assets":
            land_pages(rows.where("seq % 2 = 0").drop("make"), f"{root}/landing/half", "seq")
            load_static(spark, lake, f"{root}/landing/half", endpoint)
        land_pages(rows, f"{root}/landing/{endpoint}", "seq")
        load_static(spark, lake, f"{root}/landing/{endpoint}", endpoint)
    return q14_site_rollup(CatalogTables(spark, lake.database))


def j2_clustered_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16 over its three facts, loaded into catalog tables clustered by asset and day: its joins need no exchange."""
    t = TestDataFleet(spark, sf_dir)
    root = shared_dir(spark, "j2")
    lake = CatalogLake(spark, f"{root}/lake", "facts_" + root.rsplit("-", 1)[-1])
    for name in ("asset_readings_daily", "asset_utilizations_daily", "asset_net_working_hours_daily"):
        lake.cluster(name, t[name], ["asset_id", "date"])
    return q16_daily_consistency(CatalogTables(spark, lake.database))


_DAILY_ROWS_SQL = """
    SELECT user_id AS asset_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date,
           CAST(COUNT(*) * 3600 AS BIGINT) AS active_run_seconds,
           CAST(COUNT(*) AS DOUBLE) * 100.0 / 24.0 AS utilization_percentage,
           MAX(CAST(ts AS TIMESTAMP)) AS updated_at
    FROM events WHERE {cond} GROUP BY user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP)"""
_FIRST = _DAILY_ROWS_SQL.format(cond=f"ts < TIMESTAMP '{CUT_TARGET}'")
_SECOND = _DAILY_ROWS_SQL.format(cond=f"ts >= TIMESTAMP '{CUT_SOURCE}'")

_SLICES = [_DAILY_ROWS_SQL.format(cond=c) for c in (f"ts < TIMESTAMP '{CUTS[0]}'", f"ts >= TIMESTAMP '{CUTS[0]}' AND ts < TIMESTAMP '{CUTS[1]}'", f"ts >= TIMESTAMP '{CUTS[2]}'")]

ORACLE = {
    "j2_clustered_facts": QUERY_SQL["q16_daily_consistency"],
    "s3_catalog_site_rollup": QUERY_SQL["q14_site_rollup"],
    "i3_landing_ledger": f"""
        WITH b0 AS ({_SLICES[0]}), b1 AS (SELECT * FROM ({_SLICES[1]}) x WHERE date >= (SELECT max(date) FROM b0)),
             b2 AS (SELECT * FROM ({_SLICES[2]}) x WHERE date >= (SELECT max(date) FROM b1))
        SELECT 'asset-utilizations-daily' AS endpoint_name, landing, TIMESTAMP '2024-02-01 02:00:00' + days * INTERVAL 1 DAY AS last_run_time, records_processed
        FROM (SELECT 'batch0' AS landing, 0 AS days, count(*) AS records_processed FROM b0 UNION ALL SELECT 'batch1', 1, count(*) FROM b1
              UNION ALL SELECT 'batch2', 2, count(*) FROM b2)""",
    "i12_load_metrics": f"""
        WITH b0 AS (SELECT nullif(asset_id, 1) AS asset_id, date FROM ({_FIRST}) x),
             b1 AS (SELECT nullif(asset_id, 1) AS asset_id, date FROM ({_SECOND}) x WHERE date >= (SELECT max(date) FROM b0)),
             loaded AS (SELECT * FROM b0 WHERE NOT EXISTS (SELECT 1 FROM b1 WHERE b1.asset_id = b0.asset_id AND b1.date = b0.date) UNION ALL SELECT * FROM b1),
             daily AS (SELECT 2 AS day, (SELECT count(*) FROM b0) AS records, (SELECT count(*) FROM b0) AS table_rows, (SELECT count(*) FROM b0 WHERE asset_id IS NULL) AS duplicates
                       UNION ALL SELECT 3, (SELECT count(*) FROM b1), (SELECT count(*) FROM loaded),
                                        (SELECT count(*) FROM loaded WHERE asset_id IS NULL AND date IN (SELECT date FROM b1)))
        SELECT 'asset-utilizations-daily' AS endpoint_name, 'asset_utilizations_daily' AS table_name, make_timestamp(2024, 2, day, 2, 0, 0) AS load_time, records,
               CAST(5 AS BIGINT) AS columns, table_rows, duplicates, if(duplicates > 0, duplicates || ' duplicate keys in table', NULL) AS warning FROM daily
        UNION ALL
        SELECT 'assets', 'assets', TIMESTAMP '2024-02-01 02:00:00', count(*), 8, count(*), NULL, NULL FROM assets""",
    "s2_csv_utilization": """
        SELECT CAST(asset_id AS VARCHAR) AS asset_id, date, utilization_percentage, CAST(active_run_seconds AS DOUBLE) AS active_hours,
               CASE WHEN asset_id % 2 > 0 THEN 'Pit "' || asset_id || '", north' END AS site_name,
               CASE WHEN asset_id % 3 > 0 THEN 'line 1' || chr(10) || 'line ' || asset_id END AS assignee_name
        FROM asset_utilizations_daily""",
    "n8_normalize_types": """
        SELECT l_orderkey, l_linenumber, base64(encode(l_returnflag)) AS flag_bytes, CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS amount,
               CAST(l_linenumber AS VARCHAR) AS small, '{"n":' || l_linenumber || ',"flag":"' || l_returnflag || '"}' AS nested,
               '[' || l_orderkey || ',' || l_partkey || ']' AS keys, '' AS never, '' AS void,
               CASE WHEN l_linenumber % 2 > 0 THEN CAST(12 AS BIGINT) END AS count_text,
               CASE WHEN l_linenumber % 2 > 0 THEN TIMESTAMP '2025-01-02 03:04:05' END AS at,
               CASE WHEN l_linenumber % 2 > 0 THEN true END AS ok, CAST(NULL AS BIGINT) AS year
        FROM lineitem""",
    "s7_run_log": f"""
        WITH t AS ({_FIRST}), s AS ({_SECOND})
        SELECT 'asset-utilizations-daily' AS endpoint_name, TIMESTAMP '2024-01-20 02:00:00' AS last_run_time, count(*) AS records_processed FROM t
        UNION ALL
        SELECT 'asset-utilizations-daily', TIMESTAMP '2024-01-21 02:00:00', count(*) FROM s WHERE date >= (SELECT max(date) FROM t)""",
    "s8_static_refresh": """
        SELECT table_name, row_count, 'fleet_static_tables' AS pipeline_name, TIMESTAMP '2024-02-02 02:00:00' AS last_run_time, 'success' AS status
        FROM (SELECT 'assets' AS table_name, count(*) AS row_count FROM assets UNION ALL SELECT 'asset_labels', count(*) FROM asset_labels
              UNION ALL SELECT 'asset_registrations', count(*) FROM asset_registrations)""",
    "i4_surrogate_load": f"""
        WITH reading AS (SELECT event_id AS asset_reading_daily_id, user_id AS asset_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date,
                                CAST(floor(value) AS BIGINT) AS cumulative_hours_end_of_day FROM events),
             early AS (SELECT * FROM reading WHERE date < TIMESTAMP '{CUT_TARGET}'),
             late AS (SELECT * REPLACE (date + INTERVAL 1 DAY AS date, cumulative_hours_end_of_day * 2 AS cumulative_hours_end_of_day)
                      FROM reading WHERE date >= TIMESTAMP '{CUT_SOURCE}'),
             taken AS (SELECT * FROM late WHERE date >= (SELECT max(date) FROM early))
        SELECT * FROM taken UNION ALL SELECT * FROM early ANTI JOIN taken USING (asset_reading_daily_id)""",
    "e2_type_drift": f"""
        WITH t AS ({_FIRST}), s AS (SELECT * FROM ({_SECOND}) x WHERE date >= (SELECT max(date) FROM t))
        SELECT asset_id, date, active_run_seconds, utilization_percentage, updated_at, active_run_seconds // 3600 AS level FROM t ANTI JOIN s USING (asset_id, date)
        UNION ALL SELECT asset_id, date, NULL, NULL, NULL, active_run_seconds // 3600 FROM s""",
    "s1_pages_events": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value,
               replace(props, ': ', ':') AS props FROM events""",
    "i4_keep_last_events": """
        SELECT asset_id, date, event_id, event_type, value FROM (
            SELECT user_id AS asset_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, event_id, event_type, value,
                   ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn
            FROM events) WHERE rn = 1""",
    "e2_daily_load": f"""
        WITH t AS ({_FIRST}), s0 AS ({_SECOND}),
             s AS (SELECT * FROM s0 WHERE date >= (SELECT MAX(date) FROM t))
        SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.asset_id = t.asset_id AND s.date = t.date)
        UNION ALL SELECT * FROM s""",
    "t1_stream_load": f"""
        WITH t AS ({_FIRST}), s AS ({_SECOND})
        SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.asset_id = t.asset_id AND s.date = t.date)
        UNION ALL SELECT * FROM s""",
    "t1_late_landing": f"""
        WITH earlier AS ({_FIRST}), later AS ({_SECOND})
        SELECT * FROM later UNION ALL SELECT * FROM earlier ANTI JOIN later USING (asset_id, date)""",
    "i8_upsert_moved_rows": f"""
        WITH base AS (SELECT event_id, user_id AS asset_id, event_type, value,
                             CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date FROM events),
             t AS (SELECT * FROM base WHERE date < TIMESTAMP '{CUT_TARGET}'),
             s AS (SELECT event_id, asset_id, event_type, value + 1 AS value, date + INTERVAL 1 DAY AS date
                   FROM base WHERE date >= TIMESTAMP '2024-01-15 00:00:00')
        SELECT * FROM t WHERE event_id NOT IN (SELECT event_id FROM s)
        UNION ALL SELECT * FROM s""",
    "s2_csv_assets": """
        SELECT asset_id, name, make, model, status, purchase_price, billable,
               CAST(CAST(updated_at AS DATE) AS TIMESTAMP) AS updated_on FROM assets""",
    "e1_static_refresh": "SELECT * FROM assets",
    "i6_exact_row_dedup": """
        SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem""",
    "n14_flatten_events": """
        SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value,
               CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events""",
}

BUILDERS = (s1_pages_events, i4_keep_last_events, e2_daily_load, t1_stream_load, i8_upsert_moved_rows,
            s2_csv_assets, e1_static_refresh, i6_exact_row_dedup, n14_flatten_events, s7_run_log, s8_static_refresh,
            i4_surrogate_load, e2_type_drift, s2_csv_utilization, n8_normalize_types, i3_landing_ledger, i12_load_metrics,
            s3_catalog_site_rollup, t1_late_landing, j2_clustered_facts)
