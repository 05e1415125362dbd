"""Data-quality queries V1-V5 and I11 over the fleet tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.config import DAILY_ENDPOINTS, declared_schemas
from fleetlake.functions.dates import as_of_col
from fleetlake.operators.quality import schema_relation, table_profile
from fleetlake.plans.views import AS_OF_EVENTS

Tables = Mapping[str, DataFrame]

# key of each daily table: its merge key, or asset and date where it has none
MERGE_KEYS = {c.table: (c.merge_key,) if c.merge_key else ("asset_id", "date") for c in DAILY_ENDPOINTS}


def v1_null_asset_ids(t: Tables) -> DataFrame:
    return t["assets"].agg(F.count_if(F.col("asset_id").isNull()).alias("null_count"))


def v2_duplicate_asset_days(t: Tables) -> DataFrame:
    return (t["asset_utilizations_daily"].groupBy("asset_id", "date")
            .agg(F.count(F.lit(1)).alias("duplicate_count"))
            .where(F.col("duplicate_count") > 1))


def v3_duplicate_metrics(t: Tables) -> DataFrame:
    """I11 per daily table: COUNT(*) - COUNT(DISTINCT merge key), plus the row count."""
    parts = [table_profile(t[name], keys=keys).select(F.lit(name).alias("table_name"), "row_count", "duplicates")
             for name, keys in MERGE_KEYS.items()]
    return reduce(DataFrame.unionAll, parts)


def v4_row_count(t: Tables) -> DataFrame:
    return t["assets"].agg(F.count(F.lit(1)).alias("total_rows"))


def v5_date_ranges(t: Tables, as_of=AS_OF_EVENTS) -> DataFrame:
    """Per daily table in one pass each: date range, NULL/future dates, NULL asset ids."""
    now = as_of_col(as_of)
    parts = [table_profile(t[name], critical=("asset_id",), date_col="date", date_max=now)
             .select(F.lit(name).alias("table_name"), "row_count", "min_date", "max_date", "rows_out_of_range",
                     F.col("null_asset_id").alias("null_asset_ids"))
             for name in MERGE_KEYS]
    return reduce(DataFrame.unionAll, parts)


def v6_schema_check(t: Tables) -> DataFrame:
    """V6: every declared column of the fourteen tables against what is there, and how often it is filled."""
    return schema_relation(t["assets"].sparkSession, t, declared_schemas())


# The same checks over the order lines, which do repeat keys, lack values and lie outside the range
LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_CLOCK = "1996-06-30 00:00:00"


def _lines(t: Tables) -> DataFrame:
    """Order lines where no discount, no tax and a first-of-month ship date count as not known."""
    ship = F.col("l_shipdate").cast("timestamp")
    return t["lineitem"].select(*LINE_KEYS, F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
                                F.when(F.dayofmonth(ship) > 1, ship).alias("l_shipdate"))


def v2_repeated_order_lines(t: Tables) -> DataFrame:
    """Q2, V2: the keys that occur more than once, and how often."""
    return t["lineitem"].groupBy(*LINE_KEYS).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def v3_line_profile(t: Tables) -> DataFrame:
    """Q3, V1, V3, V5, I11 over input that has something to find."""
    clock = F.lit(LINE_CLOCK).cast("timestamp")
    return table_profile(_lines(t), keys=LINE_KEYS, critical=("l_discount", "l_tax"), date_col="l_shipdate", date_max=clock)


E = f"TIMESTAMP '{AS_OF_EVENTS}'"

_KINDS = "map {'VARCHAR': 'string', 'BIGINT': 'bigint', 'INTEGER': 'int', 'DOUBLE': 'double', 'BOOLEAN': 'boolean', 'DATE': 'date', 'TIMESTAMP': 'timestamp'}"


def _v6_sql() -> str:
    """The declared columns as values, the present ones from DuckDB's own types and counts."""
    declared = ", ".join(f"('{table}', '{f.name}', '{f.dataType.simpleString()}')" for table, schema in declared_schemas().items() for f in schema)
    present = "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS table_name, kinds.column_name, kinds.kind, counts.filled
            FROM (UNPIVOT (SELECT typeof(any_value(COLUMNS(*))) FROM {n}) ON COLUMNS(*) INTO NAME column_name VALUE kind) kinds
            JOIN (UNPIVOT (SELECT count(COLUMNS(*)) FROM {n}) ON COLUMNS(*) INTO NAME column_name VALUE filled) counts USING (column_name)""" for n in declared_schemas())
    return f"""
        WITH declared(table_name, column_name, expected_type) AS (VALUES {declared}), present AS ({present})
        SELECT table_name, column_name, expected_type, {_KINDS}[kind] AS actual_type, coalesce(filled, 0) AS filled,
               CASE WHEN kind IS NULL THEN 'missing' WHEN expected_type IS NULL THEN 'undeclared'
                    WHEN expected_type = {_KINDS}[kind] THEN 'ok' ELSE 'differs' END AS status
        FROM declared FULL JOIN present USING (table_name, column_name)"""


ORACLE = {
    "v6_schema_check": _v6_sql(),
    "v2_repeated_order_lines": """
        SELECT l_orderkey, l_linenumber, duplicate_count
        FROM (SELECT l_orderkey, l_linenumber, row_number() OVER key AS nth, count(*) OVER key_all AS duplicate_count FROM lineitem
              WINDOW key AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate), key_all AS (PARTITION BY l_orderkey, l_linenumber))
        WHERE nth = 2""",
    "v3_line_profile": f"""
        SELECT (SELECT count(*) FROM lineitem) AS row_count,
               (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicates,
               (SELECT count(*) FROM lineitem WHERE l_discount = 0) AS "null_l_discount", (SELECT count(*) FROM lineitem WHERE l_tax = 0) AS "null_l_tax",
               (SELECT min(CAST(l_shipdate AS TIMESTAMP)) FROM lineitem WHERE day(l_shipdate) > 1) AS min_date,
               (SELECT max(CAST(l_shipdate AS TIMESTAMP)) FROM lineitem WHERE day(l_shipdate) > 1) AS max_date,
               (SELECT count(*) FROM lineitem WHERE day(l_shipdate) = 1 OR l_shipdate > TIMESTAMP '{LINE_CLOCK}') AS rows_out_of_range""",
    "v1_null_asset_ids": "SELECT CAST(COUNT(*) FILTER (WHERE asset_id IS NULL) AS BIGINT) AS null_count FROM assets",
    "v2_duplicate_asset_days": """
        SELECT asset_id, date, COUNT(*) AS duplicate_count FROM asset_utilizations_daily
        GROUP BY asset_id, date HAVING COUNT(*) > 1""",
    "v3_duplicate_metrics": """
        SELECT 'asset_readings_daily' AS table_name, COUNT(*) AS row_count,
               COUNT(*) - COUNT(DISTINCT asset_reading_daily_id) AS duplicates FROM asset_readings_daily
        UNION ALL
        SELECT 'asset_utilizations_daily', COUNT(*),
               COUNT(*) - COUNT(DISTINCT CASE WHEN asset_id IS NOT NULL AND date IS NOT NULL
                                              THEN (asset_id, date) END) FROM asset_utilizations_daily
        UNION ALL
        SELECT 'asset_site_daily_utilizations', COUNT(*),
               COUNT(*) - COUNT(DISTINCT asset_site_daily_utilization_id) FROM asset_site_daily_utilizations
        UNION ALL
        SELECT 'asset_net_working_hours_daily', COUNT(*),
               COUNT(*) - COUNT(DISTINCT asset_net_working_hour_daily_id) FROM asset_net_working_hours_daily""",
    "v4_row_count": "SELECT COUNT(*) AS total_rows FROM assets",
    "v5_date_ranges": "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS table_name, COUNT(*) AS row_count, MIN(date) AS min_date, MAX(date) AS max_date,
               CAST(COUNT(*) FILTER (WHERE date IS NULL OR date > {E}) AS BIGINT) AS rows_out_of_range,
               CAST(COUNT(*) FILTER (WHERE asset_id IS NULL) AS BIGINT) AS null_asset_ids FROM {n}"""
        for n in MERGE_KEYS),
}
