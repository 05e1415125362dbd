"""Fleet tables derived from the driver's TPC-H-style test data.

The fleet application reads fourteen landed tables (assets, histories, daily facts, ...). The test data
has none of them, so each is derived here from the given tables with plain DataFrame code: the work of
every query grows with the input. ``ORACLE_VIEWS`` holds the same definitions as DuckDB SQL for the
correctness oracle; the two are written independently and must agree row for row.

Mapping (asset = customer):
  assets                         customer + nation; updated_at = last order date
  asset_financials               assets with a positive balance (balance plays the rental rate)
  asset_warranties               one per order, one year long; expired = order status 'F'
  asset_registrations            urgent orders
  asset_site/organization/assignee_history
                                 consecutive orders of a customer: [order date, next order date), NULL = open
  asset_site_daily_utilizations  lineitem quantity per (customer, ship day) in seconds
  asset_utilizations_daily       events per (user, day): count hours of activity
  asset_readings_daily           same grain, running total of whole values
  asset_net_working_hours_daily  same grain, 'view' minutes are idle, the rest working
  asset_dt_codes                 'error' events
  asset_labels / associations    nation + region / customer nation
  pipeline_last_run              one run per daily endpoint per loaded day (02:00 next day)
  control_last_run               one row: the static refresh after the newest asset update
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.config import DAILY_ENDPOINTS
from fleetlake.functions.dates import day_start

# Fixed clocks of the test data (GETDATE replacement): the day after the data ends.
AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_ORDERS = "2001-11-05 00:00:00"

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

DAILY_TABLES = ("asset_readings_daily", "asset_utilizations_daily", "asset_site_daily_utilizations",
                "asset_net_working_hours_daily")
STATIC_TABLES = ("asset_financials", "assets", "asset_assignee_history", "asset_label_associations",
                 "asset_dt_codes", "asset_labels", "asset_organization_history", "asset_registrations",
                 "asset_site_history", "asset_warranties")


def _ts(c: str):
    return F.col(c).cast("timestamp")


def _day_number(ts_col):
    """Days since 1990-01-01, used to build surrogate ids of (asset, day) rows."""
    return F.datediff(F.to_date(ts_col), F.lit("1990-01-01").cast("date")).cast("bigint")


class TestDataFleet(Mapping):
    """Lazy mapping table-name -> DataFrame over one ``sf`` directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._names = BASE_TABLES + STATIC_TABLES + DAILY_TABLES + ("pipeline_last_run", "control_last_run")

    # Mapping protocol -------------------------------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return getattr(self, name)

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # given tables -----------------------------------------------------------------------------
    def __getattr__(self, name):
        if name in BASE_TABLES:
            return self._read(name)
        raise AttributeError(name)

    # dimensions -------------------------------------------------------------------------------
    @property
    def assets(self) -> DataFrame:
        c = self._read("customer")
        n = self._read("nation").select("n_nationkey", "n_name")
        last_order = (self._read("orders").groupBy("o_custkey")
                      .agg(F.max("o_orderdate").alias("_last_order")))
        status = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Maintenance")
                  .when(F.col("c_mktsegment") == "FURNITURE", "Inactive")
                  .otherwise("Active"))
        return (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
                .join(last_order, c.c_custkey == last_order.o_custkey, "left")
                .select(F.col("c_custkey").alias("asset_id"),
                        F.col("c_name").alias("name"),
                        F.col("n_name").alias("make"),
                        F.col("c_mktsegment").alias("model"),
                        status.alias("status"),
                        F.col("c_acctbal").alias("purchase_price"),
                        (F.col("c_acctbal") > 0).alias("billable"),
                        _ts("_last_order").alias("updated_at")))

    @property
    def asset_financials(self) -> DataFrame:
        return (self.assets.where(F.col("purchase_price") > 0)
                .select("asset_id", "purchase_price",
                        F.col("purchase_price").alias("internal_rental_rate"),
                        (F.col("updated_at") + F.expr("INTERVAL 12 HOURS")).alias("updated_at")))

    @property
    def asset_warranties(self) -> DataFrame:
        o = self._read("orders")
        start = _ts("o_orderdate")
        return o.select(F.col("o_orderkey").alias("asset_warranty_id"),
                        F.col("o_custkey").alias("asset_id"),
                        start.alias("start_date"),
                        (start + F.expr("INTERVAL 365 DAYS")).alias("end_value_date"),
                        (F.col("o_orderstatus") == "F").alias("expired"),
                        (start + F.expr("INTERVAL 6 HOURS")).alias("updated_at"))

    @property
    def asset_registrations(self) -> DataFrame:
        o = self._read("orders").where(F.col("o_orderpriority") == "1-URGENT")
        start = _ts("o_orderdate")
        return o.select(F.col("o_orderkey").alias("asset_registration_id"),
                        F.col("o_custkey").alias("asset_id"),
                        (start + F.expr("INTERVAL 365 DAYS")).alias("expiration_date"),
                        start.alias("updated_at"))

    def _history(self) -> DataFrame:
        """Consecutive orders of one customer form the history intervals; the newest stays open.

        ``next = LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)``,
        computed without a window over all orders of a customer (one customer may hold a third of all
        orders, which would put them into one task). In that order the next row of an order that is
        not the last of its (customer, date) is on the same date; the last one's next row is the
        first order of the customer's next date. So the window only runs over distinct
        (customer, date) pairs — at most one row per customer-day, bounded by the calendar — built
        by a partial (map-side) aggregate, and the orders join back to it on (customer, date).
        """
        o = self._read("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                        "o_orderpriority")
        days = o.groupBy("o_custkey", "o_orderdate").agg(F.max("o_orderkey").alias("_last_key"))
        w = Window.partitionBy("o_custkey").orderBy("o_orderdate")
        days = days.select(F.col("o_custkey").alias("_ck"), F.col("o_orderdate").alias("_od"), "_last_key",
                           F.lead("o_orderdate").over(w).alias("_next_day"))
        # null-safe keys: an order without customer or date still gets its row, as under LEAD
        j = o.join(days, o.o_custkey.eqNullSafe(days._ck) & o.o_orderdate.eqNullSafe(days._od), "inner")
        nxt = F.when(F.col("o_orderkey") == F.col("_last_key"), F.col("_next_day")).otherwise(F.col("o_orderdate"))
        return j.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority",
                        nxt.alias("_next"))

    @property
    def asset_site_history(self) -> DataFrame:
        h = self._history()
        return h.select(F.col("o_orderkey").alias("asset_site_history_id"),
                        F.col("o_custkey").alias("asset_id"),
                        F.col("o_orderpriority").alias("site_name"),
                        _ts("o_orderdate").alias("enter_date"),
                        _ts("_next").alias("exit_date"),
                        F.col("_next").isNull().alias("currently_applied"),
                        _ts("o_orderdate").alias("updated_at"))

    @property
    def asset_organization_history(self) -> DataFrame:
        h = self._history()
        return h.select(F.col("o_orderkey").alias("asset_organization_history_id"),
                        F.col("o_custkey").alias("asset_id"),
                        F.concat(F.lit("DEPT-"), F.col("o_orderstatus")).alias("organization_department"),
                        _ts("o_orderdate").alias("from_date"),
                        _ts("_next").alias("to_date"),
                        F.col("_next").isNull().alias("currently_applied"),
                        _ts("o_orderdate").alias("updated_at"))

    @property
    def asset_assignee_history(self) -> DataFrame:
        h = self._history()
        return h.select(F.col("o_orderkey").alias("asset_assignee_history_id"),
                        F.col("o_custkey").alias("asset_id"),
                        F.concat(F.lit("Operator "), F.col("o_orderpriority")).alias("assignee_name"),
                        _ts("o_orderdate").alias("assignment_start"),
                        _ts("_next").alias("assignment_end"),
                        F.col("_next").isNull().alias("currently_assigned"),
                        _ts("o_orderdate").alias("updated_at"))

    @property
    def asset_labels(self) -> DataFrame:
        n = self._read("nation")
        r = self._read("region")
        return (n.join(r, n.n_regionkey == r.r_regionkey, "inner")
                .select(F.col("n_nationkey").cast("bigint").alias("asset_label_id"),
                        F.col("n_name").alias("label_name"),
                        F.col("r_name").alias("label_color"),
                        (F.col("n_nationkey") % 5 == 0).alias("deactivated")))

    @property
    def asset_label_associations(self) -> DataFrame:
        c = self._read("customer")
        return c.select(F.col("c_custkey").alias("asset_id"),
                        F.col("c_nationkey").cast("bigint").alias("asset_label_id"),
                        (F.col("c_custkey") % 4 != 0).alias("currently_applied"))

    @property
    def asset_dt_codes(self) -> DataFrame:
        e = self._read("events").where(F.col("event_type") == "error")
        return e.select(F.col("event_id").alias("asset_dt_code_id"),
                        F.col("user_id").alias("asset_id"),
                        _ts("ts").alias("timestamp"),
                        (F.col("event_id") % 3 == 0).alias("is_acknowledged"),
                        _ts("ts").alias("updated_at"))

    # daily facts --------------------------------------------------------------------------------
    def _events_daily(self) -> DataFrame:
        e = self._read("events")
        minutes = F.floor("value")
        return (e.groupBy(F.col("user_id").alias("asset_id"), day_start("ts").alias("date"))
                .agg(F.count(F.lit(1)).alias("_n"),
                     F.sum(minutes).alias("_units"),
                     F.sum(F.when(F.col("event_type") == "view", minutes).otherwise(0)).alias("_idle_min"),
                     F.sum(F.when(F.col("event_type") != "view", minutes).otherwise(0)).alias("_work_min"),
                     F.min(_ts("ts")).alias("_first"),
                     F.max(_ts("ts")).alias("_last")))

    @property
    def asset_utilizations_daily(self) -> DataFrame:
        d = self._events_daily()
        return d.select("asset_id", "date",
                        (F.col("_n") * 3600).cast("bigint").alias("active_run_seconds"),
                        (F.col("_n").cast("double") * 100.0 / 24.0).alias("utilization_percentage"),
                        F.col("_first").alias("created_at"),
                        F.col("_last").alias("updated_at"))

    @property
    def asset_readings_daily(self) -> DataFrame:
        d = self._events_daily()
        # per-asset running total over day rows: the window holds one row per asset-day
        w = Window.partitionBy("asset_id").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
        return d.select((F.col("asset_id") * 100000 + _day_number("date")).alias("asset_reading_daily_id"),
                        "asset_id", "date",
                        F.sum("_units").over(w).cast("bigint").alias("cumulative_hours_end_of_day"))

    @property
    def asset_net_working_hours_daily(self) -> DataFrame:
        d = self._events_daily()
        idle = (F.col("_idle_min") * 60).cast("bigint")
        work = (F.col("_work_min") * 60).cast("bigint")
        total = idle + work
        return d.select((F.col("asset_id") * 100000 + _day_number("date")).alias("asset_net_working_hour_daily_id"),
                        "asset_id", "date",
                        total.alias("total_duration_seconds"),
                        idle.alias("total_idle_duration_seconds"),
                        work.alias("working_seconds"),
                        F.when(total > 0, work.cast("double") * 100.0 / total.cast("double"))
                        .otherwise(F.lit(0.0)).alias("working_percentage"))

    @property
    def asset_site_daily_utilizations(self) -> DataFrame:
        li = self._read("lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
        o = self._read("orders").select("o_orderkey", "o_custkey")
        j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        g = (j.groupBy(F.col("o_custkey").alias("asset_id"), day_start("l_shipdate").alias("date"))
             .agg(F.sum("l_quantity").alias("_qty")))
        return g.select((F.col("asset_id") * 100000 + _day_number("date")).alias("asset_site_daily_utilization_id"),
                        "asset_id", "date",
                        (F.col("_qty") * 3600).cast("bigint").alias("active_run_seconds"))

    # tracking -----------------------------------------------------------------------------------
    @property
    def pipeline_last_run(self) -> DataFrame:
        parts = []
        for cfg in DAILY_ENDPOINTS:
            endpoint, table = cfg.endpoint, cfg.table
            t = self[table]
            parts.append(t.groupBy("date").agg(F.count(F.lit(1)).alias("records_processed"))
                         .select(F.lit(endpoint).alias("endpoint_name"),
                                 (F.col("date") + F.expr("INTERVAL 26 HOURS")).alias("last_run_time"),
                                 F.col("records_processed").cast("bigint").alias("records_processed")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    @property
    def control_last_run(self) -> DataFrame:
        return (self.assets.agg(F.max("updated_at").alias("_m"))
                .select(F.lit("fleet_static_tables").alias("pipeline_name"),
                        (F.col("_m") + F.expr("INTERVAL 26 HOURS")).alias("last_run_time"),
                        F.lit("success").alias("status")))


# ---------------------------------------------------------------------------------------------
# The same views in DuckDB SQL (oracle side). Order matters: later views may use earlier ones.
# ---------------------------------------------------------------------------------------------
ORACLE_VIEWS: dict[str, str] = {
    "assets": """
        SELECT c.c_custkey AS asset_id, c.c_name AS name, n.n_name AS make, c.c_mktsegment AS model,
               CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Maintenance'
                    WHEN c.c_mktsegment = 'FURNITURE' THEN 'Inactive' ELSE 'Active' END AS status,
               c.c_acctbal AS purchase_price, c.c_acctbal > 0 AS billable,
               CAST(lo.last_order AS TIMESTAMP) AS updated_at
        FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN (SELECT o_custkey, MAX(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) lo
               ON lo.o_custkey = c.c_custkey""",
    "asset_financials": """
        SELECT asset_id, purchase_price, purchase_price AS internal_rental_rate,
               updated_at + INTERVAL 12 HOUR AS updated_at
        FROM assets WHERE purchase_price > 0""",
    "asset_warranties": """
        SELECT o_orderkey AS asset_warranty_id, o_custkey AS asset_id, CAST(o_orderdate AS TIMESTAMP) AS start_date,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL 365 DAY AS end_value_date,
               o_orderstatus = 'F' AS expired, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 6 HOUR AS updated_at
        FROM orders""",
    "asset_registrations": """
        SELECT o_orderkey AS asset_registration_id, o_custkey AS asset_id,
               CAST(o_orderdate AS TIMESTAMP) + INTERVAL 365 DAY AS expiration_date,
               CAST(o_orderdate AS TIMESTAMP) AS updated_at
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "_history": """
        SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority,
               LEAD(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_date
        FROM orders""",
    "asset_site_history": """
        SELECT o_orderkey AS asset_site_history_id, o_custkey AS asset_id, o_orderpriority AS site_name,
               CAST(o_orderdate AS TIMESTAMP) AS enter_date, CAST(next_date AS TIMESTAMP) AS exit_date,
               next_date IS NULL AS currently_applied, CAST(o_orderdate AS TIMESTAMP) AS updated_at
        FROM _history""",
    "asset_organization_history": """
        SELECT o_orderkey AS asset_organization_history_id, o_custkey AS asset_id,
               'DEPT-' || o_orderstatus AS organization_department,
               CAST(o_orderdate AS TIMESTAMP) AS from_date, CAST(next_date AS TIMESTAMP) AS to_date,
               next_date IS NULL AS currently_applied, CAST(o_orderdate AS TIMESTAMP) AS updated_at
        FROM _history""",
    "asset_assignee_history": """
        SELECT o_orderkey AS asset_assignee_history_id, o_custkey AS asset_id,
               'Operator ' || o_orderpriority AS assignee_name,
               CAST(o_orderdate AS TIMESTAMP) AS assignment_start, CAST(next_date AS TIMESTAMP) AS assignment_end,
               next_date IS NULL AS currently_assigned, CAST(o_orderdate AS TIMESTAMP) AS updated_at
        FROM _history""",
    "asset_labels": """
        SELECT CAST(n.n_nationkey AS BIGINT) AS asset_label_id, n.n_name AS label_name, r.r_name AS label_color,
               n.n_nationkey % 5 = 0 AS deactivated
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "asset_label_associations": """
        SELECT c_custkey AS asset_id, CAST(c_nationkey AS BIGINT) AS asset_label_id,
               c_custkey % 4 <> 0 AS currently_applied
        FROM customer""",
    "asset_dt_codes": """
        SELECT event_id AS asset_dt_code_id, user_id AS asset_id, CAST(ts AS TIMESTAMP) AS "timestamp",
               event_id % 3 = 0 AS is_acknowledged, CAST(ts AS TIMESTAMP) AS updated_at
        FROM events WHERE event_type = 'error'""",
    "_events_daily": """
        SELECT user_id AS asset_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date,
               COUNT(*) AS n,
               CAST(SUM(FLOOR(value)) AS BIGINT) AS units,
               CAST(SUM(CASE WHEN event_type = 'view' THEN FLOOR(value) ELSE 0 END) AS BIGINT) AS idle_min,
               CAST(SUM(CASE WHEN event_type <> 'view' THEN FLOOR(value) ELSE 0 END) AS BIGINT) AS work_min,
               MIN(CAST(ts AS TIMESTAMP)) AS first_ts, MAX(CAST(ts AS TIMESTAMP)) AS last_ts
        FROM events GROUP BY user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP)""",
    "asset_utilizations_daily": """
        SELECT asset_id, date, CAST(n * 3600 AS BIGINT) AS active_run_seconds,
               CAST(n AS DOUBLE) * 100.0 / 24.0 AS utilization_percentage,
               first_ts AS created_at, last_ts AS updated_at
        FROM _events_daily""",
    "asset_readings_daily": """
        SELECT asset_id * 100000 + date_diff('day', DATE '1990-01-01', CAST(date AS DATE)) AS asset_reading_daily_id,
               asset_id, date,
               CAST(SUM(units) OVER (PARTITION BY asset_id ORDER BY date
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
                   AS cumulative_hours_end_of_day
        FROM _events_daily""",
    "asset_net_working_hours_daily": """
        SELECT asset_id * 100000 + date_diff('day', DATE '1990-01-01', CAST(date AS DATE))
                   AS asset_net_working_hour_daily_id,
               asset_id, date,
               idle_min * 60 + work_min * 60 AS total_duration_seconds,
               idle_min * 60 AS total_idle_duration_seconds,
               work_min * 60 AS working_seconds,
               CASE WHEN idle_min * 60 + work_min * 60 > 0
                    THEN CAST(work_min * 60 AS DOUBLE) * 100.0 / CAST(idle_min * 60 + work_min * 60 AS DOUBLE)
                    ELSE 0.0 END AS working_percentage
        FROM _events_daily""",
    "asset_site_daily_utilizations": """
        SELECT o.o_custkey * 100000 + date_diff('day', DATE '1990-01-01', CAST(l.l_shipdate AS DATE))
                   AS asset_site_daily_utilization_id,
               o.o_custkey AS asset_id, CAST(CAST(l.l_shipdate AS DATE) AS TIMESTAMP) AS date,
               CAST(SUM(l.l_quantity) * 3600 AS BIGINT) AS active_run_seconds
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        GROUP BY o.o_custkey, CAST(l.l_shipdate AS DATE)""",
    "pipeline_last_run": """
        SELECT 'asset-readings-daily' AS endpoint_name, date + INTERVAL 26 HOUR AS last_run_time,
               CAST(COUNT(*) AS BIGINT) AS records_processed FROM asset_readings_daily GROUP BY date
        UNION ALL
        SELECT 'asset-utilizations-daily', date + INTERVAL 26 HOUR, CAST(COUNT(*) AS BIGINT)
        FROM asset_utilizations_daily GROUP BY date
        UNION ALL
        SELECT 'asset-site-daily-utilizations', date + INTERVAL 26 HOUR, CAST(COUNT(*) AS BIGINT)
        FROM asset_site_daily_utilizations GROUP BY date
        UNION ALL
        SELECT 'asset-net-working-hours-daily', date + INTERVAL 26 HOUR, CAST(COUNT(*) AS BIGINT)
        FROM asset_net_working_hours_daily GROUP BY date""",
    "control_last_run": """
        SELECT 'fleet_static_tables' AS pipeline_name, MAX(updated_at) + INTERVAL 26 HOUR AS last_run_time,
               'success' AS status
        FROM assets""",
}


def oracle_with(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the views it needs (transitively), in dependency order."""
    import re

    names = list(ORACLE_VIEWS)
    needed: set[str] = set()
    frontier = [sql]
    while frontier:
        text = frontier.pop()
        for n in names:
            if n not in needed and re.search(rf"\b{re.escape(n)}\b", text):
                needed.add(n)
                frontier.append(ORACLE_VIEWS[n])
    ctes = [f"{n} AS ({ORACLE_VIEWS[n]})" for n in names if n in needed]
    if not ctes:
        return sql
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        # the statement has CTEs of its own: append them after the view CTEs
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + sql
