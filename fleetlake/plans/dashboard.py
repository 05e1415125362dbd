"""Data sets behind the fleet dashboard (K1-K7). Rendering is a BI tool's job; these are its inputs.

The dashboard is a star: ``assets`` is the dimension, the daily utilisation facts join on asset_id.
Filters (K6) are applied to the dimension and pushed into the facts with a semi join, so every card
and chart is computed over the same filtered fleet.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.casts import round_half_up
from fleetlake.functions.dates import as_of_col, days_ago
from fleetlake.operators.aggregates import percent_of_total
from fleetlake.plans.views import AS_OF_EVENTS

Tables = Mapping[str, DataFrame]

DEFAULT_TARGET_UTILIZATION = 75.0  # the dashboard's target line; the figure itself is not published


class FilteredFleet(Mapping):
    """K6: a view of the fleet restricted by asset attributes and a date range.

    ``make`` / ``status`` and any other asset column in ``asset_filters`` ({column: allowed values})
    restrict the assets; every fact keyed by ``asset_id`` is cut to those assets with a semi join (the
    fact stays the preserved, splittable side) and daily facts to the date range."""

    def __init__(self, t: Tables, make=None, status=None, date_from=None, date_to=None,
                 asset_filters: Mapping | None = None):
        self.t = t
        self.date_from, self.date_to = date_from, date_to
        self.asset_filters = {k: list(v) for k, v in (asset_filters or {}).items()}
        if make is not None:
            self.asset_filters["make"] = list(make)
        if status is not None:
            self.asset_filters["status"] = list(status)

    def __getitem__(self, name: str) -> DataFrame:
        if name == "assets":
            a = self.t["assets"]
            for column, allowed in self.asset_filters.items():
                a = a.where(F.col(column).isin(allowed))
            return a
        df = self.t[name]
        if name in ("asset_utilizations_daily", "asset_net_working_hours_daily", "asset_readings_daily",
                    "asset_site_daily_utilizations"):
            if self.date_from is not None:
                df = df.where(F.col("date") >= self.date_from)
            if self.date_to is not None:
                df = df.where(F.col("date") <= self.date_to)
        if self.asset_filters and "asset_id" in df.columns:
            keys = self["assets"].select(F.col("asset_id").alias("_k"))
            df = df.join(keys, df.asset_id == keys._k, "left_semi")
        return df

    def __iter__(self):
        return iter(self.t)

    def __len__(self):
        return len(self.t)


def k1_kpi_cards(t: Tables) -> DataFrame:
    """Fleet utilisation, total hours, asset count, fleet value — one row per card."""
    u = t["asset_utilizations_daily"]
    a = t["assets"]
    # one pass over each table, then a row per card
    def cards(row: DataFrame, *names: str) -> DataFrame:
        return row.select(F.inline(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names))))
    use = u.agg(round_half_up(F.avg("utilization_percentage"), 2).alias("fleet_utilization"),
                round_half_up(F.sum("active_run_seconds") / F.lit(3600.0), 2).alias("total_hours"))
    fleet = a.agg(F.count_distinct("asset_id").cast("double").alias("asset_count"), round_half_up(F.sum("purchase_price"), 2).alias("fleet_value"))
    return cards(use, "fleet_utilization", "total_hours").unionAll(cards(fleet, "asset_count", "fleet_value"))


def k2_utilization_trend(t: Tables, target: float = DEFAULT_TARGET_UTILIZATION) -> DataFrame:
    return (t["asset_utilizations_daily"].groupBy("date")
            .agg(round_half_up(F.avg("utilization_percentage"), 2).alias("avg_utilization"),
                 F.count(F.lit(1)).alias("assets_reporting"))
            .select("date", "avg_utilization", "assets_reporting", F.lit(float(target)).alias("target_utilization"))
            .orderBy("date"))


def k3_make_distribution(t: Tables) -> DataFrame:
    g = t["assets"].groupBy("make").agg(F.count(F.lit(1)).alias("asset_count"))
    return percent_of_total(g, "asset_count", "share_pct").orderBy(F.desc("asset_count"), "make")


def k4_top_assets(t: Tables, k: int = 10) -> DataFrame:
    """Top-k assets by total active hours (aggregate first, then attach names)."""
    per_asset = (t["asset_utilizations_daily"].groupBy(F.col("asset_id").alias("_uid"))
                 .agg((F.sum("active_run_seconds") / F.lit(3600.0)).alias("total_active_hours"),
                      round_half_up(F.avg("utilization_percentage"), 2).alias("avg_utilization"),
                      F.count(F.lit(1)).alias("days_reported")))
    a = t["assets"].select("asset_id", "name", "make")
    return (a.join(per_asset, a.asset_id == per_asset._uid, "inner").drop("_uid")
            .orderBy(F.desc("total_active_hours"), "asset_id").limit(k))


def k5_status_split(t: Tables) -> DataFrame:
    g = t["assets"].groupBy("status").agg(F.count(F.lit(1)).alias("asset_count"))
    return percent_of_total(g, "asset_count", "share_pct").orderBy(F.desc("asset_count"), "status")


def k6_filtered_kpis(t: Tables, as_of=AS_OF_EVENTS, days: int = 14) -> DataFrame:
    """The KPI cards for active assets over the last ``days`` days."""
    f = FilteredFleet(t, status=("Active",), date_from=days_ago(as_of_col(as_of), days))
    return k1_kpi_cards(f)


def k7_star_view(t: Tables) -> DataFrame:
    """The star relationship assets 1-* utilisation as one joined data set."""
    a = t["assets"].select(F.col("asset_id").alias("_aid"), "name", "make", "model", "status")
    u = t["asset_utilizations_daily"].select("asset_id", "date", "utilization_percentage", "active_run_seconds")
    return u.join(a, u.asset_id == a._aid, "inner").drop("_aid")


E = f"TIMESTAMP '{AS_OF_EVENTS}'"

_K1 = """
    SELECT 'fleet_utilization' AS metric, CAST(ROUND(CAST(AVG(utilization_percentage) AS DECIMAL(38,12)), 2) AS DOUBLE) AS value FROM {u}
    UNION ALL SELECT 'total_hours', CAST(ROUND(CAST(SUM(active_run_seconds) / 3600.0 AS DECIMAL(38,12)), 2) AS DOUBLE) FROM {u}
    UNION ALL SELECT 'asset_count', CAST(COUNT(DISTINCT asset_id) AS DOUBLE) FROM {a}
    UNION ALL SELECT 'fleet_value', CAST(ROUND(CAST(SUM(purchase_price) AS DECIMAL(38,12)), 2) AS DOUBLE) FROM {a}"""

ORACLE = {
    "k1_kpi_cards": _K1.format(u="asset_utilizations_daily", a="assets"),
    "k2_utilization_trend": """
        SELECT date, CAST(ROUND(CAST(AVG(utilization_percentage) AS DECIMAL(38,12)), 2) AS DOUBLE) AS avg_utilization, COUNT(*) AS assets_reporting,
               75.0::DOUBLE AS target_utilization
        FROM asset_utilizations_daily GROUP BY date""",
    "k3_make_distribution": """
        SELECT make, COUNT(*) AS asset_count,
               CAST(ROUND(CAST(CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS DECIMAL(38,12)), 2) AS DOUBLE) AS share_pct
        FROM assets GROUP BY make""",
    "k4_top_assets": """
        SELECT a.asset_id, a.name, a.make, SUM(u.active_run_seconds) / 3600.0 AS total_active_hours,
               CAST(ROUND(CAST(AVG(u.utilization_percentage) AS DECIMAL(38,12)), 2) AS DOUBLE) AS avg_utilization, COUNT(*) AS days_reported
        FROM assets a JOIN asset_utilizations_daily u ON a.asset_id = u.asset_id
        GROUP BY a.asset_id, a.name, a.make
        ORDER BY total_active_hours DESC, a.asset_id LIMIT 10""",
    "k5_status_split": """
        SELECT status, COUNT(*) AS asset_count,
               CAST(ROUND(CAST(CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS DECIMAL(38,12)), 2) AS DOUBLE) AS share_pct
        FROM assets GROUP BY status""",
    "k6_filtered_kpis": _K1.format(
        u=f"(SELECT * FROM asset_utilizations_daily WHERE date >= {E} - INTERVAL 14 DAY "
          f"AND asset_id IN (SELECT asset_id FROM assets WHERE status = 'Active'))",
        a="(SELECT * FROM assets WHERE status = 'Active')"),
    "k7_star_view": """
        SELECT u.asset_id, u.date, u.utilization_percentage, u.active_run_seconds, a.name, a.make, a.model, a.status
        FROM asset_utilizations_daily u JOIN assets a ON u.asset_id = a.asset_id""",
}
