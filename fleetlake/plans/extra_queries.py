"""Registers the query families beyond Q1-Q20: billing, dashboard, quality, operator checks, ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.operators.intervals import interval_left_join
from fleetlake.plans import billing as B
from fleetlake.plans import dashboard as K
from fleetlake.plans import quality_checks as V
from fleetlake.plans.oracle import QUERY_SQL
from fleetlake.plans.registry import _on_fleet, register


def j5_interval_join_pairs(t):
    """The bucketed interval join alone: every (visit, daily row) pair with the day inside the visit."""
    sh = t["asset_site_history"].select("asset_site_history_id", "asset_id", "enter_date", "exit_date")
    sdu = t["asset_site_daily_utilizations"].select("asset_id", "date", "asset_site_daily_utilization_id")
    j = interval_left_join(sh, sdu, key="asset_id", start="enter_date", end="exit_date", point="date")
    return (j.where(F.col("_p_asset_site_daily_utilization_id").isNotNull())
            .select("asset_site_history_id", "asset_id",
                    F.col("_p_asset_site_daily_utilization_id").alias("asset_site_daily_utilization_id"),
                    F.col("_p_date").alias("date")))


_J5_SQL = """
    SELECT sh.asset_site_history_id, sh.asset_id, sdu.asset_site_daily_utilization_id, sdu.date
    FROM asset_site_history sh
    JOIN asset_site_daily_utilizations sdu ON sh.asset_id = sdu.asset_id
         AND sdu.date >= sh.enter_date AND (sh.exit_date IS NULL OR sdu.date <= sh.exit_date)"""

for _fn in (B.b1_expanded_billing, B.b3_monthly_charges,
            K.k1_kpi_cards, K.k2_utilization_trend, K.k3_make_distribution, K.k4_top_assets,
            K.k5_status_split, K.k6_filtered_kpis, K.k7_star_view,
            V.v1_null_asset_ids, V.v2_duplicate_asset_days, V.v3_duplicate_metrics, V.v4_row_count,
            V.v5_date_ranges, V.v6_schema_check, V.v2_repeated_order_lines, V.v3_line_profile, j5_interval_join_pairs):
    register(_fn.__name__, _on_fleet(_fn))

QUERY_SQL.update(B.ORACLE)
QUERY_SQL.update(K.ORACLE)
QUERY_SQL.update(V.ORACLE)
QUERY_SQL["j5_interval_join_pairs"] = _J5_SQL

from fleetlake.plans import ingest_queries as I  # noqa: E402

for _fn in I.BUILDERS:
    register(_fn.__name__, _fn)
QUERY_SQL.update(I.ORACLE)
