"""Name -> query builder registry used by ``__spark_entry__`` and ``bench.py``.

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the test-data fleet views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlake.plans import queries as Q
from fleetlake.plans.views import TestDataFleet

Builder = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Builder] = {}


def _on_fleet(fn) -> Builder:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(TestDataFleet(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def register(name: str, builder: Builder) -> None:
    _REGISTRY[name] = builder


for _name in ("q1_row_counts", "q2_duplicate_assets", "q3_null_profile", "q4_freshness", "q5_recent_updates",
              "q6_status_share", "q7_active_dt_codes", "q8_expired_warranties", "q9_label_usage",
              "q10_working_vs_idle", "q11_org_change_rate", "q12_coverage", "q13_current_assignments",
              "q14_site_rollup", "q15_label_performance", "q16_daily_consistency", "q17_pipeline_history",
              "q18_missing_from_tracking", "q19_run_log", "q20_missing_data_check"):
    register(_name, _on_fleet(getattr(Q, _name)))


def all_queries() -> dict[str, Builder]:
    # late imports register the remaining families (billing, dashboard, quality, ingest, operators)
    from fleetlake.plans import extra_queries  # noqa: F401
    return dict(_REGISTRY)
