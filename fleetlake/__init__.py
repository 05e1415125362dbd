"""fleetlake — equipment-fleet analytics as Spark DataFrame / SQL jobs.

Layout:
  sources/    landed JSON pages, CSV, named tables, sinks (overwrite, append, upsert)
  functions/  column-level helpers: lenient casts, T-SQL style date boundaries
  operators/  normalisation, keep-last dedup, upsert, interval join, quality metrics
  plans/      the test-data views, the analytical queries, billing, dashboard, loaders
  streaming/  the incremental load as a file stream (availableNow + foreachBatch)
"""

from fleetlake.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
