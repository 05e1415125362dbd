"""The fleet validation and analysis queries (Q1-Q20) as DataFrame plans.

Every function takes a mapping table-name -> DataFrame (``TestDataFleet``, or catalog tables via
``fleetlake.sources.tables.CatalogTables``) and a query clock ``as_of`` (the GETDATE of the SQL; ``None``
means now). Nothing is collected: each returns a lazy DataFrame.

Rewrites applied by hand (Catalyst does not do them):
  * many-side facts are pre-aggregated per asset before joining (Q12, Q13, Q15, Q18), so star joins
    never fan out to |facts|^k rows per asset;
  * Q15's averages over the fanned-out join are computed exactly from per-asset sums and row counts;
  * Q14's interval join is bucketed by (asset, month) (see operators/intervals.py).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.config import DAILY_ENDPOINTS
from fleetlake.functions.casts import round_half_up
from fleetlake.functions.dates import as_of_col, days_ago, days_between, hours_between, months_between_boundaries
from fleetlake.operators.aggregates import percent_of_total
from fleetlake.operators.intervals import interval_left_join
from fleetlake.plans.views import AS_OF_EVENTS, AS_OF_ORDERS, DAILY_TABLES

Tables = Mapping[str, DataFrame]

ROW_COUNT_TABLES = ("assets", "asset_financials", "asset_assignee_history", "asset_label_associations",
                    "asset_dt_codes", "asset_labels", "asset_organization_history", "asset_registrations",
                    "asset_site_history", "asset_warranties") + DAILY_TABLES


def q1_row_counts(t: Tables) -> DataFrame:
    """Row counts of all fourteen tables, largest first."""
    parts = [t[name].select(F.lit(1).alias("_one")).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name in ROW_COUNT_TABLES]
    return reduce(DataFrame.unionAll, parts).orderBy(F.desc("row_count"), "table_name")


def q2_duplicate_assets(t: Tables, keys=("asset_id",), table: str = "assets") -> DataFrame:
    """Keys that occur more than once."""
    return (t[table].groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
            .where(F.col("duplicate_count") > 1))


def q3_null_profile(t: Tables) -> DataFrame:
    a = t["assets"]
    return a.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count_if(F.col("asset_id").isNull()).alias("null_ids"),
                 F.count_if(F.col("name").isNull()).alias("null_names"),
                 F.count_if(F.col("status").isNull()).alias("null_status"))


def q4_freshness(t: Tables, as_of=AS_OF_ORDERS) -> DataFrame:
    now = as_of_col(as_of)
    parts = [t[name].agg(F.max("updated_at").alias("most_recent_update"))
             .select(F.lit(name).alias("table_name"), "most_recent_update",
                     hours_between(F.col("most_recent_update"), now).alias("hours_old"))
             for name in ("assets", "asset_financials", "asset_warranties")]
    return reduce(DataFrame.unionAll, parts).orderBy("hours_old", "table_name")


def q5_recent_updates(t: Tables, k: int = 10) -> DataFrame:
    """Top-k most recently updated assets (asset_id breaks ties so the cut is deterministic)."""
    return (t["assets"].select("asset_id", "name", "make", "model", "status", "updated_at")
            .orderBy(F.desc_nulls_last("updated_at"), F.asc("asset_id")).limit(k))


def q6_status_share(t: Tables) -> DataFrame:
    g = t["assets"].groupBy("status").agg(F.count(F.lit(1)).alias("asset_count"))
    return percent_of_total(g, "asset_count", "percentage").orderBy(F.desc("asset_count"), "status")


def q7_active_dt_codes(t: Tables) -> DataFrame:
    return (t["asset_dt_codes"].where(~F.col("is_acknowledged"))
            .groupBy("asset_id")
            .agg(F.count(F.lit(1)).alias("active_dt_codes"),
                 F.min("timestamp").alias("earliest_code"),
                 F.max("timestamp").alias("latest_code"))
            .orderBy(F.desc("active_dt_codes"), "asset_id"))


def q8_expired_warranties(t: Tables) -> DataFrame:
    return (t["asset_warranties"].where(F.col("expired"))
            .groupBy("asset_id")
            .agg(F.count(F.lit(1)).alias("warranty_count"),
                 F.max("end_value_date").alias("latest_expiration"))
            .where(F.col("warranty_count") > 0)
            .orderBy(F.desc("latest_expiration"), "asset_id"))


def q9_label_usage(t: Tables) -> DataFrame:
    """Assets per label: ``labels LEFT JOIN associations (currently applied)``, grouped by label.

    Written as SQL, the association rows are the non-preserved side of the outer join: they cannot
    be broadcast, and AQE only splits skew on the preserved side, so a label holding a third of all
    associations would be joined in one task. Instead the associations inner-join the labels (the
    label side can be broadcast; a skewed association side can be split), distinct assets are
    counted per label group with a partial aggregate, and the label groups join that small result
    null-safely — a label without associations still gets 0.
    """
    al = t["asset_labels"]
    ala = (t["asset_label_associations"].where(F.col("currently_applied"))
           .select(F.col("asset_label_id").alias("_lid"), "asset_id"))
    group = ["label_name", "label_color", "deactivated"]
    counted = (ala.join(al.select("asset_label_id", *group), ala._lid == al.asset_label_id, "inner")
               .groupBy(*[F.col(c).alias("_" + c) for c in group])
               .agg(F.count_distinct("asset_id").alias("_n")))
    labels = al.select(*group).distinct()
    cond = [labels[c].eqNullSafe(counted["_" + c]) for c in group]
    return (labels.join(counted, cond, "left")
            .select("label_name", "label_color", F.coalesce(F.col("_n"), F.lit(0)).alias("assets_with_label"),
                    "deactivated")
            .orderBy(F.desc("assets_with_label"), "label_name"))


def q10_working_vs_idle(t: Tables, as_of=AS_OF_EVENTS, days: int = 30) -> DataFrame:
    """Working vs idle hours per asset over the last ``days``.

    AVG(seconds / 3600.0) is computed as AVG(seconds) / 3600.0: the seconds are whole numbers, so the
    sums are exact and the result does not depend on how rows are split into partitions (a double sum
    does, in its last bits, which can flip a ROUND at a .xx5 tie).
    """
    now = as_of_col(as_of)
    n = t["asset_net_working_hours_daily"]
    total = F.col("total_duration_seconds")
    h = n.where(F.col("date") >= days_ago(now, days)).select(
        "asset_id", "working_seconds", "total_idle_duration_seconds",
        F.when(total > 0, F.col("working_seconds") * F.lit(100.0) / total).otherwise(F.lit(0.0))
        .alias("efficiency_percentage"))
    hours = lambda c: F.col(c) / F.lit(3600.0)
    g = (h.groupBy("asset_id")
         .agg(F.count(F.lit(1)).alias("days_tracked"),
              F.avg("working_seconds").alias("_avg_work_s"),
              F.avg("total_idle_duration_seconds").alias("_avg_idle_s"),
              F.avg("efficiency_percentage").alias("_avg_eff"),
              F.sum("working_seconds").alias("_sum_work_s")))
    return (g.select("asset_id", "days_tracked",
                     round_half_up(hours("_avg_work_s"), 2).alias("avg_working_hours"),
                     round_half_up(hours("_avg_idle_s"), 2).alias("avg_idle_hours"),
                     round_half_up("_avg_eff", 2).alias("avg_efficiency_pct"),
                     round_half_up(hours("_sum_work_s"), 2).alias("total_working_hours"))
            .orderBy(F.desc("avg_efficiency_pct"), "asset_id"))


def q11_org_change_rate(t: Tables, min_changes: int = 3) -> DataFrame:
    g = (t["asset_organization_history"].groupBy("asset_id")
         .agg(F.count(F.lit(1)).alias("org_changes"),
              F.min("from_date").alias("first_org_change"),
              F.max("to_date").alias("last_org_change"))
         .where(F.col("org_changes") > min_changes))
    months = months_between_boundaries(F.col("first_org_change"), F.col("last_org_change"))
    return (g.select("asset_id", "org_changes", "first_org_change", "last_org_change",
                     months.alias("months_tracked"),
                     F.when(months > 0, F.col("org_changes").cast("double") / months.cast("double"))
                     .otherwise(F.lit(0.0)).alias("changes_per_month"))
            .orderBy(F.desc("changes_per_month"), "asset_id"))


def q12_coverage(t: Tables) -> DataFrame:
    """Financial / registration / warranty coverage per asset.

    Each many-side is reduced to one row per asset first (existence flag, distinct warranty count),
    so the three left joins are one-to-one instead of registrations x warranties per asset.
    """
    a = t["assets"].select("asset_id", "name", "make", "model")
    fin = t["asset_financials"].select(F.col("asset_id").alias("_fid")).distinct()
    reg = t["asset_registrations"].select(F.col("asset_id").alias("_rid")).distinct()
    war = (t["asset_warranties"].where(~F.col("expired"))
           .groupBy(F.col("asset_id").alias("_wid"))
           .agg(F.count_distinct("asset_warranty_id").alias("warranty_count")))
    yes_no = lambda c: F.when(F.col(c).isNotNull(), "Yes").otherwise("No")
    j = (a.join(fin, a.asset_id == fin._fid, "left")
         .join(reg, a.asset_id == reg._rid, "left")
         .join(war, a.asset_id == war._wid, "left"))
    out = j.select("asset_id", "name", "make", "model",
                   yes_no("_fid").alias("has_financials"),
                   yes_no("_rid").alias("has_registration"),
                   yes_no("_wid").alias("has_warranty"),
                   F.coalesce(F.col("warranty_count"), F.lit(0)).alias("warranty_count"))
    # GROUP BY asset_id, name, make, model, flags: one group per distinct asset row
    return (out.groupBy("asset_id", "name", "make", "model", "has_financials", "has_registration", "has_warranty")
            .agg(F.max("warranty_count").alias("warranty_count"))
            .orderBy("name", "asset_id"))


def q13_current_assignments(t: Tables, as_of=AS_OF_EVENTS, k: int = 50, days: int = 30) -> DataFrame:
    """Top-k current assignments by open trouble codes, then lowest utilisation.

    Utilisation and trouble codes are aggregated per asset before the join: the fan-out u x dt of the
    SQL form repeats each row equally, so AVG / MAX / COUNT DISTINCT are unchanged.
    """
    now = as_of_col(as_of)
    a = t["assets"].select("asset_id", "name")
    ah = (t["asset_assignee_history"].where(F.col("currently_assigned"))
          .select(F.col("asset_id").alias("_aid"), "assignee_name", "assignment_start"))
    u = (t["asset_utilizations_daily"].where(F.col("date") >= days_ago(now, days))
         .groupBy(F.col("asset_id").alias("_uid"))
         .agg(F.avg("utilization_percentage").alias("avg_utilization_30days"),
              F.max("date").alias("last_utilization_date")))
    dt = (t["asset_dt_codes"].where(~F.col("is_acknowledged"))
          .groupBy(F.col("asset_id").alias("_did"))
          .agg(F.count_distinct("asset_dt_code_id").alias("active_trouble_codes")))
    j = (a.join(ah, a.asset_id == ah._aid, "inner")
         .join(u, a.asset_id == u._uid, "left")
         .join(dt, a.asset_id == dt._did, "left"))
    g = (j.groupBy("asset_id", "name", "assignee_name", "assignment_start")
         .agg(F.first("avg_utilization_30days").alias("avg_utilization_30days"),
              F.coalesce(F.first("active_trouble_codes"), F.lit(0)).alias("active_trouble_codes"),
              F.first("last_utilization_date").alias("last_utilization_date")))
    return (g.select("asset_id", "name", "assignee_name", "assignment_start", "avg_utilization_30days",
                     F.col("active_trouble_codes").cast("bigint").alias("active_trouble_codes"),
                     "last_utilization_date")
            .orderBy(F.desc("active_trouble_codes"), F.asc_nulls_first("avg_utilization_30days"),
                     "asset_id", "assignment_start", "assignee_name")
            .limit(k))


def q14_site_rollup(t: Tables, as_of=AS_OF_ORDERS) -> DataFrame:
    """Site visits with the daily site utilisation that falls inside each visit (flagship)."""
    now = as_of_col(as_of)
    sh = t["asset_site_history"].select("site_name", "asset_id", "enter_date", "exit_date")
    a = t["assets"].select(F.col("asset_id").alias("_aid"), F.col("name").alias("asset_name"))
    visits = sh.join(a, sh.asset_id == a._aid, "inner").drop("_aid")
    sdu = t["asset_site_daily_utilizations"].select("asset_id", "date", "active_run_seconds")
    j = interval_left_join(visits, sdu, key="asset_id", start="enter_date", end="exit_date", point="date")
    g = (j.groupBy("site_name", "asset_id", "asset_name", "enter_date", "exit_date")
         .agg(F.avg("_p_active_run_seconds").alias("_avg_s"), F.sum("_p_active_run_seconds").alias("_sum_s")))
    return (g.select("site_name", "asset_id", "asset_name", "enter_date", "exit_date",
                     days_between(F.col("enter_date"), F.coalesce(F.col("exit_date"), now)).alias("days_at_site"),
                     (F.col("_avg_s") / F.lit(3600.0)).alias("avg_daily_hours"),
                     (F.col("_sum_s") / F.lit(3600.0)).alias("total_hours_at_site"))
            .orderBy(F.desc_nulls_last("total_hours_at_site"), "asset_id", "enter_date", "site_name"))


def q15_label_performance(t: Tables, as_of=AS_OF_EVENTS, days: int = 30) -> DataFrame:
    """Per label: assets, average utilisation and working % over the star join, distinct trouble codes.

    The SQL averages over labels x associations x assets x u x nwh x dt, which weights each asset by
    the row counts of the *other* facts. Computed exactly without the fan-out: per asset the sum and
    non-NULL count of each measure plus each fact's row count (at least 1 — a missing side of a left
    join still yields one row), then per label  sum(s_u * r_n * r_d) / sum(n_u * r_n * r_d)  and the
    analogue for working %.
    """
    now = as_of_col(as_of)
    cutoff = days_ago(now, days)
    al = t["asset_labels"].select(F.col("asset_label_id").alias("_lid"), "label_name")
    ala = t["asset_label_associations"].where(F.col("currently_applied")).select("asset_label_id", "asset_id")
    a = t["assets"].groupBy(F.col("asset_id").alias("_aid")).agg(F.count(F.lit(1)).alias("_ca"))
    u = (t["asset_utilizations_daily"].where(F.col("date") >= cutoff)
         .groupBy(F.col("asset_id").alias("_uid"))
         .agg(F.sum("utilization_percentage").alias("_su"), F.count("utilization_percentage").alias("_nu"),
              F.count(F.lit(1)).alias("_ru")))
    n = (t["asset_net_working_hours_daily"].where(F.col("date") >= cutoff)
         .groupBy(F.col("asset_id").alias("_nid"))
         .agg(F.sum("working_percentage").alias("_sw"), F.count("working_percentage").alias("_nw"),
              F.count(F.lit(1)).alias("_rn")))
    dt_rows = t["asset_dt_codes"].where(~F.col("is_acknowledged"))
    d = dt_rows.groupBy(F.col("asset_id").alias("_did")).agg(F.count(F.lit(1)).alias("_rd"))

    pairs = (al.join(ala, al._lid == ala.asset_label_id, "inner")
             .join(a, F.col("asset_id") == a._aid, "inner")
             .select("label_name", "asset_id", "_ca"))
    one = F.lit(1).cast("bigint")
    w = (pairs.join(u, pairs.asset_id == u._uid, "left")
         .join(n, pairs.asset_id == n._nid, "left")
         .join(d, pairs.asset_id == d._did, "left")
         .select("label_name", "asset_id", "_ca",
                 F.coalesce("_su", F.lit(0.0)).alias("su"), F.coalesce("_nu", F.lit(0)).alias("nu"),
                 F.coalesce("_sw", F.lit(0.0)).alias("sw"), F.coalesce("_nw", F.lit(0)).alias("nw"),
                 F.coalesce("_ru", one).alias("ru"), F.coalesce("_rn", one).alias("rn"),
                 F.coalesce("_rd", one).alias("rd")))
    per_label = (w.groupBy("label_name")
                 .agg(F.count_distinct("asset_id").alias("asset_count"),
                      F.sum(F.col("su") * F.col("_ca") * F.col("rn") * F.col("rd")).alias("_num_u"),
                      F.sum(F.col("nu") * F.col("_ca") * F.col("rn") * F.col("rd")).alias("_den_u"),
                      F.sum(F.col("sw") * F.col("_ca") * F.col("ru") * F.col("rd")).alias("_num_w"),
                      F.sum(F.col("nw") * F.col("_ca") * F.col("ru") * F.col("rd")).alias("_den_w")))
    # distinct trouble codes per label: (label, asset) pairs against the code rows, no other fact involved
    la = pairs.select("label_name", F.col("asset_id").alias("_laid")).distinct()
    codes = (la.join(dt_rows.select("asset_id", "asset_dt_code_id"), la._laid == F.col("asset_id"), "inner")
             .groupBy(F.col("label_name").alias("_cl"))
             .agg(F.count_distinct("asset_dt_code_id").alias("total_dt_codes")))
    out = per_label.join(codes, per_label.label_name == codes._cl, "left")
    return (out.select("label_name", "asset_count",
                       F.when(F.col("_den_u") > 0, F.col("_num_u") / F.col("_den_u")).alias("avg_utilization"),
                       F.when(F.col("_den_w") > 0, F.col("_num_w") / F.col("_den_w")).alias("avg_working_pct"),
                       F.coalesce(F.col("total_dt_codes"), F.lit(0)).cast("bigint").alias("total_dt_codes"))
            .orderBy(F.desc("avg_utilization"), "label_name"))


def q16_daily_consistency(t: Tables, as_of=AS_OF_EVENTS, days: int = 7) -> DataFrame:
    now = as_of_col(as_of)
    r = t["asset_readings_daily"].where(F.col("date") >= days_ago(now, days)) \
        .select("asset_id", "date", "cumulative_hours_end_of_day")
    u = t["asset_utilizations_daily"].select("asset_id", "date", "utilization_percentage", "active_run_seconds")
    n = t["asset_net_working_hours_daily"].select("asset_id", "date", "working_seconds",
                                                  "total_idle_duration_seconds")
    j = r.join(u, ["asset_id", "date"], "inner").join(n, ["asset_id", "date"], "inner")
    return (j.select("asset_id", "date", "cumulative_hours_end_of_day", "utilization_percentage",
                     (F.col("active_run_seconds") / F.lit(3600.0)).alias("active_hours"),
                     (F.col("working_seconds") / F.lit(3600.0)).alias("working_hours"),
                     (F.col("total_idle_duration_seconds") / F.lit(3600.0)).alias("idle_hours"))
            .orderBy("asset_id", F.desc("date")))


def q17_pipeline_history(t: Tables, as_of=AS_OF_ORDERS) -> DataFrame:
    now = as_of_col(as_of)
    return (t["control_last_run"]
            .select("pipeline_name", "last_run_time", "status",
                    hours_between(F.col("last_run_time"), now).alias("hours_since_run"))
            .orderBy(F.desc("last_run_time")))


def q18_missing_from_tracking(t: Tables, as_of=AS_OF_EVENTS, days: int = 7) -> DataFrame:
    """Active assets whose newest reading is older than ``days`` (or missing).

    The three facts are joined to assets on asset_id only; only MAX(date) of each is used, so each is
    reduced to its per-asset maximum first (exact), instead of |r| x |u| x |nwh| rows per asset.
    """
    now = as_of_col(as_of)
    a = t["assets"].where(F.col("status") == "Active").select("asset_id", "name", "status")

    def newest(name, alias, kid):
        return t[name].groupBy(F.col("asset_id").alias(kid)).agg(F.max("date").alias(alias))

    r = newest("asset_readings_daily", "last_reading_date", "_rid")
    u = newest("asset_utilizations_daily", "last_utilization_date", "_uid")
    n = newest("asset_net_working_hours_daily", "last_working_hours_date", "_nid")
    j = (a.join(r, a.asset_id == r._rid, "left")
         .join(u, a.asset_id == u._uid, "left")
         .join(n, a.asset_id == n._nid, "left"))
    g = (j.groupBy("asset_id", "name", "status")
         .agg(F.max("last_reading_date").alias("last_reading_date"),
              F.max("last_utilization_date").alias("last_utilization_date"),
              F.max("last_working_hours_date").alias("last_working_hours_date")))
    return (g.where((F.col("last_reading_date") < days_ago(now, days)) | F.col("last_reading_date").isNull())
            .select("asset_id", "name", "status", "last_reading_date", "last_utilization_date",
                    "last_working_hours_date",
                    days_between(F.col("last_reading_date"), now).alias("days_since_reading"))
            .orderBy(F.desc_nulls_last("days_since_reading"), "asset_id"))


def q19_run_log(t: Tables) -> DataFrame:
    return t["pipeline_last_run"].select("endpoint_name", "last_run_time", "records_processed") \
        .orderBy(F.desc("last_run_time"), "endpoint_name")


def q20_missing_data_check(t: Tables) -> DataFrame:
    """Per daily endpoint: newest loaded date against the newest successful run."""
    runs = (t["pipeline_last_run"].groupBy(F.col("endpoint_name").alias("_ep"))
            .agg(F.max("last_run_time").alias("last_run_time")))
    parts = [t[table].agg(F.max("date").alias("max_date")).select(F.lit(ep).alias("endpoint_name"), "max_date")
             for ep, table in ((c.endpoint, c.table) for c in DAILY_ENDPOINTS)]
    dates = reduce(DataFrame.unionAll, parts)
    j = dates.join(runs, dates.endpoint_name == runs._ep, "left")
    return j.select("endpoint_name", "max_date", "last_run_time",
                    days_between(F.col("max_date"), F.col("last_run_time")).alias("days_behind_run"))

