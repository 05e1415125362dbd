"""Pro-rated monthly rental charges.

B1  ExpandedAssetBilling: organisation-history intervals -> days on job per (asset, month, department).
    Day rule: date grain, both ends count; but a handover day, on which another interval of the asset
    starts, belongs to the department that starts. An open interval runs through the day of ``as_of``.
    Intervals are exploded into the *months* they overlap (not into days) and the overlap is counted
    arithmetically, so a multi-year interval costs one row per month.
B2  billing tier from the asset's total days in that month: >=22 -> 1.00, >=15 -> 0.75, >=8 -> 0.50,
    >=1 -> 0.25, else 0.
B3  charge = days_on_job / total_days * (internal_rental_rate * tier); total 0 gives NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions.dates import as_of_col, month_key
from fleetlake.operators.intervals import month_day_overlaps
from fleetlake.plans.views import AS_OF_ORDERS

# Billing tiers (minimum days in the month -> share of the monthly rate)
TIERS = ((22, 1.00), (15, 0.75), (8, 0.50), (1, 0.25))


MONTHS = range(1, 13)


def expanded_asset_billing(org_history: DataFrame, financials: DataFrame, as_of=AS_OF_ORDERS, month_total: bool = False) -> DataFrame:
    """B1: (asset_id, MonthYear, organization_department, days_on_job, internal_rental_rate).

    ``month_total`` adds ``_total``, the asset's days of the month in all departments, for B2."""
    now = as_of_col(as_of)
    h = org_history.select("asset_id", "organization_department", "from_date", "to_date")
    # how many intervals of an asset start on a day: on an end day, any but the interval itself makes it a handover
    starts = (h.groupBy(F.col("asset_id").alias("_aid"), F.to_date("from_date").alias("_day")).agg(F.count(F.lit(1)).alias("_starts")))
    end_day = F.to_date("to_date")
    h = h.join(starts, (h["asset_id"] == starts["_aid"]) & (end_day == starts["_day"]), "left")
    itself = F.when(F.to_date("from_date") == end_day, 1).otherwise(0)
    handover = F.coalesce(F.col("_starts"), F.lit(0)) > itself
    end_excl = F.when(end_day.isNull(), F.date_add(F.to_date(now), 1)).when(handover, end_day).otherwise(F.date_add(end_day, 1))
    x = month_day_overlaps(h.select("asset_id", "organization_department", "from_date", end_excl.alias("_end")), "from_date", F.col("_end"), month_col="_month")
    # summed map-side first: an asset holding a third of all intervals is reduced per task before the shuffle. A row holds
    # a year's months, so a task that sums has a row per asset, year and department in memory, not one per month
    months = [F.expr(f"sum(_days) FILTER (WHERE month(_month) = {m})").alias(f"_m{m}") for m in MONTHS]
    years = x.groupBy("asset_id", F.year("_month").alias("_year"), "organization_department").agg(*months)
    rate = financials.select(F.col("asset_id").alias("_fid"), "internal_rental_rate")
    rated = years.join(rate, years.asset_id == rate._fid, "left")
    of_month = {"days_on_job": [F.col(f"_m{m}") for m in MONTHS]}
    if month_total:
        # summed over the year's row for the same reason: a window over months would sort a row for each
        year = Window.partitionBy("asset_id", "_year")
        rated = rated.select("*", *[F.sum(f"_m{m}").over(year).alias(f"_t{m}") for m in MONTHS])
        of_month["_total"] = [F.col(f"_t{m}") for m in MONTHS]
    cells = F.array(*[F.struct(F.lit(m).alias("month"), *[c[m - 1].alias(n) for n, c in of_month.items()]) for m in MONTHS])
    days = rated.select("asset_id", "_year", "organization_department", "internal_rental_rate", F.inline(cells))
    return (days.where(F.col("days_on_job").isNotNull())                   # a month without days holds no interval
            .select("asset_id", month_key(F.make_date("_year", "month", F.lit(1))).alias("MonthYear"),
                    "organization_department", "days_on_job", "internal_rental_rate", *[n for n in of_month if n != "days_on_job"]))


def billing_tier(total_days) -> F.Column:
    expr = None
    for min_days, share in TIERS:
        expr = (F.when(total_days >= min_days, F.lit(share)) if expr is None
                else expr.when(total_days >= min_days, F.lit(share)))
    return expr.otherwise(F.lit(0.0))


def monthly_charges(expanded: DataFrame) -> DataFrame:
    """B2 + B3 over an ExpandedAssetBilling frame. The month total is the frame's ``_total`` or one window, reused."""
    total = F.sum("days_on_job").over(Window.partitionBy("asset_id", "MonthYear"))
    with_total = expanded if "_total" in expanded.columns else expanded.select("*", total.alias("_total"))
    tier = billing_tier(F.col("_total"))
    charge = (F.try_divide(F.col("days_on_job").cast("double"), F.col("_total").cast("double"))
              * (F.col("internal_rental_rate") * tier))
    return with_total.select("asset_id", "MonthYear", "organization_department", "days_on_job",
                             tier.alias("billing_tier"), charge.alias("monthly_charge"))


def b1_expanded_billing(t: Mapping[str, DataFrame], as_of=AS_OF_ORDERS, month_total: bool = False) -> DataFrame:
    return expanded_asset_billing(t["asset_organization_history"], t["asset_financials"], as_of, month_total)


def b3_monthly_charges(t: Mapping[str, DataFrame], as_of=AS_OF_ORDERS) -> DataFrame:
    return monthly_charges(b1_expanded_billing(t, as_of, month_total=True))


# Oracles from the rule: one row per day of the calendar that an interval holds (not months and overlaps, as above)
_DAYS_SQL = """
    held AS (
        SELECT h.asset_id, h.organization_department, CAST(day AS DATE) AS day
        FROM asset_organization_history h,
             unnest(generate_series(CAST(h.from_date AS DATE), CAST(COALESCE(h.to_date, TIMESTAMP '{as_of}') AS DATE), INTERVAL 1 DAY)) AS u(day)
        WHERE h.to_date IS NULL OR CAST(day AS DATE) < CAST(h.to_date AS DATE)
           OR (SELECT count(*) FROM asset_organization_history o
               WHERE o.asset_id = h.asset_id AND CAST(o.from_date AS DATE) = CAST(h.to_date AS DATE))
              = CASE WHEN CAST(h.from_date AS DATE) = CAST(h.to_date AS DATE) THEN 1 ELSE 0 END),
    billed AS (
        SELECT held.asset_id, strftime(day, '%Y-%m') AS month_year, organization_department, count(*) AS days_held
        FROM held GROUP BY ALL)"""

ORACLE = {
    "b1_expanded_billing": "WITH " + _DAYS_SQL.format(as_of=AS_OF_ORDERS) + """
        SELECT asset_id, month_year AS "MonthYear", organization_department, days_held AS days_on_job,
               (SELECT max(f.internal_rental_rate) FROM asset_financials f WHERE f.asset_id = billed.asset_id) AS internal_rental_rate
        FROM billed""",
    "b3_monthly_charges": "WITH " + _DAYS_SQL.format(as_of=AS_OF_ORDERS) + """,
    tiers(least_days, share) AS (VALUES (22, 1.00::DOUBLE), (15, 0.75::DOUBLE), (8, 0.50::DOUBLE), (1, 0.25::DOUBLE), (0, 0.0::DOUBLE)),
    months AS (SELECT asset_id, month_year, sum(days_held) AS days FROM billed GROUP BY ALL),
    rated AS (SELECT asset_id, month_year, days, max(share) AS share FROM months JOIN tiers ON days >= least_days GROUP BY ALL)
        SELECT asset_id, month_year AS "MonthYear", organization_department, days_held AS days_on_job, share AS billing_tier,
               CAST(days_held AS DOUBLE) / CAST(days AS DOUBLE)
                   * ((SELECT max(f.internal_rental_rate) FROM asset_financials f WHERE f.asset_id = billed.asset_id) * share) AS monthly_charge
        FROM billed JOIN rated USING (asset_id, month_year)""",
}
