"""Plan guards for every registered read-only query: no cartesian or nested-loop joins, no Python UDF
evaluation, and parquet scans that read only the columns they need."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# entries that write (land / load / upsert) when built are checked by the oracle run instead
# (the training-data operators have tests of their own)
SIDE_EFFECTS = ("s1_", "s3_", "j2_", "e1_", "e2_", "t1_", "i3_", "i8_", "i12_", "s2_", "i6_", "n14_")
READ_ONLY = sorted(n for n in entry.queries() if not n.startswith(SIDE_EFFECTS) and not n.startswith("op") and n != "pipeline")


@pytest.mark.parametrize("name", READ_ONLY)
def test_plan_shape(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad} in plan"
    # no scan of a wide table reads every column
    for table, width in (("lineitem", 11), ("orders", 6), ("events", 6)):
        for m in re.finditer(rf"{table}\.parquet.*?ReadSchema: struct<([^>]*)>", plan, re.S):
            assert m.group(1).count(":") < width, f"{name}: full-width scan of {table}"


def _plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_history_lead_runs_over_customer_days_not_orders(spark):
    """The LEAD of the history views has a (customer, date) aggregate below it, never raw orders."""
    lines = _plan(spark, "q11_org_change_rate").splitlines()
    at = next(i for i, l in enumerate(lines) if "Window [lead(" in l)
    below = [l for l in lines[at + 1:] if re.search(r"(HashAggregate|Scan)", l)]
    assert "HashAggregate(keys=[o_custkey" in below[0] and "o_orderdate" in below[0]


def test_interval_join_keyed_by_asset_and_month(spark):
    plan = _plan(spark, "q14_site_rollup")
    assert re.search(r"Join \[asset_id#\d+L, _bucket#\d+\], \[_p_asset_id#\d+L, _p_bucket#\d+\]", plan)


@pytest.mark.parametrize("name,partial", [("i4_keep_last_events", "partial_max_by("),
                                          ("b1_expanded_billing", "partial_sum(_days"),
                                          ("q18_missing_from_tracking", "partial_max(date")])
def test_partial_aggregate_before_shuffle(spark, name, partial):
    """Hot keys are reduced per map task: the partial aggregate sits below the exchange."""
    lines = _plan(spark, name).splitlines()
    at = next(i for i, l in enumerate(lines) if partial in l)
    assert any("Exchange hashpartitioning" in l for l in lines[:at])


def test_q9_outer_join_sees_only_aggregated_counts(spark):
    """Q9's one outer join has the per-group distinct counts as its non-preserved side; the association
    rows only meet the labels in an inner join (where a hot label can be split or the labels broadcast)."""
    plan = _plan(spark, "q9_label_usage")
    assert len(re.findall(r"LeftOuter", plan)) == 1
    lines = plan.splitlines()
    at = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(coalesce(_label_name" in l)
    assert "count(distinct asset_id" in lines[at + 1]
    assert re.search(r"Join \[_lid#\d+L\], \[asset_label_id#\d+L\], Inner", plan)


def test_readings_running_total_runs_over_asset_days(spark):
    """The per-asset running total (readings view) windows over one row per asset-day (an aggregate of
    the events), so a hot asset's window holds at most one row per calendar day."""
    lines = _plan(spark, "q16_daily_consistency").splitlines()
    at = next(i for i, l in enumerate(lines) if "Window [sum(" in l)
    below = [l for l in lines[at + 1:] if re.search(r"(HashAggregate|Scan)", l)]
    assert "HashAggregate(keys=[user_id" in below[0]


def test_billing_sums_a_row_per_year(spark):
    """B1's days are summed, and B2's month totals windowed, over a row per asset, year and department, not one per month."""
    plan = _plan(spark, "b3_monthly_charges")
    line = next(l for l in plan.splitlines() if "partial_sum(_days" in l)
    assert line.count("partial_sum(_days") == 12 and line.split("], functions=")[0].count("#") == 3
    assert re.search(r"Window \[sum\(_m1#.*\], \[asset_id#\d+L, _year#\d+\]", plan)
    assert plan.count("Window [sum(") == 1


def test_billing_by_years_equals_billing_by_months(spark):
    """Overlapping intervals, several rates of an asset and NULL keys: days and totals as from one row per month."""
    from pyspark.sql import functions as F

    from fleetlake.functions.dates import month_key
    from fleetlake.operators.intervals import month_day_overlaps
    from fleetlake.plans import billing

    rows = [(1, "A", "2019-11-20", "2021-02-03"), (1, "A", "2020-01-31", "2020-02-29"), (1, "B", "2020-12-05", None), (1, None, "2021-01-01", "2021-01-01"),
            (2, "A", "2020-02-01", "2020-02-29"), (None, "A", "2020-05-01", "2020-06-02"), (3, "C", None, "2020-01-01"), (4, "D", "2021-03-09", "2021-03-01")]
    h = spark.createDataFrame(rows, "asset_id bigint, organization_department string, a string, b string").selectExpr(
        "asset_id", "organization_department", "cast(a as timestamp) from_date", "cast(b as timestamp) to_date")
    money = spark.createDataFrame([(1, 10.0), (1, 20.0), (3, 5.0)], "asset_id bigint, internal_rental_rate double")
    got = billing.expanded_asset_billing(h, money, "2021-03-10 00:00:00", month_total=True)
    # no day in these rows is a handover
    end = F.coalesce(F.date_add("to_date", 1), F.lit("2021-03-11").cast("date"))
    plain = (month_day_overlaps(h, "from_date", end, "m").groupBy("asset_id", month_key("m").alias("MonthYear"), "organization_department")
             .agg(F.sum("_days").alias("days_on_job")).join(money, "asset_id", "left"))
    assert sorted(map(str, got.drop("_total").collect())) == sorted(map(str, plain.select(got.drop("_total").columns).collect()))
    charged = [sorted(map(str, billing.monthly_charges(x).collect())) for x in (got, got.drop("_total"))]
    assert charged[0] == charged[1]
