"""Hand-made fixtures for the interval join, billing, and the star-join rewrites (against the naive SQL)."""

import datetime as dt

import pytest

from fleetlake.operators.intervals import interval_left_join
from fleetlake.plans import billing, queries


def D(y, m, d, h=0):
    return dt.datetime(y, m, d, h)


def test_interval_join_edges(spark):
    visits = spark.createDataFrame([
        ("a", "S1", D(2025, 1, 1), D(2025, 1, 10)),       # exit day = next enter day: counted in both
        ("a", "S2", D(2025, 1, 10), None),                 # open end
        ("b", "S3", D(2025, 1, 5, 8), D(2025, 3, 2)),      # enter after midnight drops that first day
        ("c", "S4", D(2025, 1, 1), D(2025, 1, 2)),         # no daily rows
    ], "asset_id string, site string, enter_date timestamp, exit_date timestamp")
    daily = spark.createDataFrame([
        ("a", D(2025, 1, 1), 1), ("a", D(2025, 1, 10), 2), ("a", D(2025, 6, 1), 3),
        ("b", D(2025, 1, 5), 10), ("b", D(2025, 2, 15), 20), ("b", D(2025, 3, 2), 30),
    ], "asset_id string, date timestamp, secs int")
    j = interval_left_join(visits, daily, "asset_id", "enter_date", "exit_date", "date")
    got = {}
    for r in j.collect():
        got.setdefault(r.site, set())
        if r._p_secs is not None:
            got[r.site].add(r._p_secs)
    assert got == {"S1": {1, 2}, "S2": {2, 3}, "S3": {20, 30}, "S4": set()}


def test_billing_13_8_10_split(spark):
    hist = spark.createDataFrame([
        ("a1", "Dept A", D(2025, 1, 1), D(2025, 1, 14)),
        ("a1", "Dept B", D(2025, 1, 14), D(2025, 1, 22)),
        ("a1", "Dept C", D(2025, 1, 22), D(2025, 2, 1)),
    ], "asset_id string, organization_department string, from_date timestamp, to_date timestamp")
    fin = spark.createDataFrame([("a1", 3100.0)], "asset_id string, internal_rental_rate double")
    out = billing.monthly_charges(billing.expanded_asset_billing(hist, fin, as_of="2025-03-01 00:00:00"))
    rows = {r.organization_department: r for r in out.where("MonthYear = '2025-01'").collect()}   # the end day, Feb 1, counts too
    assert {k: r.days_on_job for k, r in rows.items()} == {"Dept A": 13, "Dept B": 8, "Dept C": 10}
    assert all(r.billing_tier == 1.0 for r in rows.values())
    assert [round(rows[k].monthly_charge, 6) for k in ("Dept A", "Dept B", "Dept C")] == [1300.0, 800.0, 1000.0]


@pytest.mark.parametrize("days,tier", [(0, 0.0), (1, 0.25), (7, 0.25), (8, 0.5), (14, 0.5), (15, 0.75),
                                       (21, 0.75), (22, 1.0)])
def test_billing_tiers(spark, days, tier):
    df = spark.createDataFrame([(days,)], "d int")
    assert df.select(billing.billing_tier(df.d).alias("t")).first().t == tier


def _star_fixture(spark):
    t = {
        "assets": spark.createDataFrame([(1, "A1", "Active"), (2, "A2", "Active"), (3, "A3", "Active")],
                                        "asset_id long, name string, status string"),
        "asset_labels": spark.createDataFrame([(10, "L1", "red", False), (11, "L2", "blue", True)],
                                              "asset_label_id long, label_name string, label_color string, deactivated boolean"),
        "asset_label_associations": spark.createDataFrame(
            [(1, 10, True), (2, 10, True), (3, 11, True), (1, 11, True), (2, 11, False)],
            "asset_id long, asset_label_id long, currently_applied boolean"),
        "asset_utilizations_daily": spark.createDataFrame(
            [(1, D(2024, 1, 20), 50.0), (1, D(2024, 1, 21), None), (1, D(2024, 1, 22), 70.0), (3, D(2024, 1, 25), 10.0),
             (2, D(2023, 1, 1), 99.0)],
            "asset_id long, date timestamp, utilization_percentage double"),
        "asset_net_working_hours_daily": spark.createDataFrame(
            [(1, D(2024, 1, 20), 30.0), (2, D(2024, 1, 21), 40.0), (2, D(2024, 1, 22), 60.0)],
            "asset_id long, date timestamp, working_percentage double"),
        "asset_dt_codes": spark.createDataFrame(
            [(100, 1, False), (101, 1, False), (102, 1, True), (103, 3, False)],
            "asset_dt_code_id long, asset_id long, is_acknowledged boolean"),
    }
    return t


def test_q15_weighted_averages_equal_naive_join(spark):
    t = _star_fixture(spark)
    rows = {name: [r.asDict() for r in df.collect()] for name, df in t.items()}
    since = D(2024, 1, 1)
    want = []
    for label in sorted({x["label_name"] for x in rows["asset_labels"]}):
        # every asset of the label with every combination of a day, a working day and an open code
        assets, codes, u_values, w_values = set(), set(), [], []
        for lab in rows["asset_labels"]:
            for use in rows["asset_label_associations"]:
                if lab["label_name"] != label or not use["currently_applied"] or use["asset_label_id"] != lab["asset_label_id"]:
                    continue
                if use["asset_id"] not in {x["asset_id"] for x in rows["assets"]}:
                    continue
                own = lambda table: [x for x in rows[table] if x["asset_id"] == use["asset_id"]]  # noqa: E731, B023
                days = [x["utilization_percentage"] for x in own("asset_utilizations_daily") if x["date"] >= since] or [None]
                work = [x["working_percentage"] for x in own("asset_net_working_hours_daily") if x["date"] >= since] or [None]
                open_codes = [x["asset_dt_code_id"] for x in own("asset_dt_codes") if not x["is_acknowledged"]] or [None]
                assets.add(use["asset_id"])
                for u in days:
                    for w in work:
                        for c in open_codes:
                            u_values += [u] if u is not None else []
                            w_values += [w] if w is not None else []
                            codes |= {c} - {None}
        if assets:
            mean = lambda v: round(sum(v) / len(v), 9) if v else None
            want.append((label, len(assets), mean(u_values), mean(w_values), len(codes)))
    ours = queries.q15_label_performance(t, as_of="2024-01-31 00:00:00", days=30)
    assert sorted((r.label_name, r.asset_count, None if r.avg_utilization is None else round(r.avg_utilization, 9),
                   None if r.avg_working_pct is None else round(r.avg_working_pct, 9), r.total_dt_codes) for r in ours.collect()) == want


def test_q18_preaggregation_equals_naive_join(spark):
    t = _star_fixture(spark)
    t["asset_readings_daily"] = spark.createDataFrame(
        [(1, D(2024, 1, 10)), (1, D(2024, 1, 29)), (2, D(2024, 1, 2)), (2, D(2024, 1, 3))],
        "asset_id long, date timestamp")
    def newest(table, asset):
        return max((r.date for r in t[table].collect() if r.asset_id == asset), default=None)
    want = []
    for a in t["assets"].collect():
        last = newest("asset_readings_daily", a.asset_id)
        if a.status == "Active" and (last is None or last < D(2024, 1, 24)):
            want.append((a.asset_id, last, newest("asset_utilizations_daily", a.asset_id), newest("asset_net_working_hours_daily", a.asset_id)))
    ours = queries.q18_missing_from_tracking(t, as_of="2024-01-31 00:00:00")
    assert sorted((r.asset_id, r.last_reading_date, r.last_utilization_date, r.last_working_hours_date) for r in ours.collect()) == sorted(want)


def test_history_intervals_equal_lead_window(spark, scratch):
    """The history view's next-order date equals LEAD over all orders of a customer, with many orders
    on one date and one customer holding most of the rows."""
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from fleetlake.plans.views import TestDataFleet

    rnd = random.Random(7)
    rows = []
    for key in range(1, 3001):
        cust = 1 if rnd.random() < 0.5 else rnd.randint(2, 40)      # customer 1 is hot
        day = D(1995, 1, 1) + dt.timedelta(days=rnd.randint(0, 20))  # few dates: many ties
        rows.append((key, cust, "F", 1.0, day, "1-URGENT"))
    rows += [(5001, None, "F", 1.0, D(1995, 1, 3), "1-URGENT"), (5002, 1, "F", 1.0, None, "1-URGENT"),
             (5003, 1, "F", 1.0, None, "1-URGENT")]                  # NULL customer / date: rows kept
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                "o_orderdate timestamp, o_orderpriority string") \
        .write.parquet(f"{scratch}/orders.parquet")
    got = {(r.asset_site_history_id, r.exit_date)
           for r in TestDataFleet(spark, scratch)["asset_site_history"].collect()}
    o = spark.read.parquet(f"{scratch}/orders.parquet")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    want = {(r.o_orderkey, r.n) for r in o.select("o_orderkey", F.lead("o_orderdate").over(w).alias("n")).collect()}
    assert got == want
    assert len(got) == len(rows)
    # every customer's newest order is open, plus order 5002 whose next row (5003) has no date
    assert sum(1 for _, n in got if n is None) == len({r[1] for r in rows}) + 1


def test_interval_join_equals_naive_join(spark):
    """Bucketing by (key, month) gives the naive join's pairs, also for open intervals and such as have no point."""
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(11)
    base = D(2024, 6, 1)
    visits, daily = [], []
    for i in range(300):
        s = base + dt.timedelta(days=rnd.randint(0, 500), hours=rnd.choice([0, 0, 9]))
        e = None if rnd.random() < 0.3 else s + dt.timedelta(days=rnd.randint(0, 90))
        visits.append((i, rnd.choice("abc"), s, e))       # few keys: many visits per key
    for k in "abcd":
        for d in range(0, 600, 3):
            daily.append((k, base + dt.timedelta(days=d), d))
    v = spark.createDataFrame(visits, "vid int, asset_id string, enter_date timestamp, exit_date timestamp")
    p = spark.createDataFrame(daily, "asset_id string, date timestamp, n int")
    got = sorted((r.vid, r._p_n) for r in
                 interval_left_join(v, p, "asset_id", "enter_date", "exit_date", "date")
                 .where("_p_n IS NOT NULL").collect())
    want = sorted((vid, n) for vid, k, s, e in visits for k2, d, n in daily
                  if k == k2 and d >= s and (e is None or d <= e))
    assert got == want and len(want) > 1000


def test_billing_properties_on_test_data(spark):
    """Over the derived fleet at sf0.001: per asset-month the department charges add up to
    rate x tier, and the days on job never exceed the days of the month (handover days once)."""
    from pyspark.sql import functions as F

    import __spark_entry__ as entry

    charges = entry.queries()["b3_monthly_charges"](spark, "/root/testdata/sf0.001")
    rates = entry.queries()["b1_expanded_billing"](spark, "/root/testdata/sf0.001") \
        .select("asset_id", "MonthYear", "internal_rental_rate").distinct()
    per_month = (charges.groupBy("asset_id", "MonthYear")
                 .agg(F.sum("monthly_charge").alias("charged"), F.sum("days_on_job").alias("days"),
                      F.max("billing_tier").alias("tier"))
                 .join(rates, ["asset_id", "MonthYear"]))
    rows = per_month.collect()
    assert len(rows) > 100
    for r in rows:
        month_days = (dt.date(int(r.MonthYear[:4]) + int(r.MonthYear[5:]) // 12, int(r.MonthYear[5:]) % 12 + 1, 1)
                      - dt.date(int(r.MonthYear[:4]), int(r.MonthYear[5:]), 1)).days
        assert 1 <= r.days <= month_days
        if r.internal_rental_rate is None:
            assert r.charged is None
        else:
            assert r.charged == pytest.approx(r.internal_rental_rate * r.tier, rel=1e-9, abs=1e-9)


def test_q9_rewrite_equals_naive_left_join(spark):
    t = {
        "asset_labels": spark.createDataFrame(
            [(1, "Heavy", "red", False), (2, "Heavy", "red", False), (3, "Idle", "blue", True),
             (4, None, "grey", False), (5, "Spare", "green", False)],
            "asset_label_id long, label_name string, label_color string, deactivated boolean"),
        "asset_label_associations": spark.createDataFrame(
            [(10, 1, True), (10, 2, True), (11, 2, True), (12, 1, False), (13, 3, False), (14, 4, True),
             (15, 99, True)] + [(100 + i, 1, True) for i in range(50)],         # label 1 is hot
            "asset_id long, asset_label_id long, currently_applied boolean"),
    }
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted((tuple(r) for r in queries.q9_label_usage(t).collect()), key=key)
    kinds, carried = {}, [(r.asset_id, r.asset_label_id) for r in t["asset_label_associations"].collect() if r.currently_applied]
    for lab in t["asset_labels"].collect():
        kinds.setdefault((lab.label_name, lab.label_color, lab.deactivated), set()).update(a for a, i in carried if i == lab.asset_label_id)
    want = sorted(((n, c, len(assets), d) for (n, c, d), assets in kinds.items()), key=key)
    assert got == want
    assert (None, "grey", 1, False) in got and ("Spare", "green", 0, False) in got and ("Heavy", "red", 52, False) in got


def test_filtered_fleet_any_asset_column(spark):
    """K6: filters on any asset column reach every fact keyed by asset_id; KPI cards follow."""
    from fleetlake.plans import dashboard

    t = {
        "assets": spark.createDataFrame([(1, "CAT", "Active", "320", 10.0), (2, "CAT", "Active", "336", 20.0),
                                         (3, "Deere", "Idle", "320", 30.0)],
                                        "asset_id long, make string, status string, model string, purchase_price double"),
        "asset_utilizations_daily": spark.createDataFrame(
            [(1, D(2025, 1, 1), 50.0, 3600), (2, D(2025, 1, 1), 70.0, 7200), (3, D(2025, 1, 2), 90.0, 10800),
             (1, D(2024, 12, 1), 10.0, 1800)],
            "asset_id long, date timestamp, utilization_percentage double, active_run_seconds long"),
        "asset_dt_codes": spark.createDataFrame([(100, 1), (101, 3)], "asset_dt_code_id long, asset_id long"),
    }
    f = dashboard.FilteredFleet(t, asset_filters={"model": ["320"]}, date_from=D(2025, 1, 1))
    assert sorted(r.asset_id for r in f["assets"].collect()) == [1, 3]
    assert sorted(r.asset_id for r in f["asset_utilizations_daily"].collect()) == [1, 3]
    assert sorted(r.asset_dt_code_id for r in f["asset_dt_codes"].collect()) == [100, 101]
    cards = {r.metric: r.value for r in dashboard.k1_kpi_cards(f).collect()}
    assert cards == {"fleet_utilization": 70.0, "total_hours": 4.0, "asset_count": 2.0, "fleet_value": 40.0}
    g = dashboard.FilteredFleet(t, make=["CAT"], asset_filters={"model": ["320"]})
    assert [r.asset_id for r in g["assets"].collect()] == [1]


def test_billing_day_rule(spark):
    """Both ends count, but a handover day goes to the department that starts; expected days counted one by one."""
    from fleetlake.plans.billing import expanded_asset_billing

    rows = [("a", "X", D(2025, 1, 1), D(2025, 1, 31)),                                    # closed, no successor: 31 days
            ("b", "X", D(2025, 1, 1), D(2025, 1, 14)), ("b", "Y", D(2025, 1, 14), D(2025, 1, 22)), ("b", "Z", D(2025, 1, 22), D(2025, 1, 31)),
            ("c", "X", D(2025, 2, 3), D(2025, 2, 3)),                                     # one day
            ("d", "X", D(2025, 2, 3), D(2025, 2, 3)), ("d", "Y", D(2025, 2, 3), D(2025, 3, 2)),
            ("e", "X", D(2025, 1, 30), None), ("f", "X", D(2025, 1, 5, 9), D(2025, 1, 7, 8)), ("f", "Y", D(2025, 1, 7, 8), D(2025, 1, 7, 18))]
    as_of, days = dt.date(2025, 3, 10), {}
    for i, (asset, dept, a, b) in enumerate(rows):
        day = a.date()
        while day <= (b.date() if b else as_of):
            handed = b and day == b.date() and any(x[0] == asset and j != i and x[2].date() == day for j, x in enumerate(rows))
            if not handed:
                k = (asset, f"{day:%Y-%m}", dept)
                days[k] = days.get(k, 0) + 1
            day += dt.timedelta(days=1)
    h = spark.createDataFrame(rows, "asset_id string, organization_department string, from_date timestamp, to_date timestamp")
    money = spark.createDataFrame([("a", 100.0)], "asset_id string, internal_rental_rate double")
    got = {(r.asset_id, r.MonthYear, r.organization_department): r.days_on_job for r in expanded_asset_billing(h, money, "2025-03-10 00:00:00").collect()}
    assert got == days and got["a", "2025-01", "X"] == 31 and [got["b", "2025-01", d] for d in "XYZ"] == [13, 8, 10]


def test_interval_join_leaves_no_row_per_pointless_month(spark):
    """A long visit keeps its pairs and at most its first month's empty row; one without a start keeps its row."""
    visits = spark.createDataFrame([("a", "long", D(2020, 1, 5), D(2024, 12, 31)), ("a", "none", D(2018, 1, 1), D(2019, 12, 31)), ("a", "unknown", None, None)],
                                   "asset_id string, site string, enter_date timestamp, exit_date timestamp")
    daily = spark.createDataFrame([("a", D(2022, 3, 1), 1), ("a", D(2022, 3, 2), 2), ("a", D(2024, 12, 31), 3)], "asset_id string, date timestamp, secs int")
    j = interval_left_join(visits, daily, "asset_id", "enter_date", "exit_date", "date")
    got = sorted(((r.site, r._p_secs) for r in j.collect()), key=str)
    assert got == sorted([("long", None), ("long", 1), ("long", 2), ("long", 3), ("none", None), ("unknown", None)], key=str)
