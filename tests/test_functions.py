import datetime as dt

from pyspark.sql import functions as F

from fleetlake.functions import casts, dates


def test_lenient_casts(spark):
    df = spark.createDataFrame([("abc",), ("",), ("12.7",), ("9007199254740993",), ("NaN",), ("Yes",),
                                ("2025-01-02T03:04:05Z",), ("-3.9",), (None,)], "s string")
    rows = df.select("s", casts.to_long_lenient("s").alias("l"), casts.to_boolean_lenient("s").alias("b"),
                     casts.to_timestamp_lenient("s").alias("t"), casts.to_double_lenient("s").alias("d")).collect()
    got = {r.s: r for r in rows}
    assert got["abc"].l is None and got["abc"].b is None and got["abc"].t is None
    assert got[""].l is None
    assert got["12.7"].l == 12 and got["-3.9"].l == -3
    assert got["9007199254740993"].l == 9007199254740993      # exact beyond 2^53
    assert got["NaN"].l is None                                # missing stays NULL, not 0
    assert got["Yes"].b is True
    assert got["2025-01-02T03:04:05Z"].t == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert got[None].l is None


def test_boundary_date_diffs(spark):
    df = spark.sql("""SELECT timestamp'2025-01-01 00:59:00' a, timestamp'2025-01-01 02:01:00' b,
                             timestamp'2025-01-31 23:00:00' c, timestamp'2025-02-01 01:00:00' e""")
    r = df.select(dates.hours_between("a", "b").alias("h"), dates.days_between("c", "e").alias("d"),
                  dates.months_between_boundaries("c", "e").alias("m"),
                  dates.days_ago(F.col("a"), 30).alias("ago"), dates.month_key("c").alias("k")).first()
    assert (r.h, r.d, r.m) == (2, 1, 1)          # boundaries crossed, not elapsed units
    assert r.ago == dt.datetime(2024, 12, 2, 0, 59)
    assert r.k == "2025-01"


def test_round_half_up_same_in_spark_and_sql(spark):
    import duckdb

    from fleetlake.functions.casts import round_half_up, sql_round

    values = [2.175, 1.005, 0.125, 0.225, 2.5, 78.4999999, 7830 / 3600, 1 / 3, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    assert got[:4] == [2.18, 1.01, 0.13, 0.23] and got[5] == 78.5
    sql = [duckdb.sql(f"SELECT {sql_round(repr(v) + '::DOUBLE', 2)}").fetchall()[0][0] for v in values]
    assert got == sql
