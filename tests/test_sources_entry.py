import datetime as dt
import os

from fleetlake.operators.quality import missing_tables, schema_mismatches, table_profile
from fleetlake.sources.csv import UTILIZATION_CSV_SCHEMA, read_csv


def test_csv_with_bom_dates_and_flags(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    path = os.path.join(scratch, "util.csv")
    with open(path, "wb") as f:
        f.write("﻿asset_id,date,utilization_percentage,active_hours,site_name,assignee_name\n".encode("utf-8"))
        f.write(b"A-1,8/1/2025,78.5,18.8,North,Kim\nA-1,8/2/2025,19,4.6,North,Kim\nA-2,bad,50,12,South,Lee\n")
    df = read_csv(spark, path, UTILIZATION_CSV_SCHEMA, date_cols=("date",))
    rows = df.orderBy("asset_id", "date").collect()
    assert df.columns[0] == "asset_id"                 # the BOM is not part of the first name
    assert rows[0].date == dt.datetime(2025, 8, 1) and rows[1].utilization_percentage == 19.0
    assert rows[2].date is None


def test_quality_profile_and_schema_checks(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, dt.datetime(2025, 1, 1)), (1, dt.datetime(2025, 1, 1)), (None, None)],
                               "asset_id long, date timestamp")
    p = table_profile(df, keys=("asset_id", "date"), critical=("asset_id",), date_col="date",
                      date_max=F.lit(dt.datetime(2025, 6, 1))).first()
    assert (p.row_count, p.duplicates, p.null_asset_id, p.rows_out_of_range) == (3, 2, 1, 1)
    expected = T.StructType([T.StructField("asset_id", T.LongType()), T.StructField("name", T.StringType())])
    assert schema_mismatches(df, expected) == [("name", "string", "<missing>")]
    assert missing_tables(spark, ["surely_not_a_table_xyz"]) == ["surely_not_a_table_xyz"]


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["site_name", "asset_id", "asset_name", "enter_date", "exit_date", "days_at_site",
                          "avg_daily_hours", "total_hours_at_site"]
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    assert "q14_site_rollup" in q and set(o) <= set(q)


def test_scratch_folder_only_for_a_local_master(monkeypatch):
    from types import SimpleNamespace

    import pytest
    from fleetlake import session

    def fake(master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: d, set=lambda k, v: None))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake("spark://host:7077"))
    assert "fleetlake-ckpt-" in session.ensure_checkpoint_dir(fake("local[4]"))


def test_csv_quotes_line_breaks_and_column_order(spark, scratch):
    import os

    import pytest
    from fleetlake.sources.csv import UTILIZATION_CSV_SCHEMA, read_csv

    os.makedirs(scratch)
    with open(scratch + "/sheet.csv", "w", encoding="utf-8-sig", newline="") as f:
        f.write('date,asset_id,site_name,utilization_percentage,active_hours,assignee_name\r\n'
                '8/1/2025,a1,"36"" blade, ""north""",19,7.5,"two\nlines"\r\n1/31/2025,a2,,x,,\r\n')
    got = read_csv(spark, scratch, UTILIZATION_CSV_SCHEMA, date_cols=("date",)).orderBy("asset_id").collect()
    assert [tuple(r)[2:] for r in got] == [(19.0, 7.5, '36" blade, "north"', "two\nlines"), (None, None, None, None)]
    assert [(r.asset_id, r.date.month, r.date.day) for r in got] == [("a1", 8, 1), ("a2", 1, 31)]
    with open(scratch + "/sheet.csv", "w") as f:
        f.write("asset_id,date\na,8/1/2025\n")
    with pytest.raises(ValueError, match="utilization_percentage"):
        read_csv(spark, scratch, UTILIZATION_CSV_SCHEMA)
