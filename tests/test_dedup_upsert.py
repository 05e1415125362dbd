import re
import datetime as dt

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetlake.operators.dedup import keep_last
from fleetlake.operators.upsert import upsert_frames, upsert_table
from fleetlake.sources.tables import Lake


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.integers(-5, 5)),
                min_size=1, max_size=25))
def test_keep_last_matches_pandas(spark, rows):
    data = [(k, d, v, i) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d int, v int, seq long")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    got = sorted((tuple(r) for r in keep_last(df, ["k", "d"], ["seq"]).collect()), key=key)
    pdf = pd.DataFrame(data, columns=["k", "d", "v", "seq"]).drop_duplicates(["k", "d"], keep="last")
    want = sorted((tuple(None if pd.isna(x) else x for x in r) for r in pdf.itertuples(index=False)), key=key)
    assert got == want


def test_upsert_frames_null_keys_and_columns(spark):
    t = spark.createDataFrame([(1, "old"), (2, "old"), (None, "t-null")], "id int, v string")
    s = spark.createDataFrame([(2, "new", "x"), (3, "new", "x"), (None, "s-null", "x")], "id int, v string, extra string")
    got = sorted((r.id if r.id is not None else -1, r.v) for r in upsert_frames(t, s, ["id"]).collect())
    assert got == [(-1, "s-null"), (-1, "t-null"), (1, "old"), (2, "new"), (3, "new")]   # NULL never matches
    evolved = upsert_frames(t, s, ["id"], evolve=True)
    assert "extra" in evolved.columns
    missing = spark.createDataFrame([(5,)], "id int")
    assert (5, None) in [tuple(r) for r in upsert_frames(t, missing, ["id"]).collect()]   # an absent optional column is NULL


def test_partitioned_upsert_moves_rows_and_drops_empty_partition(spark, scratch):
    lake = Lake(spark, scratch)
    d1, d2, d3 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 3)
    target = spark.createDataFrame([(1, 10.0, d1), (2, 20.0, d2), (3, 30.0, d2)], "id long, v double, date timestamp")
    lake.overwrite("t", target, partition_by=["date"])
    # id 1 moves from d1 (which becomes empty) to d3; id 2 changes in place
    source = spark.createDataFrame([(1, 11.0, d3), (2, 21.0, d2)], "id long, v double, date timestamp")
    upsert_table(lake, "t", source, ["id"])
    got = sorted((r.id, r.v, r.date) for r in lake.read("t").collect())
    assert got == [(1, 11.0, d3), (2, 21.0, d2), (3, 30.0, d2)]
    # idempotent: the same batch again leaves the same table
    upsert_table(lake, "t", source, ["id"])
    assert sorted((r.id, r.v, r.date) for r in lake.read("t").collect()) == got


def test_upsert_composite_and_unpartitioned(spark, scratch):
    lake = Lake(spark, scratch)
    d1 = dt.datetime(2025, 1, 1)
    t = spark.createDataFrame([("a", d1, 1.0), ("b", d1, 2.0)], "asset_id string, date timestamp, u double")
    lake.overwrite("u", t, partition_by=["date"])
    s = spark.createDataFrame([("a", d1, 5.0)], "asset_id string, date timestamp, u double")
    upsert_table(lake, "u", s, ["asset_id", "date"])
    assert sorted((r.asset_id, r.u) for r in lake.read("u").collect()) == [("a", 5.0), ("b", 2.0)]
    lake.overwrite("flat", spark.createDataFrame([(1, "x")], "id int, v string"))
    upsert_table(lake, "flat", spark.createDataFrame([(1, "y"), (2, "z")], "id int, v string"), ["id"],
                 partition_col=None)
    assert sorted(tuple(r) for r in lake.read("flat").collect()) == [(1, "y"), (2, "z")]


@settings(max_examples=6, deadline=None)
@given(target=st.dictionaries(st.integers(0, 12), st.tuples(st.integers(0, 3), st.integers(0, 99)), min_size=1,
                              max_size=10),
       source=st.dictionaries(st.integers(0, 16), st.tuples(st.integers(0, 4), st.integers(100, 199)), min_size=1,
                              max_size=8))
def test_partitioned_upsert_equals_dict_merge_and_is_idempotent(spark, target, source):
    """Random ids over a few date partitions: rows are replaced, inserted, moved between dates
    (partitions may empty); the table equals target | source, and a replay changes nothing."""
    import uuid

    from fleetlake.session import shared_dir

    day = lambda i: dt.datetime(2025, 1, 1) + dt.timedelta(days=i)
    lake = Lake(spark, shared_dir(spark, f"prop-{uuid.uuid4().hex[:6]}"))
    schema = "id long, v long, date timestamp"
    lake.overwrite("t", spark.createDataFrame([(k, v, day(d)) for k, (d, v) in target.items()], schema),
                   partition_by=["date"])
    src = spark.createDataFrame([(k, v, day(d)) for k, (d, v) in source.items()], schema)
    want = sorted((k, v, day(d)) for k, (d, v) in {**target, **source}.items())
    upsert_table(lake, "t", src, ["id"])
    assert sorted(tuple(r) for r in lake.read("t").select("id", "v", "date").collect()) == want
    upsert_table(lake, "t", src, ["id"])
    assert sorted(tuple(r) for r in lake.read("t").select("id", "v", "date").collect()) == want


def test_partitioned_upsert_with_null_dates(spark, scratch):
    """Rows without a date live in the default partition; they are matched, kept and emptied like others."""
    lake = Lake(spark, scratch)
    d1 = dt.datetime(2025, 1, 1)
    target = spark.createDataFrame([(1, 1, None), (2, 2, None), (3, 3, d1), (4, 4, d1)],
                                   "id long, v long, date timestamp")
    lake.overwrite("t", target, partition_by=["date"])
    # id 1 changes inside the NULL partition, id 3 moves into it, id 2 stays
    upsert_table(lake, "t", spark.createDataFrame([(1, 10, None), (3, 30, None)], "id long, v long, date timestamp"),
                 ["id"])
    key = lambda r: (r[0],)
    assert sorted((tuple(r) for r in lake.read("t").select("id", "v", "date").collect()), key=key) == \
        [(1, 10, None), (2, 2, None), (3, 30, None), (4, 4, d1)]
    # every row leaves the NULL partition: it is removed
    upsert_table(lake, "t", spark.createDataFrame([(1, 11, d1), (2, 12, d1), (3, 13, d1)],
                                                  "id long, v long, date timestamp"), ["id"])
    assert sorted(tuple(r) for r in lake.read("t").select("id", "v", "date").collect()) == \
        [(1, 11, d1), (2, 12, d1), (3, 13, d1), (4, 4, d1)]
    assert lake.partition_values("t", "date") == ["2025-01-01 00:00:00"]


def test_evolved_columns_visible_after_partitioned_upsert(spark, scratch):
    """evolve=True adds a column to the rewritten partitions only; reads still see it (NULL elsewhere)."""
    lake = Lake(spark, scratch)
    d = [dt.datetime(2025, 1, i) for i in range(1, 6)]
    lake.overwrite("t", spark.createDataFrame([(i, i * 10, d[i]) for i in range(4)], "id long, v long, date timestamp"),
                   partition_by=["date"])
    upsert_table(lake, "t", spark.createDataFrame([(9, 90, d[4], "new"), (1, 11, d[1], "upd")],
                                                  "id long, v long, date timestamp, extra string"), ["id"], evolve=True)
    t = lake.read("t")
    assert "extra" in t.columns
    assert sorted((r.id, r.extra) for r in t.collect()) == [(0, None), (1, "upd"), (2, None), (3, None), (9, "new")]


def test_upsert_prunes_partitions_and_survives_the_drivers_zone(spark, scratch, monkeypatch):
    """Only the touched dates are scanned; a moved row leaves its old folder, whatever the driver's time zone."""
    import time

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        lake = Lake(spark, scratch)
        schema = "id long, v long, day string"
        rows = spark.createDataFrame([(i, i, f"2025-01-{1 + i:02d} 00:00:00") for i in range(20)], schema)
        lake.overwrite("t", rows.selectExpr("id", "v", "timestamp(day) AS date"), partition_by=["date"])
        moved = spark.createDataFrame([(3, 30, "2025-01-06 00:00:00")], schema).selectExpr("id", "v", "timestamp(day) AS date")
        seen = []
        real = Lake.stage
        monkeypatch.setattr(Lake, "stage", lambda self, name, df, **k: (seen.append(df), real(self, name, df, **k))[1])
        upsert_table(lake, "t", moved, ["id"])
        assert sorted((r.id, r.v) for r in lake.read("t").collect()) == sorted([(i, i) for i in range(20) if i != 3] + [(3, 30)])
        assert "2025-01-04 00:00:00" not in lake.partition_values("t", "date")
        plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
        filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
        assert any("2025-01-04" in x and "2025-01-06" in x for x in filters)
    finally:
        monkeypatch.undo()
        time.tzset()
