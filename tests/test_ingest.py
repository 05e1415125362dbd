import datetime as dt
import json
import os

from fleetlake.config import endpoint_config
from fleetlake.plans.ingest import last_successful_run, load_daily, refresh_static, watermark
from fleetlake.sources.pages import page_schema_of
from fleetlake.sources.tables import CONTROL_TABLE, RUN_LOG_TABLE, Lake
from fleetlake.streaming.incremental import run_incremental_stream

EP = "asset-utilizations-daily"


def _land(folder, offset, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"page-{offset:09d}.json"), "w") as f:
        f.write(json.dumps({"offset": offset, "results": records}) + "\n")


def _rec(asset, day, secs, spelled=None):
    return {"asset_id": asset, "date": spelled or f"2025-01-{day:02d}", "active_run_seconds": str(secs),
            "utilization_percentage": secs / 864.0, "asset_target_work_hours": "8.6"}


def test_daily_load_watermark_dedup_and_log(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    cfg = endpoint_config(EP)
    assert watermark(lake, cfg) is None                                  # no run log: full load
    b1 = scratch + "/b1"
    # the same (asset, day) twice in one batch, spelled two ways: keep the later one (after casts)
    _land(b1, 0, [_rec("a", 1, 100), _rec("a", 2, 200), _rec("b", 2, 300)])
    _land(b1, 3, [_rec("a", 2, 250, spelled="2025-01-02T00:00:00")])
    r = load_daily(spark, lake, b1, EP, now=dt.datetime(2025, 1, 3, 2))
    assert (r.records, r.table_rows, r.duplicates) == (3, 3, 0)
    t = {(x.asset_id, x.date.day): x for x in lake.read("asset_utilizations_daily").collect()}
    assert t[("a", 2)].active_run_seconds == 250
    assert t[("a", 2)].asset_target_work_hours == 8.0                    # long then double
    assert last_successful_run(lake, EP) == dt.datetime(2025, 1, 3, 2)
    assert watermark(lake, cfg) == dt.date(2025, 1, 2)                   # newest loaded day

    # second run: a late row older than the watermark is not re-read; the watermark day is
    b2 = scratch + "/b2"
    _land(b2, 0, [_rec("a", 1, 999), _rec("b", 2, 301), _rec("c", 3, 50)])
    r = load_daily(spark, lake, b2, EP, now=dt.datetime(2025, 1, 4, 2))
    assert r.records == 2 and r.table_rows == 4
    t = {(x.asset_id, x.date.day): x.active_run_seconds for x in lake.read("asset_utilizations_daily").collect()}
    assert t == {("a", 1): 100, ("a", 2): 250, ("b", 2): 301, ("c", 3): 50}

    # nothing new: no write, no run-log row
    b3 = scratch + "/b3"
    _land(b3, 0, [_rec("a", 1, 5)])
    r = load_daily(spark, lake, b3, EP, now=dt.datetime(2025, 1, 5, 2))
    assert r.skipped
    assert lake.read(RUN_LOG_TABLE).count() == 2


def test_run_log_without_table_uses_run_date(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    lake.log_run(EP, dt.datetime(2025, 3, 1, 2), 10)
    assert watermark(lake, endpoint_config(EP)) == dt.date(2025, 3, 1)


def test_stream_equals_batch(spark, scratch):
    landing = scratch + "/landing"
    _land(landing + "/f1", 0, [_rec("a", 1, 100), _rec("b", 1, 200)])
    _land(landing + "/f2", 2, [_rec("a", 1, 150), _rec("c", 2, 30)])
    batch_lake = Lake(spark, scratch + "/batch")
    load_daily(spark, batch_lake, landing + "/*", EP, now=dt.datetime(2025, 1, 3))
    stream_lake = Lake(spark, scratch + "/stream")
    schema = page_schema_of(spark, landing + "/*")
    run = run_incremental_stream(spark, stream_lake, landing + "/*", EP, scratch + "/ckpt", schema,
                                 max_files_per_trigger=1, now=dt.datetime(2025, 1, 3))
    # two micro-batches, two run-log rows, one table check at the end
    assert stream_lake.read(RUN_LOG_TABLE).count() == 2
    assert (run.verified.records, run.verified.table_rows, run.verified.duplicates) == (4, 3, 0)
    rows = lambda lk: sorted((r.asset_id, r.date, r.active_run_seconds)
                             for r in lk.read("asset_utilizations_daily").collect())
    assert rows(batch_lake) == rows(stream_lake)
    assert ("a", dt.datetime(2025, 1, 1), 150) in rows(stream_lake)


def test_static_refresh_and_control(spark, scratch):
    landing = scratch + "/landing"
    _land(landing + "/assets", 0, [{"asset_id": "x1", "year": "2019", "billable": "Yes",
                                    "updated_at": "2025-01-01T10:00:00", "specs": {"hp": 120}, "notes": None},
                                   {"asset_id": "x2", "notes": None, "engine_year": None}])
    _land(landing + "/asset-warranties", 0, [{"asset_warranty_id": "w1", "asset_id": "x1", "expired": "false"}])
    lake = Lake(spark, scratch + "/lake")
    from fleetlake.config import ENDPOINTS
    res = refresh_static(spark, lake, landing, endpoints=(ENDPOINTS["assets"], ENDPOINTS["asset-warranties"]),
                         now=dt.datetime(2025, 1, 2))
    assert [r.records for r in res] == [2, 1]
    t = lake.read("assets")
    a = t.where("asset_id = 'x1'").first()
    assert a.year == 2019 and a.billable is True and a.specs == '{"hp":120}'
    # An all-NULL column that is not configured becomes "", a configured one keeps its type
    assert {r.notes for r in t.collect()} == {""} and dict(t.dtypes)["engine_year"] == "bigint"
    c = lake.read(CONTROL_TABLE).collect()
    assert len(c) == 1 and c[0].status == "success"
    assert sorted(lake.tables()) == ["asset_warranties", "assets", CONTROL_TABLE]


def test_newest_date_from_partition_folders(spark, scratch):
    from fleetlake.plans.ingest import newest_date

    lake = Lake(spark, scratch + "/lake")
    df = spark.createDataFrame([("a", dt.datetime(2025, 1, d)) for d in (3, 11, 7)], "asset_id string, date timestamp")
    lake.overwrite("daily", df, partition_by=["date"])
    assert lake.partition_values("daily", "date") is not None
    assert newest_date(lake, "daily") == dt.datetime(2025, 1, 11)
    lake.overwrite("flat", df)                                             # not partitioned: scanned
    assert lake.partition_values("flat", "date") is None
    assert newest_date(lake, "flat") == dt.datetime(2025, 1, 11)


def test_daily_load_blanks_all_null_columns_of_the_deduplicated_batch(spark, scratch):
    """N2 on the daily path runs on the deduplicated batch (its NULL counts observed while staging):
    a column whose only value sat in a replaced record is blank; configured columns keep their type."""
    b = scratch + "/b"
    first = dict(_rec("a", 1, 100), note="replaced later")
    _land(b, 0, [first, dict(_rec("b", 1, 50), note=None), dict(_rec("c", 1, 70), memo="kept")])
    _land(b, 3, [dict(_rec("a", 1, 120), note=None, memo=None)])
    lake = Lake(spark, scratch + "/lake")
    r = load_daily(spark, lake, b, EP, now=dt.datetime(2025, 1, 2, 2))
    assert r.records == 3
    t = lake.read("asset_utilizations_daily")
    rows = {x.asset_id: x for x in t.collect()}
    assert {x.note for x in rows.values()} == {""}                       # all NULL after dedup -> ""
    assert rows["c"].memo == "kept" and rows["a"].memo is None
    assert rows["a"].active_run_seconds == 120 and dict(t.dtypes)["utilization_percentage"] == "double"


def test_failed_write_raises_and_logs_nothing(spark, scratch, monkeypatch):
    """An error while saving propagates; no run-log row is written and the table is unchanged."""
    import pytest

    lake = Lake(spark, scratch + "/lake")
    _land(scratch + "/b1", 0, [_rec("a", 1, 100)])
    load_daily(spark, lake, scratch + "/b1", EP, now=dt.datetime(2025, 1, 2, 2))
    _land(scratch + "/b2", 0, [{"asset_id": "a", "date": "2025-01-02", "active_run_seconds": "5"}])

    def full(*args, **kwargs):
        raise OSError("no space left")
    monkeypatch.setattr(Lake, "overwrite_partitions", full)
    with pytest.raises(OSError):
        load_daily(spark, lake, scratch + "/b2", EP, now=dt.datetime(2025, 1, 3, 2))
    assert lake.read(RUN_LOG_TABLE).count() == 1
    assert [(r.asset_id, r.active_run_seconds) for r in lake.read("asset_utilizations_daily").collect()] == [("a", 100)]


def test_empty_page_is_no_new_data(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    _land(scratch + "/empty", 0, [])
    r = load_daily(spark, lake, scratch + "/empty", EP, now=dt.datetime(2025, 1, 2, 2))
    assert r.skipped and r.records == 0
    assert not lake.exists("asset_utilizations_daily") and not lake.exists(RUN_LOG_TABLE)


def test_staged_copies_are_removed_after_a_successful_load(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    _land(scratch + "/b1", 0, [_rec("a", 1, 100), _rec("b", 1, 10)])
    _land(scratch + "/b2", 0, [_rec("a", 1, 150), _rec("c", 2, 20)])
    load_daily(spark, lake, scratch + "/b1", EP, now=dt.datetime(2025, 1, 2, 2))
    load_daily(spark, lake, scratch + "/b2", EP, now=dt.datetime(2025, 1, 3, 2))
    staging = scratch + "/lake/_staging"
    assert not os.path.isdir(staging) or os.listdir(staging) == []
    got = sorted((r.asset_id, r.active_run_seconds) for r in lake.read("asset_utilizations_daily").collect())
    assert got == [("a", 150), ("b", 10), ("c", 20)]


def test_run_log_is_only_appended(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    for i in range(5):
        lake.log_run(EP, dt.datetime(2025, 1, 1 + i, 2), i)
        lake.log_run("another", dt.datetime(2025, 2, 1 + i, 2), i)
    assert sorted(r.records_processed for r in lake.runs().where(f"endpoint_name = '{EP}'").collect()) == [0, 1, 2, 3, 4]
    assert last_successful_run(lake, EP) == dt.datetime(2025, 1, 5, 2)


def test_a_cut_page_fails_the_load(spark, scratch):
    import pytest

    lake = Lake(spark, scratch + "/lake")
    _land(scratch + "/b1", 0, [_rec("a", 1, 100)])
    load_daily(spark, lake, scratch + "/b1", EP, now=dt.datetime(2025, 1, 2, 2))
    for n, bad in enumerate(('{"offset": 0, "results": [{"asset_id": "b", "da', '{"offset": 0, "error": "later"}')):
        folder = f"{scratch}/bad{n}"
        _land(folder, 0, [_rec("b", 2, 1)])
        with open(os.path.join(folder.removeprefix("file:"), "zz.json"), "w") as f:
            f.write(bad + "\n")
        with pytest.raises(Exception):
            load_daily(spark, lake, folder, EP, now=dt.datetime(2025, 1, 3, 2))
    assert [(r.asset_id, r.active_run_seconds) for r in lake.read("asset_utilizations_daily").collect()] == [("a", 100)]
    assert lake.runs().count() == 1


def test_later_landing_wins_whatever_its_offsets(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    _land(scratch + "/in/day1", 0, [_rec("a", 1, 111), _rec("b", 1, 5)])
    _land(scratch + "/in/day2", 0, [_rec("a", 1, 222)])
    load_daily(spark, lake, scratch + "/in/*", EP, now=dt.datetime(2025, 1, 2, 2))
    assert sorted((r.asset_id, r.active_run_seconds) for r in lake.read("asset_utilizations_daily").collect()) == [("a", 222), ("b", 5)]


def test_drift_sparse_batches_and_bad_dates(spark, scratch):
    """Types that drift, a column that a batch lacks or has all NULL, objects and unreadable dates: the stored types stay."""
    lake = Lake(spark, scratch + "/lake")
    good = {"asset_id": "a", "date": "2025-01-01", "active_run_seconds": 10, "n": 100, "note": "x"}
    _land(scratch + "/b1", 0, [good, {**good, "asset_id": "nodate", "date": "n/a"}])
    _land(scratch + "/b2", 0, [{"asset_id": "b", "date": "2025-01-02", "active_run_seconds": {"v": 1}, "n": 7.5}, {"asset_id": "nodate2", "date": "n/a", "n": None}])
    _land(scratch + "/b3", 0, [{"asset_id": "c", "date": "2025-01-03", "n": "text"}])
    for i in (1, 2, 3):
        load_daily(spark, lake, f"{scratch}/b{i}", EP, now=dt.datetime(2025, 1, 1 + i, 2))
    t = lake.read("asset_utilizations_daily")
    assert dict(t.dtypes)["n"] == "bigint" and dict(t.dtypes)["active_run_seconds"] == "bigint"
    got = {r.asset_id: (r.date and r.date.day, r.active_run_seconds, r.n, r.note) for r in t.collect()}
    assert got == {"a": (1, 10, 100, "x"), "nodate": (None, 10, 100, "x"), "b": (2, None, 7, None), "nodate2": (None, None, None, None), "c": (3, None, None, None)}


def test_a_late_landing_does_not_overwrite_a_later_one(spark, scratch):
    """Three runs of one stream; the order in which landings arrive doesn't matter, the order of their names does."""
    arrivals = [("f2", [_rec("a", 1, 222), _rec("b", 1, 5)]), ("f1", [_rec("a", 1, 111), _rec("c", 1, 9)]), ("f3", [_rec("c", 1, 10, spelled="2025-01-01T00:00:00")])]
    for name, records in arrivals:
        _land(f"{scratch}/all/{name}", 0, records)
    schema = page_schema_of(spark, scratch + "/all/*")
    lake = Lake(spark, scratch + "/lake")
    for name, records in arrivals:
        _land(f"{scratch}/landing/{name}", 0, records)
        run_incremental_stream(spark, lake, scratch + "/landing/*", EP, scratch + "/ckpt", schema, now=dt.datetime(2025, 1, 3))
    rows = sorted((r.asset_id, r.active_run_seconds) for r in lake.read("asset_utilizations_daily").collect())
    assert rows == [("a", 222), ("b", 5), ("c", 10)]
    one = Lake(spark, scratch + "/one")
    load_daily(spark, one, scratch + "/all/*", EP, now=dt.datetime(2025, 1, 3))
    assert rows == sorted((r.asset_id, r.active_run_seconds) for r in one.read("asset_utilizations_daily").collect())
