"""Tables by catalog name, changes that are cut between their steps, landings that are not read twice, single parses."""
import datetime as dt
import json
import os
import uuid

import pytest

from fleetlake.operators import upsert
from fleetlake.operators.upsert import upsert_table
from fleetlake.plans.ingest import load_daily, load_static
from fleetlake.sources import landings, tables
from fleetlake.sources.catalog import CatalogLake, takes_row_changes
from fleetlake.sources.pages import SEQ, Landing, object_fields, read_known, read_pages
from fleetlake.sources.tables import CatalogTables, Lake

EP = "asset-utilizations-daily"
D = [dt.datetime(2025, 1, i) for i in range(1, 6)]


def _land(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps({"offset": 0, "results": records}) + "\n")


def _rec(asset, day, secs):
    return {"asset_id": asset, "date": f"2025-01-{day:02d}", "active_run_seconds": secs}


@pytest.fixture()
def catalog_lake(spark, scratch):
    name = "fleet_" + uuid.uuid4().hex[:8]
    yield CatalogLake(spark, scratch + "/lake", name)
    spark.sql(f"DROP DATABASE `{name}` CASCADE")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_catalog_loads_and_refreshes(spark, scratch, catalog_lake):
    lake = catalog_lake
    _land(scratch + "/a", "p.json", [{"asset_id": "x", "year": "2019"}, {"asset_id": "y", "year": None}])
    load_static(spark, lake, scratch + "/a", "assets")
    _land(scratch + "/b", "p.json", [{"asset_id": "x", "year": "2020", "make": "CAT"}])
    load_static(spark, lake, scratch + "/b", "assets")                              # other columns: redefined
    assert rows(spark.sql(f"SELECT asset_id, year, make FROM {lake.table_name('assets')}")) == [("x", 2020, "CAT")]
    for i, batch in enumerate(([_rec("a", 1, 10), _rec("b", 2, 20)], [_rec("b", 2, 21), _rec("c", 3, 30)])):
        _land(f"{scratch}/d{i}", "p.json", batch)
        load_daily(spark, lake, f"{scratch}/d{i}", EP, now=D[i + 1])
    by_name = CatalogTables(spark, lake.database)
    assert rows(by_name["asset_utilizations_daily"].select("asset_id", "active_run_seconds")) == [("a", 10), ("b", 21), ("c", 30)]
    assert spark.sql(f"SHOW PARTITIONS {lake.table_name('asset_utilizations_daily')}").count() == 3
    assert lake.tables() == ["asset_utilizations_daily", "assets", "pipeline_last_run"]
    # a row that moves empties a partition, which goes from the catalog too
    lake.overwrite("moved", spark.createDataFrame([(1, D[0]), (2, D[1])], "id long, date timestamp"), partition_by=["date"])
    upsert_table(lake, "moved", spark.createDataFrame([(1, D[2])], "id long, date timestamp"), ["id"])
    assert rows(lake.read("moved")) == [(1, D[2]), (2, D[1])]
    assert spark.sql(f"SHOW PARTITIONS {lake.table_name('moved')}").count() == 2
    lake.drop("moved")
    assert not lake.exists("moved") and not os.path.exists(scratch + "/lake/moved")


def test_merge_is_left_to_catalogs_that_can(spark, scratch, catalog_lake, monkeypatch):
    catalog_lake.overwrite("t", spark.createDataFrame([(1, "old")], "id int, v string"))
    assert not takes_row_changes(spark, catalog_lake.table_name("t")) and not Lake(spark, scratch).can_merge("t")
    merged = []
    monkeypatch.setattr(CatalogLake, "can_merge", lambda self, name: True)
    monkeypatch.setattr(upsert, "merge_rows", lambda lake, name, source, keys, evolve: merged.append((name, keys)))
    upsert_table(catalog_lake, "t", spark.createDataFrame([(1, "new")], "id int, v string"), ["id"], partition_col=None)
    assert merged == [("t", ["id"])] and rows(catalog_lake.read("t")) == [(1, "old")]


def test_merge_statement(spark, catalog_lake):
    """The MERGE that is sent: a catalog of plain files refuses it, once the statement has been resolved."""
    catalog_lake.overwrite("t", spark.createDataFrame([(1, "old")], "id int, v string"))
    with pytest.raises(Exception, match="(?i)merge into|row-level|not support"):
        upsert.merge_rows(catalog_lake, "t", spark.createDataFrame([("1", "new")], "id string, v string"), ["id"])


class Killed(BaseException):
    """The end of the process, as far as one test can have it."""


@pytest.mark.parametrize("cut", ["overwrite_partitions", "delete_partitions"])
def test_a_cut_upsert_is_finished_by_the_next_reader(spark, scratch, monkeypatch, cut):
    lake = Lake(spark, scratch)
    lake.overwrite("t", spark.createDataFrame([(1, D[0]), (2, D[1])], "id long, date timestamp"), partition_by=["date"])
    with monkeypatch.context() as m:
        def killed(*args):
            raise Killed
        m.setattr(Lake, cut, killed)
        with pytest.raises(Killed):
            upsert_table(lake, "t", spark.createDataFrame([(1, D[2])], "id long, date timestamp"), ["id"])
    assert "t.json" in os.listdir(scratch + "/_intents")
    assert rows(Lake(spark, scratch).read("t")) == [(1, D[2]), (2, D[1])]            # not id 1 twice
    assert not [f for f in os.listdir(scratch + "/_intents") if f == "t.json"]


def test_a_cut_refresh_is_finished(spark, scratch, monkeypatch):
    lake = Lake(spark, scratch)
    lake.overwrite("t", spark.range(3))
    fresh, old = lake.stage_path("t"), lake.stage_path("replaced")
    spark.range(5).write.parquet(fresh)
    with pytest.raises(OSError):
        with lake._intent("t", {"fresh": fresh, "old": old}):
            os.makedirs(os.path.dirname(old), exist_ok=True)
            os.rename(scratch + "/t", old)                                            # moved aside, then killed
            raise OSError("killed")
    assert Lake(spark, scratch).exists("t") and Lake(spark, scratch).read("t").count() == 5


def test_another_applications_intent_is_left_for_a_while(spark, scratch, monkeypatch):
    lake = Lake(spark, scratch)
    lake.overwrite("t", spark.range(3))
    fs, p = lake._fs(lake._intent_path("t"))
    out = fs.create(p, True)
    out.write(bytearray(json.dumps({"fresh": scratch + "/none", "old": scratch + "/none2", "application": "another", "writer": "w"}), "utf-8"))
    out.close()
    assert not lake.finish_intents("t") and lake.read("t").count() == 3
    monkeypatch.setattr(tables.Lake, "LEASE", -1)
    assert lake.finish_intents("t") and lake.read("t").count() == 3


def test_landings_are_read_once(spark, scratch):
    lake, root = Lake(spark, scratch + "/lake"), scratch + "/landing"
    _land(root + "/day1", "p1.json", [_rec("a", 1, 10)])
    _land(root + "/day2", "p1.json", [_rec("a", 2, 20), _rec("b", 2, 5)])
    assert load_daily(spark, lake, root, EP, now=D[2], ledger=True).records == 3
    assert landings.unread(lake, EP, root) == [] and load_daily(spark, lake, root, EP, now=D[3], ledger=True).skipped
    _land(root + "/day3", "p1.json", [_rec("a", 3, 30)])
    _land(root, "loose.json", [_rec("d", 3, 1)])
    late = root + "/day2/p2.json"
    _land(root + "/day2", "p2.json", [_rec("c", 2, 7)])
    ahead = os.path.getmtime(late) + 2
    os.utime(late, (ahead, ahead))
    fresh = landings.unread(lake, EP, root)
    assert [s.name for s in fresh] == ["", "day2", "day3"]
    read = read_pages(spark, [x for s in fresh for x in s.landings], schema="offset bigint, results array<struct<asset_id:string>>")
    assert sorted(os.path.basename(os.path.dirname(f)) + "/" + os.path.basename(f) for f in read.inputFiles()) == ["day2/p2.json", "day3/p1.json", "landing/loose.json"]
    assert load_daily(spark, lake, root, EP, now=D[4], ledger=True).records == 3
    assert sorted((r.asset_id, r.active_run_seconds) for r in lake.read("asset_utilizations_daily").collect()) == [("a", 10), ("a", 20), ("a", 30), ("b", 5), ("c", 7), ("d", 1)]
    assert landings.unread(lake, EP, root) == [] and landings.unread(lake, "another", root) != []
    assert [s.name for s in landings.unread(lake, "x", scratch + "/nowhere")] == []


SENT = ('{"offset": 0, "results": [{"b": {"z": 1.50, "a" : [1, 2 ]}, "n": 1, "f": 1.0, "s": "x\\n\\"q", "m": 1, "t": true, "big": 123456789012345678901, "a b`c": 1, "nul": null},'
        ' {"n": 2.5, "m": {"k":  " 1 \\\\"}}, null]}\n{"offset": 3, "results": []}\n')


def test_cells_keep_their_text_and_files_are_scanned_once(spark, scratch):
    os.makedirs(scratch + "/in")
    with open(scratch + "/in/p.json", "w") as f:
        f.write(SENT)
    got = read_pages(spark, scratch + "/in")
    assert dict(got.drop(SEQ).dtypes) == {"b": "string", "n": "double", "f": "double", "s": "string", "m": "string", "t": "boolean", "big": "double", "a b`c": "bigint", "nul": "string"}
    first, second, third = sorted(got.collect(), key=lambda r: r[SEQ])
    assert (first.b, first.m, second.m, second.n, first.s) == ('{"z":1.50,"a":[1,2]}', "1", '{"k":" 1 \\\\"}', 2.5, 'x\n"q')
    assert (third.n, third.b) == (None, None)
    # what is left to do is one scan of the staged lines, not of the landed files
    assert all("/records-" in f for f in got.inputFiles()) and got._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1
    known = read_known(spark, [Landing(scratch + "/in")], {f.name: f.dataType for f in got.drop(SEQ).schema}, as_text=["n"])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1
    assert sorted(known.collect(), key=lambda r: r[SEQ])[0].b == first.b and dict(known.dtypes)["n"] == "string"
    structs = read_pages(spark, scratch + "/in", structs=True)
    assert dict(structs.dtypes)["b"] == "struct<a:string,z:double>"


def test_types_of_variants():
    assert object_fields("OBJECT<`a b`: BIGINT, b: OBJECT<x: DECIMAL(2,1), `y, ``z`: ARRAY<VARIANT>>, c: VOID>") == [
        ("a b", "BIGINT"), ("b", "OBJECT<x: DECIMAL(2,1), `y, ``z`: ARRAY<VARIANT>>"), ("c", "VOID")]
    assert object_fields("OBJECT<>") == [] and object_fields("OBJECT<`a``b`: STRING>") == [("a`b", "STRING")]


def test_metrics_of_loads(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    _land(scratch + "/a", "p.json", [{"asset_id": "x"}, {"asset_id": "x"}])
    load_static(spark, lake, scratch + "/a", "assets", now=D[0])
    for i in (0, 1):                                                                # a null key matches nothing, so it comes twice
        _land(f"{scratch}/d{i}", "p.json", [_rec(None, 2, 1), _rec("a", 2, i)])
        load_daily(spark, lake, f"{scratch}/d{i}", EP, now=D[i + 1])
    got = sorted((r.endpoint_name, r.load_time, r.records, r.columns, r.table_rows, r.duplicates, r.warning) for r in lake.metrics().collect())
    assert got == [(EP, D[1], 2, 3, 2, 1, "1 duplicate keys in table"), (EP, D[2], 2, 3, 3, 2, "2 duplicate keys in table"), ("assets", D[0], 2, 1, 2, None, None)]
    assert lake.tables() == ["asset_utilizations_daily", "assets", "pipeline_last_run"]


def test_clustered_facts_join_without_an_exchange(spark, catalog_lake):
    rows = [(i % 7, D[i % 5], i) for i in range(200)]
    for name in ("l", "r"):
        catalog_lake.cluster(name, spark.createDataFrame(rows, "asset_id long, date timestamp, n long"), ["asset_id", "date"])
    catalog_lake.cluster("l", spark.createDataFrame(rows[:100], "asset_id long, date timestamp, n long"), ["asset_id", "date"])     # replaced
    by_name = CatalogTables(spark, catalog_lake.database)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = by_name["l"].join(by_name["r"].withColumnRenamed("n", "m"), ["asset_id", "date"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == sum(1 for a in rows[:100] for b in rows if a[:2] == b[:2])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
