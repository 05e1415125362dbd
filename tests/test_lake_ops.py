"""Sources, sinks and the remaining row operators: N14 flatten, I6 exact-row dedup, multi-line pages,
S3 catalog tables, S8 control init, S10 drop and reload, S11 persist, S12 observed load metrics."""

import datetime as dt
import json
import os


from fleetlake.config import EndpointConfig
from fleetlake.operators.normalize import normalize
from fleetlake.sources.pages import SEQ, read_pages
from fleetlake.sources.tables import CONTROL_TABLE, CatalogTables, Lake, write_with_metrics


def test_flatten_struct_columns(spark):
    df = spark.createDataFrame([("a1", ("CAT", 320), [1, 2])],
                               "asset_id string, specs struct<make:string,hp:int>, tags array<int>")
    cfg = EndpointConfig("x", "x", long_int_cols=("specs_hp",))
    out = normalize(df, cfg, flatten_structs=True)
    assert out.columns == ["asset_id", "specs_make", "specs_hp", "tags"]
    r = out.first()
    assert (r.specs_make, r.specs_hp, r.tags) == ("CAT", 320, "[1,2]")
    assert dict(out.dtypes)["specs_hp"] == "bigint"
    # default (N8): the struct stays one column of JSON text
    assert normalize(df, cfg).first().specs == '{"make":"CAT","hp":320}'


def test_multi_line_pages(spark, scratch):
    folder = scratch + "/pretty"
    os.makedirs(folder)
    for off, recs in ((0, [{"asset_id": "a", "n": 1}, {"asset_id": "b"}]), (2, [{"asset_id": "c", "n": 3}])):
        with open(os.path.join(folder, f"page-{off}.json"), "w") as f:
            json.dump({"offset": off, "results": recs}, f, indent=2)
    got = [(r.asset_id, r.n) for r in sorted(read_pages(spark, folder, multi_line=True).collect(), key=lambda r: r[SEQ])]
    assert got == [("a", 1), ("b", None), ("c", 3)]


def test_a_failed_refresh_leaves_the_old_table(spark, scratch):
    import pytest

    lake = Lake(spark, scratch + "/lake")
    lake.overwrite("t", spark.range(4))
    with pytest.raises(Exception):
        lake.overwrite("t", spark.range(9).selectExpr("CASE WHEN id = 8 THEN raise_error('lost') ELSE id END AS id"))
    assert lake.read("t").count() == 4
    lake.overwrite("t", spark.range(5).selectExpr("id", "1 AS n"))
    assert lake.read("t").columns == ["id", "n"] and lake.read("t").count() == 5


def test_catalog_tables_mapping(spark):
    spark.range(3).createOrReplaceTempView("fl_probe_view")
    try:
        t = CatalogTables(spark)
        assert t["fl_probe_view"].count() == 3
        assert "fl_probe_view" in list(t)
        try:
            t["fl_no_such_table"]
            raise AssertionError("missing table must raise KeyError")
        except KeyError:
            pass
    finally:
        spark.catalog.dropTempView("fl_probe_view")


def test_control_init_drop_reload_metrics(spark, scratch):
    lake = Lake(spark, scratch + "/lake")
    assert lake.init_control("p", dt.datetime(2025, 1, 1)) is True
    assert lake.init_control("p", dt.datetime(2025, 1, 2)) is False           # exists: left as it is
    c = lake.read(CONTROL_TABLE).collect()
    assert len(c) == 1 and c[0].status == "initialized"

    df = spark.range(10).selectExpr("id AS asset_id", "id % 3 AS bucket")
    m = write_with_metrics(df, lambda d: lake.overwrite("t", d))              # S12: same pass as the write
    assert m == {"rows": 10, "columns": 2}
    assert lake.exists("t") and "t" in lake.tables()
    lake.drop("t")                                                            # S10
    assert not lake.exists("t") and lake.tables() == [CONTROL_TABLE]
    lake.overwrite("t", df.where("bucket = 0"))                               # reload
    assert lake.read("t").count() == 4


def test_register_views_for_sql(spark):
    from fleetlake.plans.queries import ROW_COUNT_TABLES
    from fleetlake.plans.views import TestDataFleet
    from fleetlake.sources.tables import register_views

    fleet = TestDataFleet(spark, "/root/testdata/sf0.001")
    assert register_views(fleet, ROW_COUNT_TABLES) == list(ROW_COUNT_TABLES)
    try:
        got = spark.sql("""SELECT a.status, COUNT(DISTINCT a.asset_id) AS n
                           FROM assets a JOIN asset_site_history h ON a.asset_id = h.asset_id
                           GROUP BY a.status""").collect()
        assert sum(r.n for r in got) == fleet["asset_site_history"].select("asset_id").distinct().count()
    finally:
        for n in ROW_COUNT_TABLES:
            spark.catalog.dropTempView(n)


def test_tables_found_without_success_markers(spark, scratch):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    old = conf.get(key)
    conf.set(key, "false")
    try:
        lake = Lake(spark, scratch + "/lake")
        lake.overwrite("t", spark.range(3))
        assert not os.path.exists(lake.path("t") + "/_SUCCESS")
        assert lake.exists("t") and lake.tables() == ["t"] and not lake.exists("missing")
    finally:
        if old is None:
            conf.unset(key)
        else:
            conf.set(key, old)
