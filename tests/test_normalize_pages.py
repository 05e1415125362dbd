import datetime as dt
import decimal
import json
import os

from pyspark.sql import types as T

from fleetlake.config import EndpointConfig, endpoint_config
from fleetlake.operators.normalize import normalize
from fleetlake.sources.pages import SEQ, read_pages


def _write_pages(folder, pages):
    os.makedirs(folder, exist_ok=True)
    for i, p in enumerate(pages):
        with open(os.path.join(folder, f"page-{i:05d}.json"), "w") as f:
            f.write(json.dumps(p) + "\n")


def test_ragged_nested_pages(spark, scratch):
    landing = scratch + "/pages"
    _write_pages(landing, [
        {"offset": 0, "results": [
            {"asset_id": "a1", "date": "2025-01-02", "hours": "12.7", "ok": "Yes", "meta": {"x": 1}, "mixed": "plain"},
            {"asset_id": "a2", "date": "bad", "hours": "abc", "ok": "no", "meta": {"x": 2}, "mixed": {"o": 1},
             "tags": [1, 2], "always_null": None},
        ]},
        {"offset": 2, "results": [
            {"asset_id": "a3", "extra": 5, "tags": [], "always_null": None},
        ]},
    ])
    recs = read_pages(spark, landing)
    assert [r.asset_id for r in sorted(recs.collect(), key=lambda r: r[SEQ])] == ["a1", "a2", "a3"]
    cfg = EndpointConfig("x", "x", datetime_cols=("date", "missing_col"), long_int_cols=("hours",),
                         boolean_cols=("ok",))
    out = normalize(recs, cfg, keep=(SEQ,))
    types = dict(out.dtypes)
    assert types["date"] == "timestamp" and types["hours"] == "bigint" and types["ok"] == "boolean"
    assert types["meta"] == "string" and types["tags"] == "string" and types["always_null"] == "string"
    rows = {r.asset_id: r for r in out.collect()}
    assert rows["a1"].hours == 12 and rows["a1"].ok is True and rows["a1"].date == dt.datetime(2025, 1, 2)
    assert rows["a2"].hours is None and rows["a2"].date is None and rows["a2"].ok is False
    assert rows["a1"].meta == '{"x":1}'
    assert rows["a1"].mixed == "plain" and json.loads(rows["a2"].mixed) == {"o": 1}     # N1
    assert rows["a2"].tags == "[1,2]" and rows["a3"].tags == "[]"
    assert rows["a1"].always_null == ""                                                   # N2
    assert rows["a3"].extra == 5 and rows["a1"].extra is None                             # N0


def test_type_steps_and_double_after_long(spark):
    schema = T.StructType([
        T.StructField("asset_target_work_hours", T.StringType()),
        T.StructField("utilization_percentage", T.StringType()),
        T.StructField("bin", T.BinaryType()),
        T.StructField("dec", T.DecimalType(10, 2)),
        T.StructField("small", T.ShortType()),
        T.StructField("void", T.NullType()),
        T.StructField("cfg_all_null", T.StringType()),
    ])
    df = spark.createDataFrame([("7.9", "78.5", bytearray(b"hi"), decimal.Decimal("1.25"), 3, None, None)], schema)
    cfg = endpoint_config("asset-utilizations-daily")
    cfg = EndpointConfig(cfg.endpoint, cfg.table, datetime_cols=("cfg_all_null",),
                         long_int_cols=cfg.long_int_cols, daily=True)
    out = normalize(df, cfg)
    r = out.first()
    types = dict(out.dtypes)
    assert r.asset_target_work_hours == 7.0 and types["asset_target_work_hours"] == "double"   # N4 then N6
    assert r.utilization_percentage == 78.5
    assert r.bin == "aGk=" and r.dec == 1.25 and types["dec"] == "double"
    assert r.small == "3" and types["small"] == "string"                                         # N11
    assert r.void == ""                                                                          # N7
    assert r.cfg_all_null is None and types["cfg_all_null"] == "timestamp"                       # 2.2.1 h


def test_unknown_endpoint_gets_empty_config():
    cfg = endpoint_config("no-such-endpoint")
    assert cfg.merge_key is None and not cfg.datetime_cols and cfg.table == "no_such_endpoint"


def test_renamed_org_history_columns(spark):
    df = spark.createDataFrame([("a", "2025-01-01", None)], "asset_id string, `from` string, `to` string")
    out = normalize(df, endpoint_config("asset-organization-history"), blank_all_null=False)
    assert out.columns == ["asset_id", "from_date", "to_date"]
    assert dict(out.dtypes)["to_date"] == "timestamp"


def test_landed_pages_and_staged_records_are_compressed(spark, scratch):
    """Each record repeats its keys, and staged its folder and file: far fewer bytes are written than the text has."""
    import glob
    import os

    from pyspark.sql import functions as F

    from fleetlake.sources.pages import land_pages, read_pages
    from fleetlake.sources.tables import Lake

    rows = spark.range(20_000).select(F.col("id").alias("seq"), F.col("id").alias("asset_site_history_id"), (F.col("id") % 7).alias("site"), F.lit("Pit").alias("name"))
    land_pages(rows, f"{scratch}/landing", "seq")
    lake = Lake(spark, f"{scratch}/lake")
    got = read_pages(spark, f"{scratch}/landing", stage=lake.stage_lines)
    assert sorted(tuple(r) for r in got.select("asset_site_history_id", "site", "name").collect()) == [(i, i % 7, "Pit") for i in range(20_000)]
    for files in (f"{scratch}/landing/part-*", f"{scratch}/lake/_staging/*/part-*"):
        assert 0 < sum(os.path.getsize(f) for f in glob.glob(files)) < 20_000 * 20


def test_records_of_a_page_keep_their_order(spark, scratch):
    """Records of one place are ordered by their text, NULL fields left out, as before the text was made behind the shuffle."""
    import json

    from fleetlake.sources.pages import land_pages

    land_pages(spark.createDataFrame([(1, "b", 2), (0, "z", None), (1, "a", 9), (105, None, 1)], "seq bigint, k string, n int"), f"{scratch}/pages", "seq")
    pages = sorted((json.loads(r.value) for r in spark.read.text(f"{scratch}/pages").collect()), key=lambda p: p["offset"])
    assert pages == [{"offset": 0, "results": [{"k": "z"}, {"k": "a", "n": 9}, {"k": "b", "n": 2}]}, {"offset": 100, "results": [{"n": 1}]}]
