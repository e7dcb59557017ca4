"""Sources (catalogue, listings), bulk validation and streaming landing."""

import json
import os
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from statlake.operators import bulk as B
from statlake.operators import query as q
from statlake.operators.dedupe import keep_last
from statlake.operators.publish import FactStore
from statlake.plans import datasets as D
from statlake.plans import service
from statlake.schema import STAT_SCHEMA
from statlake.sources.catalog import match_catalog, read_catalog, resource_urls
from statlake.sources.files import changed_sources, data_version, file_versions, list_files
from statlake.streaming.landing import import_landed
from tests.test_read_operators import ROWS


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame([r + ("seed", "run-1", None, "v1") for r in ROWS], STAT_SCHEMA)


def _catalog_file(tmp_path, wrapped):
    entries = [
        {"id": "a", "resources": [{"url": "https://x.example/data/pop.csv?x=1"}]},
        "not an object",
        {"id": "b", "resources": [{"url": " https://x.example/other/ "}, {"url": 5}]},
        {"id": "c", "resources": [{"url": "https://y.example/data/pop.csv"}]},
        {"id": "d"},
    ]
    doc = {"result": entries} if wrapped else entries
    p = tmp_path / ("wrapped.json" if wrapped else "plain.json")
    p.write_text(json.dumps(doc))
    return str(p)


@pytest.mark.parametrize("wrapped", [True, False])
def test_catalog_match_first_entry_wins(spark, tmp_path, wrapped):
    entries = read_catalog(spark, _catalog_file(tmp_path, wrapped))
    entries = entries.withColumn("id", F.get_json_object("entry", "$.id"))
    ids = [r["id"] for r in entries.orderBy("pos").collect()]
    assert ids == ["a", "b", "c", "d"]
    targets = spark.createDataFrame(
        [(1, "https://z.example/pop.csv"),        # file name -> entry a (first)
         (2, "https://x.example/other///"),       # normalised URL -> entry b
         (3, "https://x.example/none/"),          # file name 'none' -> no match
         (4, "https://x.example/dir/")],          # file name 'dir' -> no match
        "target_id long, url string")
    res = match_catalog(resource_urls(entries), targets)
    pos_to_id = {r["pos"]: r["id"] for r in entries.collect()}
    got = {r["target_id"]: pos_to_id.get(r["match_pos"]) for r in res.collect()}
    assert got == {1: "a", 2: "b", 3: None, 4: None}


def test_file_versions_and_changed_sources(spark, tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    (d / "a.csv").write_text("x\n1\n")
    (d / "b.csv").write_text("x\n22\n")
    versions = {os.path.basename(r["path"]): r["data_version"]
                for r in file_versions(spark, str(d)).collect()}
    assert versions["a.csv"].startswith("size:4;mtimeMs:")
    assert data_version(spark, str(d / "a.csv")) == versions["a.csv"]
    assert data_version(spark, str(d)).startswith("files:2;sha256:")
    manifest = list_files(spark, str(d))
    manifest = spark.createDataFrame(manifest.collect(), manifest.schema)
    time.sleep(0.01)
    (d / "b.csv").write_text("x\n333\n")
    (d / "c.csv").write_text("x\n4\n")
    changed = {os.path.basename(r["path"]): r["updated"]
               for r in changed_sources(list_files(spark, str(d)), manifest).collect()}
    assert changed == {"a.csv": False, "b.csv": True, "c.csv": True}


def _requests(spark, rows):
    return spark.createDataFrame(rows, B.REQUEST_SCHEMA)


def test_bulk_validation_order_and_fail_fast(spark, facts):
    reqs = _requests(spark, [
        (1, 2, "timeseries", "population", "district", ["Altstadt"], ["total"], 2023, 2022,
         None, 10, 0, None),
        (2, 1, "ranking", "population", "county", None, None, None, None, 2023, 5, None, "desc"),
        (3, 0, "timeseries", "households", "district", None, ["total", "x", "y"], None, None,
         None, 10, 0, None),
        (4, 3, "timeseries", "nope", "county", None, None, None, None, None, 10, 0, None),
        (5, 4, "capabilities", None, None, None, None, None, None, None, None, None, None),
    ])
    bad = {r["request_id"]: (r["field"], r["value"], r["allowed"])
           for r in B.invalid_requests(facts, reqs).collect()}
    assert bad[1] == ("range", "2023>2022", None)
    assert bad[2] == ("areaType", "county", ["district"])
    assert bad[3] == ("category", "x", ["single_person", "total"])
    assert bad[4][0] == "indicator" and bad[4][2] == ["households", "population"]
    assert 5 not in bad
    with pytest.raises(q.StatisticsValidationError, match="Unknown category: x"):
        B.assert_valid(facts, reqs)


def test_bulk_answers_in_request_order(spark, facts):
    reqs = _requests(spark, [
        (10, 0, "timeseries", "population", "district", ["Altstadt", "Wik"], None, None, None,
         None, 1, 1, None),
        (11, 1, "ranking", "households", "district", None, ["single_person"], None, None, 2023,
         2, None, "asc"),
        (12, 2, "timeseries", "population", "district", ["Nowhere"], None, None, None, None, 5,
         0, None),
        (13, 3, "capabilities", None, None, None, None, None, None, None, None, None, None),
    ])
    out = service.execute_bulk(facts, reqs)
    ts = sorted(tuple(r) for r in out["timeseries"].select(
        "request_id", "area", "year", "rn", "total").collect())
    assert ts == [(10, "Altstadt", 2023, 2, 2), (12, None, None, None, 0)]
    rk = [tuple(r) for r in out["ranking"].orderBy("rn").select("area", "value").collect()]
    assert rk == [("Wik", 420.0), ("Altstadt", 505.0)]
    cap = out["capabilities"].collect()
    assert len(cap) == 1 and cap[0]["years"] == [2022, 2023]


def test_service_rules(spark, facts):
    with pytest.raises(q.StatisticsValidationError, match="Unknown indicator: nope"):
        service.get_ranking(facts, "nope", "district", 2023)
    with pytest.raises(q.StatisticsValidationError, match="Unknown areaType"):
        service.list_years(facts, area_type="county")
    years, meta = service.list_years(facts, indicator="unknown-indicator")
    assert years.collect() == [] and meta.collect()[0]["total"] == 0
    with pytest.raises(q.StatisticsNotFoundError):
        service.get_indicator_meta(facts, "nope")


def test_normalize_lists(spark):
    df = spark.createDataFrame([(" b, a ,b",), ("a,,c",), ("x" * 201,)], "areas string")
    out = B.normalize_lists(df, "areas", 200).collect()
    assert out[0]["areas_list"] == ["b", "a"] and not out[0]["areas_has_empty"]
    assert out[1]["areas_has_empty"]
    assert out[2]["areas_too_long"]


def keep_last_sql_window(df, key, order):
    w = Window.partitionBy(*key).orderBy(F.col(order).desc())
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def test_keep_last_matches_window(spark):
    rows = [(k % 7, k % 3, k, float(k)) for k in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, ord int, v double")
    one = sorted(tuple(r) for r in keep_last(df, ["a", "b"], "ord").collect())
    two = sorted(tuple(r) for r in keep_last_sql_window(df, ["a", "b"], "ord").collect())
    assert one == two and len(one) == 21


def test_streaming_landing_imports_new_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store = FactStore(spark, str(tmp_path / "store"))
    (landing / "a.csv").write_text("Merkmal;Stadtteil;2022\nEinwohner insgesamt;Altstadt;1300\n")
    ckpt = str(tmp_path / "stream-ckpt")
    import_landed(spark, D.DISTRICTS_POPULATION, str(landing), store, ckpt,
                  available_now=True).awaitTermination(120)
    assert [r["value"] for r in store.facts().collect()] == [1300.0]
    # a second run sees only the new file
    (landing / "b.csv").write_text("Merkmal;Stadtteil;2022\nEinwohner insgesamt;Altstadt;1400\n")
    import_landed(spark, D.DISTRICTS_POPULATION, str(landing), store, ckpt,
                  available_now=True).awaitTermination(120)
    assert [r["value"] for r in store.facts().collect()] == [1400.0]
    assert store.runs().where(F.col("status") == "published").count() == 2
