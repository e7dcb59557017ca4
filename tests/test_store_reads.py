"""Reads of a store from its summaries: lists, metadata, deep pages, bulk."""

import pytest
from pyspark.sql import functions as F

from statlake.operators import deep_page
from statlake.operators import query as q
from statlake.operators.bulk import REQUEST_SCHEMA
from statlake.operators.publish import FactStore
from statlake.operators.reshape import RunContext
from statlake.plans import service
from statlake.plans.service import StoreService


def facts(spark, areas=2000, years=(2000, 2001, 2002), categories=("total", "x y"), indicator="population", plus=0):
    """Areas with a year left out here and there."""
    rows = spark.range(areas).select(F.format_string("area %05d", "id").alias("area_name"), "id")
    rows = rows.withColumn("year", F.explode(F.array(*[F.lit(y) for y in years])))
    rows = rows.withColumn("category", F.explode(F.array(*[F.lit(c) for c in categories])))
    return rows.where("(id + year) % 7 != 0").select(
        F.lit(indicator).alias("indicator"), F.lit("district").alias("area_type"), "area_name", "year",
        (F.col("id") + plus).cast("double").alias("value"), F.lit("u").alias("unit"), "category",
        F.lit("s").alias("source_dataset"), F.lit(None).cast("timestamp").alias("loaded_at"), F.lit("v").alias("data_version"))


@pytest.fixture(scope="module")
def opened(spark, tmp_path_factory):
    """A store whose scopes lie in several files each."""
    store = FactStore(spark, str(tmp_path_factory.mktemp("s") / "store"))
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    store.commit(facts(spark), RunContext("a", "v1"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    store.commit(facts(spark, areas=30, indicator="households", categories=("total", "gone")), RunContext("b", "v2"))
    store.commit(facts(spark, areas=10, indicator="households", categories=("gone",), years=(2005,)), RunContext("c", "v3"),
                 [("households", "district", "gone")])
    return StoreService(store)


def reads_facts(df):
    return any("/facts/" in f for f in df.inputFiles())


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("filters", [
    {}, {"indicator": "households"}, {"area_type": "district", "category": "gone"}, {"area": "area 00003"},
    {"indicator": "population", "area": "area 00005", "category": "total"}, {"indicator": "none"}, {"limit": 2, "offset": 1}])
def test_years(opened, filters):
    years, meta = opened.list_years(**filters)
    expected = q.list_years(opened.facts, **filters), q.years_meta(opened.facts, **filters)
    assert [collected(x) for x in (years, meta)] == [collected(x) for x in expected]
    assert not reads_facts(years) and not reads_facts(meta) and reads_facts(opened.facts)


@pytest.mark.parametrize("filters", [{"year": 2005}, {"area": "area 00020"}, {"area": "area 00003", "year": 2005}, {}])
def test_indicators(opened, filters):
    found, meta = opened.list_indicators(**filters)
    assert collected(found) == collected(q.list_indicators(opened.facts, **filters))
    assert collected(meta) == collected(q.indicators_meta(opened.facts, **filters)) and not reads_facts(found)


def test_metadata(opened):
    for mine, whole in ((opened.get_year_meta(2005), q.year_meta(opened.facts, 2005)),
                        (opened.get_year_meta_long(2001), q.year_meta_long(opened.facts, 2001)),
                        (opened.get_indicator_meta("households"), q.indicator_meta(opened.facts, "households")),
                        (opened.get_indicator_meta_long("population"), q.indicator_meta_long(opened.facts, "population")),
                        (opened.capabilities(), q.capabilities(opened.facts))):
        assert collected(mine) == collected(whole) and not reads_facts(mine)
    with pytest.raises(q.StatisticsNotFoundError, match="1850"):
        opened.get_year_meta(1850)
    with pytest.raises(q.StatisticsNotFoundError, match="none"):
        opened.get_indicator_meta("none")


def test_area_lists(opened):
    for like in (None, "000", "%", "AREA 0000"):
        mine = opened.list_areas("population", "district", "x y", like)
        assert collected(mine) == collected(q.list_areas(opened.facts, "population", "district", "x y", like))
        assert not reads_facts(mine)


@pytest.mark.parametrize("offset", [501, 1000, 2571, 5142, 9000, 10280, 10285, 20000])
@pytest.mark.parametrize("filters", [{}, {"categories": ["x y"], "year_from": 2001}, {"year_to": 2000}])
def test_deep_pages(opened, offset, filters):
    page, meta, _ = opened.get_timeseries("population", "district", [], limit=40, offset=offset, **filters)
    whole = q.timeseries(opened.facts, "population", "district", [], limit=40, offset=offset, **filters)
    assert [tuple(r) for r in page.collect()] == [tuple(r) for r in whole.collect()]
    assert meta.first() == q.timeseries_meta(opened.facts, "population", "district", [], limit=40, offset=offset, **filters).first()


def test_deep_pages_read_the_files_of_their_areas_only(opened):
    total = opened.get_timeseries("population", "district", [])[1].first()["total"]
    everything = len(opened.facts.where("indicator = 'population'").inputFiles())
    read = []
    for share in (0.1, 0.5, 0.9):
        rows, skipped = deep_page.covering(opened.store, opened.directory, "population", "district", None, None, None, 20,
                                           int(total * share))
        read.append(len(rows.inputFiles()))
        assert 0 <= int(total * share) - skipped < total / 3
    assert everything >= 20 and max(read) <= 12 and max(read) - min(read) <= 6


def test_area_range():
    entries = [{"first_area": a, "last_area": b, "rows": n} for a, b, n in (("a", "c", 10), ("d", "f", 10), ("g", "i", 10))]
    assert deep_page.area_range(entries, 0, 5) == ("a", "d")
    assert deep_page.area_range(entries, 9, 1) == ("a", "d")
    assert deep_page.area_range(entries, 9, 2) == ("a", "g")
    assert deep_page.area_range(entries, 10, 5) == ("d", "g")
    assert deep_page.area_range(entries, 25, 5) == ("g", None)
    assert deep_page.area_range([], 3, 5) == (None, None)


def test_bulk(opened, spark):
    rows = [(1, 2, "timeseries", "population", "district", None, ["total"], 2001, None, None, 7, 3000, None),
            (2, 1, "timeseries", "households", "district", ["area 00003", "area 00004"], None, None, 2001, None, None, None, None),
            (3, 0, "timeseries", "population", "district", ["nowhere"], None, None, None, None, 5, 0, None),
            (4, 5, "timeseries", "population", "district", None, None, None, None, None, 5, 99_999, None),
            (5, 4, "ranking", "population", "district", None, ["x y"], None, None, 2001, 3, None, "asc"),
            (6, 3, "ranking", "population", "district", None, None, None, None, 2002, None, None, None),
            (7, 6, "capabilities", None, None, None, None, None, None, None, None, None, None)]
    requests = spark.createDataFrame(rows, REQUEST_SCHEMA)
    mine, whole = opened.execute_bulk(requests), service.execute_bulk(opened.facts, requests)
    for kind in whole:
        assert collected(mine[kind]) == collected(whole[kind]), kind
    for r in rows[:4]:
        single = q.timeseries(opened.facts, *r[3:6], r[6], r[7], r[8], r[10] or 50, r[11] or 0)
        got = sorted((x for x in mine["timeseries"].collect() if x["request_id"] == r[0] and x["rn"]), key=lambda x: x["rn"])
        assert [(x["area"], x["year"], x["value"]) for x in got] == [(x["area"], x["year"], x["value"]) for x in single.collect()]


@pytest.mark.parametrize("bad,field", [
    ({"indicator": "none"}, "indicator"), ({"area_type": "none"}, "areaType"), ({"categories": ["total", "no", "nope"]}, "category"),
    ({"year_from": 2002, "year_to": 2001}, "range"), ({"indicator": None}, "indicator")])
def test_fetched_names_check_like_the_jobs(opened, spark, bad, field, monkeypatch):
    from statlake.operators import bulk
    item = dict(zip(REQUEST_SCHEMA.fieldNames(), (5, 3, "timeseries", "population", "district", None, ["total"], None, None,
                                                  None, 5, 0, None))) | bad
    fine = (6, 1, "ranking", "population", "district", None, None, None, None, 2001, 5, None, None)
    requests = spark.createDataFrame([tuple(item.values()), fine], REQUEST_SCHEMA)
    errors = []
    for check in (lambda: opened.names.check(requests.collect()), lambda: bulk.assert_valid(opened.scopes, requests)):
        with pytest.raises(q.StatisticsValidationError) as e:
            check()
        errors.append((str(e.value), e.value.details))
    assert errors[0] == errors[1] and errors[0][1]["field"] == field


def test_a_store_with_very_many_scopes_validates_by_jobs(opened, monkeypatch):
    monkeypatch.setattr(service, "NAMES_MOST", 2)
    again = StoreService(opened.store)
    assert again.names is None
    with pytest.raises(q.StatisticsValidationError, match="Unknown category: no"):
        again.get_ranking("population", "district", 2001, categories=["no"])
    assert collected(again.list_years(area="area 00003")[0]) == collected(opened.list_years(area="area 00003")[0])


def test_name_index(opened, spark):
    assert opened.name_index is None and opened.store.index_names() == 3 and opened.store.index_names() == 0
    s = StoreService(opened.store)
    for like in ("area 0001", "REA 0", "%re", "\\\\a", "a_0", "00", "", None, "x" * 50, "area 00003"):
        for indicator, category in (("population", "total"), ("households", None)):
            mine = s.list_areas(indicator, "district", category, like)
            assert [r[0] for r in mine.collect()] == [r[0] for r in q.list_areas(opened.facts, indicator, "district", category,
                                                                               like).collect()]
            if like and len(like) >= 3:
                assert all("/names/" in f for f in mine.inputFiles())
    opened.store.commit(facts(spark, areas=3, indicator="more"), RunContext("d", "v4"))
    assert StoreService(opened.store).name_index is None     # until the next maintenance


def test_summaries_of_areas_group_by_hashing_in_tasks_of_known_size(spark, tmp_path, monkeypatch):
    """Years of areas need no sort of a task's rows; every valid year keeps its place, equal
    keys are still found, and a caller's number of ranges is kept."""
    from statlake.operators import publish
    rows = [("population", "district", f"area {a:03}", y, 1.0, "persons", "total", None, None, None, None)
            for a in range(20) for y in (1900, 1963, 1964, 1999 + a % 3, 2027, 2028, 2091, 2092, 2100)]
    df = spark.createDataFrame(rows, publish.STAT_SCHEMA)
    plan = publish.by_area(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    monkeypatch.setattr(publish, "FACTS_PER_TASK", 10)
    store, run = publish.FactStore(spark, str(tmp_path / "store")), RunContext("d", "v1")
    assert store.commit(df, run, tasks=7) == len(rows)
    areas = store.dimensions()
    for r in areas.collect():
        assert list(r["years"]) == sorted(x[3] for x in rows if x[2] == r["area_name"]) and r["rows"] == 9
    assert areas.count() == 20 and len(areas.inputFiles()) > 8
    assert 3 < len(store.snapshot().inputFiles()) <= 7
    with pytest.raises(publish.DatasetImportError, match="'duplicate_keys': 2"):
        store.commit(spark.createDataFrame(rows + rows[4:6], publish.STAT_SCHEMA), RunContext("d", "v2"))


def test_name_index_holds_a_name_once(spark, tmp_path, monkeypatch):
    """Names are indexed once per run and area type, not once per category, in tasks of bounded
    size; of a run whose categories were replaced in part, the others stay."""
    from statlake.operators import publish
    monkeypatch.setattr(publish, "AREAS_PER_TASK", 2)
    rows = [("population", "district", f"area {a:03}", 2001, 1.0, "persons", c, None, None, None, None)
            for a in range(20) for c in ("total", "part", "rest")]
    store = publish.FactStore(spark, str(tmp_path / "store"))
    first, second = RunContext("d", "v1"), RunContext("d", "v2")
    store.commit(spark.createDataFrame(rows, publish.STAT_SCHEMA), first)
    assert store.index_names() == 1
    index = spark.read.parquet(store.names_path)
    n = index.where("trigram = 'rea'").groupBy("area_name").count().collect()
    assert len(n) == 20 and {r["count"] for r in n} == {1}
    assert len(index.where("trigram = 'rea'").select(F.input_file_name()).distinct().collect()) > 2   # of more than one task
    part = [(*r[:4], 2.0, *r[5:]) for r in rows if r[6] == "part" and r[2] < "area 005"]
    store.commit(spark.createDataFrame(part, publish.STAT_SCHEMA), second, [("population", "district", "part")])
    assert store.index_names() == 1
    s = StoreService(store)
    for category, names in ((None, 20), ("total", 20), ("part", 5)):
        assert [r[0] for r in s.list_areas("population", "district", category, "REA 0").collect()] == [
            f"area {a:03}" for a in range(names)]


def test_trigrams(spark):
    from statlake.operators.publish import trigrams
    rows = spark.createDataFrame([("abcab",), ("ab",), ("",), ("äöüß",), (None,)], "t string").select(trigrams(F.col("t")).alias("x"))
    assert [r["x"] for r in rows.collect()] == [["abc", "bca", "cab"], [], [], ["äöü", "öüß"], []]
