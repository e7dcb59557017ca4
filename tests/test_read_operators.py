"""Read operators on a small literal fact table (exact rows)."""

import datetime as dt
import hashlib
import json

import pytest

from statlake.operators import query as q
from statlake.schema import STAT_SCHEMA

ROWS = [
    ("population", "district", "Altstadt", 2022, 1213.0, "persons", "total"),
    ("population", "district", "Altstadt", 2023, 1220.0, "persons", "total"),
    ("population", "district", "Gaarden-Ost", 2022, 17500.0, "persons", "total"),
    ("population", "district", "Gaarden-Ost", 2023, 18000.0, "persons", "total"),
    ("population", "district", "Schreventeich", 2023, 9000.0, "persons", "total"),
    ("households", "district", "Altstadt", 2023, 810.0, "households", "total"),
    ("households", "district", "Altstadt", 2023, 505.0, "households", "single_person"),
    ("households", "district", "Gaarden-Ost", 2023, 6050.0, "households", "total"),
    ("households", "district", "Gaarden-Ost", 2023, 3220.0, "households", "single_person"),
    ("households", "district", "Wik", 2023, 420.0, "households", "single_person"),
]
LOADED = dt.datetime(2024, 3, 1, 10, 30, 0)


@pytest.fixture(scope="module")
def facts(spark):
    rows = [r + ("seed", "run-1", LOADED, "v1" if r[0] == "population" else None)
            for r in ROWS]
    return spark.createDataFrame(rows, STAT_SCHEMA)


def vals(df):
    return [tuple(r) for r in df.collect()]


def test_timeseries_orders_by_area_year(facts):
    out = vals(q.timeseries(facts, "population", "district", ["Altstadt", "Gaarden-Ost"]))
    assert out == [("Altstadt", 2022, 1213.0, "persons", "total"),
                   ("Altstadt", 2023, 1220.0, "persons", "total"),
                   ("Gaarden-Ost", 2022, 17500.0, "persons", "total"),
                   ("Gaarden-Ost", 2023, 18000.0, "persons", "total")]


def test_timeseries_range_and_page(facts):
    out = vals(q.timeseries(facts, "population", "district", ["Altstadt", "Gaarden-Ost"],
                            year_from=2023, year_to=2023))
    assert [r[0] for r in out] == ["Altstadt", "Gaarden-Ost"]
    page = q.timeseries(facts, "population", "district", [], limit=2, offset=1)
    assert [(r[0], r[1]) for r in vals(page)] == [("Altstadt", 2023), ("Gaarden-Ost", 2022)]
    assert [r[0] for r in vals(q.page_areas(page))] == ["Altstadt", "Gaarden-Ost"]
    meta = vals(q.timeseries_meta(facts, "population", "district", [], limit=2, offset=1))
    assert meta == [(5, 2, 1, True)]
    meta = vals(q.timeseries_meta(facts, "population", "district", [], limit=2, offset=4))
    assert meta == [(5, 2, 4, False)]


def test_timeseries_unknown_area_is_empty(facts):
    assert vals(q.timeseries(facts, "population", "district", ["Nowhere"])) == []


def test_timeseries_mixed_categories_without_filter(facts):
    out = vals(q.timeseries(facts, "households", "district", ["Altstadt"]))
    assert [r[4] for r in out] == ["single_person", "total"]


def test_timeseries_rejects_inverted_range(facts):
    with pytest.raises(q.StatisticsValidationError):
        q.timeseries(facts, "population", "district", [], year_from=2023, year_to=2022)


def test_ranking_desc_asc_and_filters(facts):
    desc = vals(q.ranking(facts, "population", "district", 2023, categories=["total"], limit=2))
    assert desc == [("Gaarden-Ost", 18000.0, "persons", "total"),
                    ("Schreventeich", 9000.0, "persons", "total")]
    asc = vals(q.ranking(facts, "population", "district", 2023, limit=1, order="asc"))
    assert asc == [("Altstadt", 1220.0, "persons", "total")]
    areas = vals(q.ranking(facts, "households", "district", 2023, areas=["Wik", "Altstadt"]))
    assert [r[0] for r in areas] == ["Altstadt", "Altstadt", "Wik"]
    assert vals(q.ranking(facts, "population", "district", 1990)) == []
    with pytest.raises(q.StatisticsValidationError):
        q.ranking(facts, "population", "district", 2023, limit=101)


def test_list_areas_categories(facts):
    assert vals(q.list_areas(facts, "households", "district")) == [
        ("Altstadt",), ("Gaarden-Ost",), ("Wik",)]
    assert vals(q.list_areas(facts, "households", "district", category="total")) == [
        ("Altstadt",), ("Gaarden-Ost",)]
    assert vals(q.list_areas(facts, "population", "district", like="GAAR")) == [("Gaarden-Ost",)]
    # %, _ and \ are literal
    assert vals(q.list_areas(facts, "population", "district", like="%")) == []
    assert vals(q.list_categories(facts, "households", "district")) == [
        ("single_person",), ("total",)]


def test_list_years_and_meta(facts):
    assert vals(q.list_years(facts)) == [(2022,), (2023,)]
    assert vals(q.list_years(facts, indicator="households")) == [(2023,)]
    assert vals(q.list_years(facts, area="Schreventeich")) == [(2023,)]
    assert vals(q.years_meta(facts)) == [(2, 2, 0, False)]
    assert vals(q.list_years(facts, limit=1, offset=1)) == [(2023,)]
    assert vals(q.years_meta(facts, limit=1, offset=0)) == [(2, 1, 0, True)]


def test_list_indicators(facts):
    assert vals(q.list_indicators(facts)) == [("households",), ("population",)]
    assert vals(q.list_indicators(facts, area="Wik")) == [("households",)]
    assert vals(q.list_indicators(facts, year=2022)) == [("population",)]
    assert vals(q.indicators_meta(facts, limit=1)) == [(2, 1, 0, True)]
    assert vals(q.list_area_types(facts)) == [("district",)]


def test_year_and_indicator_meta(facts):
    ym = q.year_meta(facts, 2023).collect()
    assert len(ym) == 1 and ym[0]["area_type"] == "district"
    assert ym[0]["indicators"] == ["households", "population"]
    assert ym[0]["categories"] == ["single_person", "total"]
    assert ym[0]["areas"] == ["Altstadt", "Gaarden-Ost", "Schreventeich", "Wik"]
    im = q.indicator_meta(facts, "population").collect()[0]
    assert im["years"] == [2022, 2023]
    assert im["areas"] == ["Altstadt", "Gaarden-Ost", "Schreventeich"]
    with pytest.raises(q.StatisticsNotFoundError):
        q.require_rows(q.year_meta(facts, 1999), "Year not found: 1999")


def test_capabilities(facts):
    c = q.capabilities(facts).collect()[0]
    assert c["area_types"] == ["district"]
    assert c["indicators"] == ["households", "population"]
    assert c["years"] == [2022, 2023]
    assert (c["page_min"], c["page_max"], c["page_default"]) == (1, 500, 50)
    assert (c["ranking_min"], c["ranking_max"], c["ranking_default"]) == (1, 100, 50)
    assert c["bulk_max_items"] == 25


def test_freshness_fingerprint(facts):
    f = q.freshness(facts).collect()[0]
    assert f["row_count"] == 10
    assert f["last_updated_at"] == "2024-03-01T10:30:00.000Z"
    # NULL versions come last, as ''
    assert f["versions"] == ["v1", ""]
    expected = json.dumps({"rowCount": 10, "lastUpdatedAt": "2024-03-01T10:30:00.000Z",
                           "versions": ["v1", ""]}, separators=(",", ":"))
    assert f["fingerprint"] == expected
    assert f["data_version"] == hashlib.sha256(expected.encode()).hexdigest()


def test_freshness_of_empty_table(spark):
    f = q.freshness(spark.createDataFrame([], STAT_SCHEMA)).collect()[0]
    assert f["row_count"] == 0 and f["last_updated_at"] is None
    assert f["fingerprint"] == '{"rowCount":0,"lastUpdatedAt":null,"versions":[]}'


def test_pages_after_a_row_equal_pages_at_an_offset(spark):
    from statlake.plans.derived import stats
    s = stats(spark, "/root/testdata/sf0.001")
    pages, last = [], None
    while True:
        page = q.timeseries(s, "order_count", "customer", limit=400, last=last).collect()
        pages.append(page)
        if len(page) < 400:
            break
        last = (page[-1]["area"], page[-1]["year"], page[-1]["category"])
    assert len(pages) > 2
    for k, page in enumerate(pages):
        assert page == q.timeseries(s, "order_count", "customer", limit=400, offset=400 * k).collect()
