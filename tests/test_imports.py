"""Golden imports of wide CSV inputs through the whole pipeline.

Every successful import runs twice and must give the same published rows.
"""

import datetime as dt
import re
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from statlake.operators.publish import FactStore
from statlake.operators.reshape import DatasetImportError
from statlake.plans import datasets as D
from statlake.plans.importer import import_dataset, import_many
from statlake.plans.spec import SpecError
from statlake.sources.csv import CsvImportError


@pytest.fixture
def store(spark, tmp_path):
    return FactStore(spark, str(tmp_path / "store"))


def published(store, indicator=None):
    df = store.facts()
    if isinstance(indicator, str):
        df = df.where(F.col("indicator") == indicator)
    elif indicator:
        df = df.where(F.col("indicator").isin(list(indicator)))
    return sorted((r.area_name, r.year, r.category, r.value)
                  for r in df.select("area_name", "year", "category", "value").collect())


def twice(spark, spec, path, store):
    mine = {i for i, _u, _c in spec.planned_categories()}
    r1 = import_dataset(spark, spec, path, store)
    first = published(store, mine)
    r2 = import_dataset(spark, spec, path, store)
    assert published(store, mine) == first
    assert r1.imported == r2.imported
    return first


def value(rows, area, year, category="total"):
    hits = [v for a, y, c, v in rows if a == area and y == year and c == category]
    assert len(hits) == 1, (area, year, category, rows)
    return hits[0]


# ------------------------------------------------------------- years as columns

def test_population_years(spark, write_csv, store):
    path = write_csv(["Merkmal;Stadtteil;2022;2023",
                      "Einwohner insgesamt;Altstadt;1300;1310",
                      "Einwohner insgesamt;Ellerbek;5000;5100",
                      "Sonstiges;Altstadt;1;2"])
    rows = twice(spark, D.DISTRICTS_POPULATION, path, store)
    assert rows == [("Altstadt", 2022, "total", 1300.0), ("Altstadt", 2023, "total", 1310.0),
                    ("Ellerbek", 2022, "total", 5000.0), ("Ellerbek", 2023, "total", 5100.0)]


def test_spaced_header_is_trimmed(spark, write_csv, store):
    path = write_csv([" Merkmal ; Stadtteil ;2022", "Einwohner insgesamt;Altstadt;1300"])
    assert twice(spark, D.DISTRICTS_POPULATION, path, store) == [("Altstadt", 2022, "total",
                                                                   1300.0)]


def test_missing_required_columns(spark, write_csv, store):
    path = write_csv(["Name;2022;2023", "Altstadt;1;2"])
    with pytest.raises(DatasetImportError, match="no column for: feature .Merkmal.; area .Stadtteil."):
        import_dataset(spark, D.DISTRICTS_POPULATION, path, store)


def test_no_year_columns(spark, write_csv, store):
    path = write_csv(["Merkmal;Stadtteil;foo;bar", "Einwohner insgesamt;Altstadt;1;2"])
    with pytest.raises(DatasetImportError, match="no column name matches"):
        import_dataset(spark, D.DISTRICTS_POPULATION, path, store)


def test_comma_delimiter_and_bad_delimiter(spark, write_csv, store):
    path = write_csv(["Merkmal,Stadtteil,2022,2023", "Einwohner insgesamt,Altstadt,1300,1310",
                      "Einwohner insgesamt,Wik,700,710"])
    spec = replace(D.DISTRICTS_POPULATION, delimiter=",")
    assert len(twice(spark, spec, path, store)) == 4
    with pytest.raises(SpecError, match="must be one character"):
        replace(D.DISTRICTS_POPULATION, delimiter=";;")


def test_foreign_count_trims_areas(spark, write_csv, store):
    path = write_csv(["Kategorie;Merkmal;Stadtteilnummer;Stadtteil;2022;2023",
                      "Bev;Auslaender;1; Altstadt ;200;215",
                      "Bev;Auslaender;2;Vorstadt  ;90;95"])
    rows = twice(spark, D.DISTRICTS_FOREIGN_COUNT, path, store)
    assert value(rows, "Altstadt", 2023) == 215.0
    assert {a for a, *_ in rows} == {"Altstadt", "Vorstadt"}


def test_date_headers_and_decimal_comma(spark, write_csv, store):
    head = "Land;Stadt;Kategorie;Merkmal;Stadtteilnummer;Stadtteil;31.12.2023;31.12.2022"
    path = write_csv([head, "sh;City;arbeit;Arbeitslose;1;Altstadt;17;15",
                      "sh;City;arbeit;Arbeitslose;2;Wik;30;31"])
    rows = twice(spark, D.DISTRICTS_UNEMPLOYED_COUNT, path, store)
    assert value(rows, "Altstadt", 2023) == 17.0 and value(rows, "Altstadt", 2022) == 15.0
    head2 = "Land;Stadt;Kategorie;Merkmal;Stadtteilnummer;Stadtteil;31.12.2019;31.12.2018"
    path2 = write_csv([head2, "sh;City;arbeit;Betroffenheitsquote;1;Altstadt;1,7;2,05",
                       "sh;City;arbeit;Betroffenheitsquote;2;Wik;3,0;x"])
    rows2 = twice(spark, D.DISTRICTS_UNEMPLOYED_RATE, path2, store)
    assert value(rows2, "Altstadt", 2019) == pytest.approx(1.7)
    assert value(rows2, "Altstadt", 2018) == pytest.approx(2.05)
    assert [r for r in rows2 if r[0] == "Wik"] == [("Wik", 2019, "total", 3.0)]


def test_duplicate_year_header_later_wins(spark, write_csv, store):
    head = "Land;Stadt;Kategorie;Merkmal;Ortsteilnummer;Ortsteil;2022;2022;2023"
    path = write_csv([head,
                      "sh;City;Bev;Einwohner insgesamt;1;Schilksee ;4800;4811;4900",
                      "sh;City;Bev;Einwohner insgesamt;2;Pries;9700;;9800"])
    rows = twice(spark, D.SUBDISTRICTS_POPULATION, path, store)
    assert value(rows, "Schilksee", 2022) == 4811.0
    # an empty later copy does not hide the earlier value
    assert value(rows, "Pries", 2022) == 9700.0
    assert value(rows, "Pries", 2023) == 9800.0


def test_quoted_multiline_header_and_thousands_dot(spark, write_csv, store):
    path = write_csv(['Land;Stadt;Kategorie;"PLZ-', 'Bereich";Merkmal;2000;2023',
                      "sh;City;Bev; 24103 ;Jahr;10.141;12.333",
                      "sh;City;Bev;24105;Jahr;19.460;20.815",
                      "sh;City;Bev;24106;Jahr"])
    rows = twice(spark, D.POSTAL_CODES_POPULATION, path, store)
    assert value(rows, "24103", 2000) == 10141.0
    assert value(rows, "24105", 2000) == 19460.0  # trailing zero kept: text, not double
    assert value(rows, "24105", 2023) == 20815.0
    assert {a for a, *_ in rows} == {"24103", "24105"}  # short row padded with NULL


# ------------------------------------------------------- categories as columns

GENDER_HEAD = ("Land;Stadt;Kategorie;Merkmal;Datum;Stadtteilnummer;Stadtteil;"
               "insgesamt;maennlich;weiblich")


def test_gender_categories(spark, write_csv, store):
    path = write_csv([GENDER_HEAD,
                      "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;1300;650;650",
                      "sh;City;Bev;Einwohner insgesamt;2022_12_31;1;Altstadt;1290;640;650",
                      "sh;City;Bev;Andere;2022_12_31;1;Altstadt;1;1;1"])
    rows = twice(spark, D.DISTRICTS_GENDER, path, store)
    assert len(rows) == 6
    assert value(rows, "Altstadt", 2022, "male") == 640.0


def test_keep_last_of_three(spark, write_csv, store):
    path = write_csv([GENDER_HEAD,
                      "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;100;10;90",
                      "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;200;20;180",
                      "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;300;30;270"])
    rows = twice(spark, D.DISTRICTS_GENDER, path, store)
    assert rows == [("Altstadt", 2023, "female", 270.0), ("Altstadt", 2023, "male", 30.0),
                    ("Altstadt", 2023, "total", 300.0)]


def test_keep_last_per_category_falls_back(spark, write_csv, store):
    path = write_csv([GENDER_HEAD,
                      "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;100;10;90",
                      "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;200;;180"])
    rows = twice(spark, D.DISTRICTS_GENDER, path, store)
    assert value(rows, "Altstadt", 2023, "male") == 10.0
    assert value(rows, "Altstadt", 2023, "total") == 200.0


def test_households_computed_total(spark, write_csv, store):
    head = ("Land;Stadt;Kategorie;Jahr;Stadtteile;Merkmal;Einpersonen;Paar ohne Kind;"
            "Paar mit Kindern;Paar mit Nachkommen;Alleinerziehende;Sonst. Mehrpersonenhaushalte")
    path = write_csv([head, "sh;City;Bev;31.12.2022;Altstadt;Haushalte;400;100;30;5;10;20",
                      "sh;City;Bev;31.12.2023;Altstadt;Haushalte;410;;31;6;11;21"])
    rows = twice(spark, D.DISTRICTS_HOUSEHOLDS_TYPE_SIZE, path, store)
    assert value(rows, "Altstadt", 2022) == 565.0
    assert value(rows, "Altstadt", 2023) == 479.0
    assert len(rows) == 7 + 6


def test_marital_status_without_filter(spark, write_csv, store):
    head = "Land;Stadt;Kategorie;Stadtteil;Jahr;ledig;verheiratet;verwitwet;geschieden"
    path = write_csv([head, "sh;City;Bev;Altstadt;31_12_2022;600;400;50;70",
                      "sh;City;Bev;Wik;31_12_2022;300;200;20;30"])
    rows = twice(spark, D.DISTRICTS_MARITAL_STATUS, path, store)
    assert len(rows) == 10
    assert value(rows, "Wik", 2022) == 550.0


def test_migrant_gender_latin1_fallback(spark, write_csv, store):
    head = ("Land;Stadt;Kategorie;Merkmal;Datum;Stadtteilnummer;Stadtteil;"
            "insgesamt;männlich;weiblich")
    path = write_csv([head,
                      "sh;City;Bev;Einwohner mit Migrationshintergrund;2023_12_31;1;Altstadt ;"
                      "370;180;190"], encoding="latin-1")
    rows = twice(spark, D.DISTRICTS_MIGRANT_GENDER, path, store)
    assert value(rows, "Altstadt", 2023, "male") == 180.0
    assert value(rows, "Altstadt", 2023) == 370.0


def test_nationalities_lenient_empty_is_zero(spark, write_csv, store):
    head = "Land;Stadt;Kategorie;Jahr;Stadtteil;Tuerkei;Polen;Irak;Russland;Ukraine;Syrien;Bulgarien"
    path = write_csv([head, "sh;City;Bev;2023; Altstadt ;5;;2;x;1;;3"])
    rows = twice(spark, D.DISTRICTS_FOREIGN_NATIONALITIES_SELECTED, path, store)
    assert len(rows) == 8
    assert value(rows, "Altstadt", 2023, "poland") == 0.0
    assert value(rows, "Altstadt", 2023, "russia") == 0.0
    assert value(rows, "Altstadt", 2023) == 11.0


def test_foreign_age_groups_lenient(spark, write_csv, store):
    bands = [c for c, _ in D.DISTRICT_AGES]
    head = "Land;Stadt;Kategorie;Merkmal;Datum;Stadtteilnummer;Stadtteil;" + ";".join(bands)
    cells = ["1"] * len(bands)
    cells[3] = ""
    path = write_csv([head, "sh;City;Bev;Einwohner nach Altersgruppen;31.12.2023;1; Wik;"
                      + ";".join(cells)])
    rows = twice(spark, D.DISTRICTS_FOREIGN_AGE_GROUPS, path, store)
    assert len(rows) == 21
    assert value(rows, "Wik", 2023) == float(len(bands) - 1)
    assert value(rows, "Wik", 2023, "age_10_11") == 0.0


def test_subdistrict_age_groups_strict_total(spark, write_csv, store):
    bands = [c for c, _ in D.SUBDISTRICT_AGES]
    assert bands[0] == "0-<5" and bands[-1] == "85 und Aelter"
    head = "Land;Stadt;Kategorie;Merkmal;Datum;Ortsteilnummer;Ortsteil;" + ";".join(bands)
    row = "sh;City;Bev;Einwohner nach Altersgruppen;31.12.2023;1;Wik ;"
    path = write_csv([head, row + ";".join(["2"] * len(bands)),
                      row + ";".join(["3"] * len(bands))])
    rows = twice(spark, D.SUBDISTRICTS_AGE_GROUPS, path,
                 store)
    assert value(rows, "Wik", 2023) == 3.0 * len(bands)
    assert value(rows, "Wik", 2023, "age_85_plus") == 3.0


def test_area_hectares_decimal_comma(spark, write_csv, store):
    head = "Land;Stadt;Kategorie;Merkmal;Jahr;Stadtteilnummer;Stadtteil;Hektar"
    path = write_csv([head, "sh;City;Geo;Flaechen in Hektar;2019;1;Altstadt;35,0987",
                      "sh;City;Geo;Flaechen in Hektar;2020;1;Altstadt;35,1"])
    rows = twice(spark, D.DISTRICTS_AREA_HECTARES, path, store)
    assert value(rows, "Altstadt", 2019) == pytest.approx(35.0987)
    assert value(rows, "Altstadt", 2020) == pytest.approx(35.1)


def test_religion_plain_year(spark, write_csv, store):
    head = "Land;Stadt;Kategorie;Jahr;Stadtteil;evangelisch;katholisch;sonstige/ohne"
    path = write_csv([head, "sh;City;Bev;2023;Altstadt;500;100;620"])
    rows = twice(spark, D.DISTRICTS_RELIGION, path, store)
    assert value(rows, "Altstadt", 2023) == 1220.0 and len(rows) == 4


# ------------------------------------------------------------------ failures

def _seed(spark, write_csv, store):
    path = write_csv([GENDER_HEAD,
                      "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;1300;650;650"])
    import_dataset(spark, D.DISTRICTS_GENDER, path, store)
    return published(store)


def test_year_parser_nan_keeps_old_rows(spark, write_csv, store):
    before = _seed(spark, write_csv, store)
    path = write_csv([GENDER_HEAD,
                      "sh;City;Bev;Einwohner insgesamt;unbekannt;1;Altstadt;1;1;1"])
    with pytest.raises(DatasetImportError, match=r"districts_gender \(unpivot_categories\).*"
                                           r"'unbekannt' gives NaN"):
        import_dataset(spark, D.DISTRICTS_GENDER, path, store)
    assert published(store) == before
    last = store.runs().orderBy(F.col("seq").desc()).first()
    assert last["status"] == "failed" and "unbekannt" in last["error_message"]


def test_year_out_of_range(spark, write_csv, store):
    before = _seed(spark, write_csv, store)
    # the bad year sits in a row the feature filter drops: still an error
    path = write_csv([GENDER_HEAD,
                      "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;5;2;3",
                      "sh;City;Bev;Andere;1850_12_31;1;Altstadt;5;2;3"])
    with pytest.raises(DatasetImportError, match="gives 1850, which is no year of 1900..2100"):
        import_dataset(spark, D.DISTRICTS_GENDER, path, store)
    assert published(store) == before


def test_broken_value_keeps_old_rows(spark, write_csv, store):
    head = "Land;Stadt;Kategorie;Stadtteil;Jahr;ledig;verheiratet;verwitwet;geschieden"
    good = write_csv([head, "sh;City;Bev;Altstadt;31_12_2022;1;2;3;4"])
    import_dataset(spark, D.DISTRICTS_MARITAL_STATUS, good, store)
    before = published(store)
    bad = write_csv([head, "sh;City;Bev;Altstadt;31_12_2022;abc;2;3;4"])
    with pytest.raises(Exception):
        import_dataset(spark, D.DISTRICTS_MARITAL_STATUS, bad, store)
    assert published(store) == before


def test_zero_rows_refused(spark, write_csv, store):
    before = _seed(spark, write_csv, store)
    path = write_csv([GENDER_HEAD, "sh;City;Bev;Andere;2023_12_31;1;Altstadt;1;1;1"])
    with pytest.raises(DatasetImportError, match="gave no row, published rows stay"):
        import_dataset(spark, D.DISTRICTS_GENDER, path, store)
    assert published(store) == before
    states = {r["status"] for r in store.runs().collect()}
    assert states == {"published", "failed"}


def test_lineage_and_ledger(spark, write_csv, store):
    path = write_csv(["Merkmal;Stadtteil;2022", "Einwohner insgesamt;Altstadt;1300",
                      "Einwohner insgesamt;Wik;700"])
    res = import_dataset(spark, D.DISTRICTS_POPULATION, path, store)
    assert res.imported == 2
    uuid.UUID(res.run_id)
    run = store.runs().collect()[0]
    assert run["status"] == "published" and run["row_count"] == 2
    assert re.fullmatch(r"size:\d+;mtimeMs:\d+", run["data_version"])
    rows = store.facts().collect()
    assert {r["import_run_id"] for r in rows} == {res.run_id}
    assert {r["source_dataset"] for r in rows} == {"districts_population"}
    assert {r["data_version"] for r in rows} == {run["data_version"]}


def test_reimport_replaces_scope(spark, write_csv, store):
    first = write_csv([GENDER_HEAD,
                       "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;1300;650;650",
                       "sh;City;Bev;Einwohner insgesamt;2023_12_31;2;Wik;700;350;350"])
    import_dataset(spark, D.DISTRICTS_GENDER, first, store)
    other = write_csv(["Merkmal;Stadtteil;2022", "Einwohner insgesamt;Altstadt;1300"])
    import_dataset(spark, D.DISTRICTS_POPULATION, other, store)
    second = write_csv([GENDER_HEAD,
                        "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;1301;651;650"])
    import_dataset(spark, D.DISTRICTS_GENDER, second, store)
    assert published(store, "gender") == [("Altstadt", 2023, "female", 650.0),
                                          ("Altstadt", 2023, "male", 651.0),
                                          ("Altstadt", 2023, "total", 1301.0)]
    assert published(store, "population") == [("Altstadt", 2022, "total", 1300.0)]
    # the first gender run is fully replaced; its partitions go when their time is over
    assert store.superseded().count() == 0
    at_once = dt.timedelta(0)
    gone = store.superseded(at_once).collect()
    assert len(gone) == 3 and len({r["import_run_id"] for r in gone}) == 1
    before = published(store)
    assert store.drop_superseded(dry_run=True, retention=at_once) == 3
    assert store.drop_superseded(dry_run=False, retention=at_once) == 3
    assert store.superseded(at_once).count() == 0
    assert published(store) == before


def test_import_many_skips_missing(spark, write_csv, store, tmp_path):
    path = write_csv(["Merkmal;Stadtteil;2022", "Einwohner insgesamt;Altstadt;1300"])
    results = import_many(spark, [D.DISTRICTS_POPULATION, D.DISTRICTS_GENDER], str(tmp_path),
                          store, paths={"districts_population": path})
    assert [r.dataset_id for r in results] == ["districts_population"]


def test_manifest_specs():
    assert len(D.MANIFEST) == 20
    assert [s.id for s in D.datasets("districts_gender")] == ["districts_gender"]
    with pytest.raises(SpecError, match="no spec has the id"):
        D.datasets("nope")
    scopes = D.DISTRICTS_AGE_GROUPS.scopes()
    assert len(scopes) == 21 and scopes[0] == ("age_groups", "district", "total")


def test_header_alias_collision():
    from statlake.sources.csv import normalize_headers
    with pytest.raises(CsvImportError, match="ambiguous header"):
        normalize_headers(["PLZ Bereich", "PLZ- Bereich"], {"PLZ-Bereich": ("PLZ Bereich",
                                                                             "PLZ- Bereich")})
    with pytest.raises(CsvImportError, match="ambiguous header"):
        normalize_headers(["a ", " a"])


def test_hot_key_keep_last(spark, write_csv, store):
    """One (area, date) holds a third of all rows: the last one still wins."""
    lines = [GENDER_HEAD]
    for i in range(1500):
        area, date = ("Altstadt", "2023_12_31") if i % 3 == 0 else (f"Area{i}", "2022_12_31")
        lines.append(f"sh;City;Bev;Einwohner insgesamt;{date};1;{area};{i};{i};0")
    path = write_csv(lines)
    rows = twice(spark, D.DISTRICTS_GENDER, path, store)
    assert value(rows, "Altstadt", 2023) == 1497.0
    assert len(rows) == 3 * (1 + 1000)


def test_import_is_single_pass(spark, write_csv, store, monkeypatch):
    """The year check and the publish checks come from metrics observed in
    the write job: no separate validation scan, no read-back."""
    from statlake.operators import reshape
    calls = []
    monkeypatch.setattr(reshape, "check_years", lambda *a, **k: calls.append("years"))
    original = FactStore.raw_facts
    monkeypatch.setattr(FactStore, "raw_facts",
                        lambda self: calls.append("read-back") or original(self))
    path = write_csv([GENDER_HEAD,
                      "sh;City;Bev;Einwohner insgesamt;2023_12_31;1;Altstadt;1300;650;650"])
    res = import_dataset(spark, D.DISTRICTS_GENDER, path, store)
    assert res.imported == 3
    assert calls == []


def test_ledger_compaction(spark, write_csv, store):
    path = write_csv(["Merkmal;Stadtteil;2022", "Einwohner insgesamt;Altstadt;1300"])
    import_dataset(spark, D.DISTRICTS_POPULATION, path, store)
    bad = write_csv(["Name;2022", "Altstadt;1"])
    with pytest.raises(DatasetImportError):
        import_dataset(spark, D.DISTRICTS_POPULATION, bad, store)
    before = sorted((r["run_id"], r["status"]) for r in store.runs().collect())
    assert store.compact_ledger() is not None   # today's events stay open
    assert sorted((r["run_id"], r["status"]) for r in store.runs().collect()) == before
    path2 = write_csv(["Merkmal;Stadtteil;2022", "Einwohner insgesamt;Altstadt;1400"])
    res = import_dataset(spark, D.DISTRICTS_POPULATION, path2, store)
    runs = {r["run_id"]: r["status"] for r in store.runs().collect()}
    assert len(runs) == 3 and runs[res.run_id] == "published"
    assert [r["value"] for r in store.facts().collect()] == [1400.0]


def test_latin1_body_retries_same_run(spark, write_csv, store):
    """ASCII header, latin-1 body: the first attempt (UTF-8) is found out by
    the observed decoding test, its files are dropped and the same run is
    retried as latin-1."""
    head = ("Land;Stadt;Kategorie;Merkmal;Datum;Stadtteilnummer;Stadtteil;"
            "insgesamt;maennlich;weiblich")
    path = write_csv([head,
                      "sh;City;Bev;Einwohner mit Migrationshintergrund;2023_12_31;1;Düsternbrook;"
                      "50;20;30"], encoding="latin-1")
    rows = twice(spark, D.DISTRICTS_MIGRANT_GENDER, path, store)
    assert value(rows, "Düsternbrook", 2023, "male") == 20.0
    assert {r["status"] for r in store.runs().collect()} == {"published"}
    assert store.runs().count() == 2  # two imports, no extra failed attempt
    # the first import's partitions only
    assert store.superseded(dt.timedelta(0)).count() == 3


def test_strict_mode_rejects_short_rows(spark, write_csv, store):
    """A strict spec fails fast on a ragged row; the permissive one pads it."""
    from statlake.plans.spec import CsvOptions
    lines = ["Merkmal;Stadtteil;2022;2023", "Einwohner insgesamt;Altstadt;1300;1310",
             "Einwohner insgesamt;Wik;700"]
    path = write_csv(lines)
    strict = replace(D.DISTRICTS_POPULATION, csv=CsvOptions(strict=True))
    with pytest.raises(Exception):
        import_dataset(spark, strict, path, store)
    assert store.runs().first()["status"] == "failed"
    rows = twice(spark, D.DISTRICTS_POPULATION, write_csv(lines), store)
    assert [r for r in rows if r[0] == "Wik"] == [("Wik", 2022, "total", 700.0)]


def test_constraint_violations_are_not_published(spark, write_csv, store):
    """A NULL in a required column or a duplicate key fails the publish."""
    from statlake.operators.reshape import RunContext
    from tests.test_read_operators import ROWS
    from statlake.schema import STAT_SCHEMA
    path = write_csv(["Merkmal;Stadtteil;2022", "Einwohner insgesamt;;1300"])
    with pytest.raises(DatasetImportError, match="null_area_name"):
        import_dataset(spark, D.DISTRICTS_POPULATION, path, store)
    rows = [r + ("x", None, None, None) for r in ROWS + ROWS[:1]]
    run = RunContext("dups", "v")
    store.begin(run)
    with pytest.raises(DatasetImportError, match="duplicate_keys"):
        store.commit(spark.createDataFrame(rows, STAT_SCHEMA), run, check_duplicates=True)
    assert store.facts().count() == 0
