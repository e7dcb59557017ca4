"""Mixed encodings, changed inputs, versions of many files, catalogue documents, places."""

import os

import pytest
from pyspark.sql import functions as F

from statlake.operators.paging import numbered
from statlake.operators.publish import FactStore
from statlake.operators.reshape import DatasetImportError
from statlake.plans import datasets as D
from statlake.plans.importer import import_dataset, import_many
from statlake.plans.spec import CsvOptions
from statlake.sources.catalog import read_catalog, resource_urls
from statlake.sources.csv import CsvFileNotFoundError, CsvImportError, encodings_by_file, read_delimited
from statlake.sources.files import list_files, version_of

BOTH = CsvOptions(fallback_encodings=("latin-1",))
HEAD = "Land;Stadt;Kategorie;Merkmal;Datum;Stadtteilnummer;Stadtteil;insgesamt;{};weiblich"


@pytest.fixture
def store(spark, tmp_path):
    return FactStore(spark, str(tmp_path / "store"))


def folder(tmp_path, files, name="mixed"):
    path = tmp_path / name
    path.mkdir(exist_ok=True)
    for file, (text, encoding) in files.items():
        (path / file).write_bytes((text + "\n").encode(encoding))
    return str(path)


def test_each_file_of_a_folder_in_its_own_encoding(spark, tmp_path):
    path = folder(tmp_path, {"a.csv": ("Ort;Zahl\nKöln;1\nBonn;2", "utf-8"), "b.csv": ("Ort;Zahl\nDüren;3", "latin-1"),
                             "c d+e.csv": ("Ort;Zahl\nSüß;4", "latin-1"), "e.csv": ("Ort;Zahl\nBonn;5", "ascii")})
    rows = read_delimited(spark, path, ";", BOTH).collect()
    assert sorted((r["Ort"], r["Zahl"]) for r in rows) == [("Bonn", "2"), ("Bonn", "5"), ("Düren", "3"), ("Köln", "1"), ("Süß", "4")]
    found = {enc: [os.path.basename(f) for f in files] for enc, files in encodings_by_file(spark, path, BOTH.encodings())}
    assert found == {None: ["a.csv", "e.csv"], "latin-1": ["b.csv", "c d+e.csv"]}
    # the order of rows is still that of the files
    ordered = read_delimited(spark, path, ";", BOTH).orderBy("_ingest_order").collect()
    assert [r["Zahl"] for r in ordered] == ["1", "2", "3", "4", "5"]


def test_headers_with_umlauts_in_two_encodings(spark, tmp_path):
    path = folder(tmp_path, {"a.csv": ("Straße;Zahl\nx;1", "utf-8"), "b.csv": ("Straße;Zahl\ny;2", "latin-1")})
    assert sorted(r["Straße"] for r in read_delimited(spark, path, ";", BOTH).collect()) == ["x", "y"]
    path = folder(tmp_path, {"a.csv": ("Straße;Zahl\nx;1", "utf-8"), "b.csv": ("Straße;Wert\ny;2", "latin-1")}, "other")
    with pytest.raises(CsvImportError, match="different headers"):
        read_delimited(spark, path, ";", BOTH).collect()


@pytest.mark.parametrize("male", ["maennlich", "männlich"])
def test_importing_a_mixed_folder(spark, tmp_path, store, male):
    """Found by the first lines (umlaut in the header) or by the body's observation."""
    line = "sh;City;Bev;Einwohner mit Migrationshintergrund;2023_12_31;1;{};50;20;30"
    path = folder(tmp_path, {"a.csv": (HEAD.format(male) + "\n" + line.format("Mühle"), "utf-8"),
                             "b.csv": (HEAD.format(male) + "\n" + line.format("Düsternbrook"), "latin-1")})
    import_dataset(spark, D.DISTRICTS_MIGRANT_GENDER, path, store)
    assert {r["area_name"] for r in store.facts().collect()} == {"Mühle", "Düsternbrook"}
    assert [r["status"] for r in store.runs().collect()] == ["published"]


def population(write_csv, name, value):
    return write_csv(["Merkmal;Stadtteil;2022", f"Einwohner insgesamt;Altstadt;{value}"], name)


def test_unchanged_sources_are_not_imported_again(spark, write_csv, store):
    path = population(write_csv, "p.csv", 1300)
    run = [import_many(spark, [D.DISTRICTS_POPULATION], "", store, {"districts_population": path})[0] for _ in range(3)]
    assert [(r.updated, r.imported) for r in run] == [(True, 1), (False, 0), (False, 0)]
    assert len({r.run_id for r in run}) == 1 and store.version() == 1
    assert [(r["path"], r["import_run_id"]) for r in store.manifest().collect()] == [("file:" + path, run[0].run_id)]
    forced = import_many(spark, [D.DISTRICTS_POPULATION], "", store, {"districts_population": path}, only_changed=False)
    assert forced[0].updated and store.version() == 2


def test_changed_sources_are_imported_again(spark, write_csv, store, tmp_path):
    path = population(write_csv, "p.csv", 1300)
    paths = {"districts_population": path}

    def again():
        return import_many(spark, [D.DISTRICTS_POPULATION], "", store, paths)[0].updated

    assert again()
    population(write_csv, "p.csv", 13001)                    # another size
    assert again() and [r["value"] for r in store.facts().collect()] == [13001.0]
    os.utime(path, (1, 1))                                   # another time
    assert again() and not again()
    # a run that failed leaves no manifest behind that counts
    (tmp_path / "p.csv").write_text("Name;2022\nAltstadt;1\n")
    with pytest.raises(DatasetImportError):
        again()
    with pytest.raises(DatasetImportError):
        again()
    population(write_csv, "p.csv", 13001)
    assert again() and not again()


def test_a_replaced_run_is_imported_again(spark, write_csv, store):
    """The same input, but its scopes have been published by another run since."""
    path = population(write_csv, "p.csv", 1300)
    paths = {"districts_population": path}
    import_many(spark, [D.DISTRICTS_POPULATION], "", store, paths)
    from dataclasses import replace
    other = replace(D.DISTRICTS_POPULATION, id="elsewhere")
    import_dataset(spark, other, population(write_csv, "q.csv", 7), store)
    assert import_many(spark, [D.DISTRICTS_POPULATION], "", store, paths)[0].updated
    assert [r["value"] for r in store.facts().collect()] == [1300.0]


def test_a_file_that_changes_while_it_is_read_is_found_changed(spark, write_csv, store, monkeypatch):
    path = population(write_csv, "p.csv", 1300)
    commit = FactStore.commit

    def later(self, *a, **kw):
        n = commit(self, *a, **kw)
        os.utime(path, (5, 5))
        return n

    monkeypatch.setattr(FactStore, "commit", later)
    paths = {"districts_population": path}
    import_many(spark, [D.DISTRICTS_POPULATION], "", store, paths)
    monkeypatch.setattr(FactStore, "commit", commit)
    assert import_many(spark, [D.DISTRICTS_POPULATION], "", store, paths)[0].updated


def test_a_missing_input(spark, store, tmp_path):
    with pytest.raises(CsvFileNotFoundError):
        import_dataset(spark, D.DISTRICTS_POPULATION, str(tmp_path / "none.csv"), store)
    assert store.runs().count() == 0


def test_versions_do_not_depend_on_the_order(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"{k}.csv").write_text("x" * (k + 1))
    listing = list_files(spark, str(tmp_path), "*.csv")
    one = version_of(listing)
    assert one.startswith("files:5;sha256:") and len(one) == len("files:5;sha256:") + 60
    assert version_of(listing.orderBy(F.desc("path")).repartition(4)) == one
    assert version_of(listing.where("size != 3")) != one
    assert version_of(listing.where("size = 3")).startswith("size:3;mtimeMs:")
    assert version_of(listing.where("false")) is None


@pytest.mark.parametrize("text,urls", [
    ('[{"resources":[{"url":"a"},{"url":5},"t"]}, 7, null, "s", {"resources":"no"}, [{"resources":[{"url":"x"}]}], {"resources":[{"url":"b"}]}]',
     [(0, "a"), (6, "b")]),
    ('{"count": 2, "result": [1, {"resources": [{"url": "c", "deep": {"url": "d"}}]}], "other": [{"resources":[{"url":"e"}]}]}', [(1, "c")]),
    ('{"result": {"resources": [{"url": "f"}]}}', []), ('{"resources": [{"url": "f"}]}', []), ("no json", []), ("[]", []), ("", [])])
def test_catalogue_documents(spark, tmp_path, text, urls):
    (tmp_path / "c.json").write_text(text)
    found = resource_urls(read_catalog(spark, str(tmp_path / "c.json")))
    assert sorted(tuple(r) for r in found.collect()) == urls


def test_catalogue_lines(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"resources":[{"url":"a"}]}\n\n7\nbroken {\n{"resources":[{"url":"b"},{"url":"c"}]}\n')
    found = resource_urls(read_catalog(spark, str(tmp_path / "c.jsonl"), lines=True)).collect()
    assert sorted((r["pos"], r["url"]) for r in found) == [(0, "a"), (3, "b"), (3, "c")]


def test_numbered(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    rows = numbered(df.repartition(7), "k").collect()
    assert all(r["position"] == r["k"] + 1 for r in rows) and len(rows) == 5000
    assert numbered(df.where("false"), "k").collect() == []


def test_rows_are_ordered_by_a_number_of_their_file(spark, tmp_path):
    """The order of rows holds no path, which a grouping would keep for every row."""
    folder = tmp_path / "a b%20ü"
    folder.mkdir()
    for name in ("z 1.csv", "b.csv", "ä.csv"):
        (folder / name).write_text("m;n\n" + "".join(f"{name};{i}\n" for i in range(3)), encoding="utf-8")
    rows = read_delimited(spark, str(folder), ";").orderBy("_ingest_order").collect()
    assert [(r.m, r.n) for r in rows] == [(name, str(i)) for name in ("b.csv", "z 1.csv", "ä.csv") for i in range(3)]
    assert [r._ingest_order.file for r in rows] == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert not any(isinstance(v, str) for r in rows for v in r._ingest_order)
