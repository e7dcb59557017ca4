"""File input, parsing and bulk bounds."""

import pytest
from pyspark.sql import functions as F

from statlake.functions.columns import (
    computed_total,
    has_empty_token,
    longest_token,
    normalize_url,
    parse_year,
    split_list,
)
from statlake.operators import bulk, query as q
from statlake.operators.reshape import DatasetImportError, RunContext, to_tidy
from statlake.plans import datasets as D
from statlake.plans.spec import Category, DatasetSpec, SpecError, UnpivotYears, YearRow
from statlake.sources.catalog import resource_urls
from statlake.sources.csv import CsvImportError, read_delimited, write_text_table


def test_files_of_a_folder_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Merkmal;Stadtteil;2022;2023\nx;A;1;2\n")
    (tmp_path / "b.csv").write_text("Merkmal;Stadtteil;2023;2022\nx;B;1;2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path)).collect()


def test_files_with_equal_headers_are_read_together(spark, tmp_path):
    for name, area in (("a", "A"), ("b", "B")):
        (tmp_path / f"{name}.csv").write_text(f" Merkmal ;Stadtteil;2022\nx;{area};1\n")
    rows = read_delimited(spark, str(tmp_path)).collect()
    assert sorted((r["Merkmal"], r["Stadtteil"], r["2022"]) for r in rows) == [("x", "A", "1"), ("x", "B", "1")]


def test_repeated_names_in_several_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k;2022;2022\nx;1;2\n")
    (tmp_path / "b.csv").write_text("k;2022;2022\ny;3;4\n")
    rows = read_delimited(spark, str(tmp_path)).collect()
    assert sorted((r["k"], r["2022"], r["2022_1"]) for r in rows) == [("x", "1", "2"), ("y", "3", "4")]
    (tmp_path / "c.csv").write_text("2022;2022;k\n5;6;z\n")
    with pytest.raises(CsvImportError, match="different headers"):
        read_delimited(spark, str(tmp_path))


def test_written_tables_are_quoted_and_have_one_header_per_file(spark, tmp_path):
    df = spark.createDataFrame([(1, "a;b"), (2, 'say "x"'), (3, None), (4, "plain")], "k int, v string").repartition(2)
    path = write_text_table(df, str(tmp_path / "t"), ["k", "k"])
    lines = [x.value for x in spark.read.text(path).collect()]
    assert sorted(lines) == sorted(["k;k"] * 2 + ['1;"a;b"', '2;"say ""x"""', "3;", "4;plain"])


def test_rows_without_an_order_are_refused(spark):
    df = spark.createDataFrame([("Einwohner insgesamt", "A", "1")], ["Merkmal", "Stadtteil", "2022"])
    with pytest.raises(DatasetImportError, match="order"):
        to_tidy(df, D.DISTRICTS_POPULATION, RunContext("d"))


@pytest.mark.parametrize("cell", ["12d", "nan", "", "1,5"])
def test_strict_totals_refuse_cells_that_are_no_number(spark, cell):
    df = spark.createDataFrame([(cell, "1"), (None, "2")], "a string, b string")
    assert sorted(r.t for r in df.select(computed_total(["a", "b"], lenient=True).alias("t")).collect()) == [1.0, 2.0]
    with pytest.raises(Exception, match="not a number in a total"):
        df.select(computed_total(["a", "b"]).alias("t")).collect()
    assert df.where("a IS NULL").select(computed_total(["a", "b"]).alias("t")).first().t == 2.0


def test_white_space_of_any_kind_is_stripped(spark):
    df = spark.createDataFrame([("\thttps://x/a.csv/\n", "\ta\u00a0,a,\u2003b"), ("\ufeffu//", " \n,x")], "u string, l string")
    got = df.select(normalize_url("u").alias("u"), split_list("l").alias("l"), has_empty_token("l").alias("e"),
                    longest_token("l").alias("n")).collect()
    assert [tuple(r) for r in got] == [("https://x/a.csv", ["a", "b"], False, 1), ("u", ["", "x"], True, 1)]


def test_only_text_urls_of_the_resource_itself_count(spark):
    cases = ['{"url": 5, "m": {"url": "x"}}', '{"url": "a"}', '{"m": {"url": "x"}}', '{"url": null}', "no json", '{"url": ""}']
    df = spark.createDataFrame([(k, [c]) for k, c in enumerate(cases)], "pos int, resources array<string>")
    assert sorted(tuple(r) for r in resource_urls(df).collect()) == [(1, "a"), (5, "")]


def test_year_parsers_may_be_builders(spark):
    short = lambda c: F.regexp_extract(c, "'([0-9]{2})$", 1).cast("int") + 2000
    df = spark.createDataFrame([("Q4 '21",)], "y string")
    assert df.select(parse_year("y", short)).first()[0] == 2021
    spec = DatasetSpec(id="q", url="u", csv_filename="f", area_type="district", area_column="a", format=UnpivotYears(
        "m", (YearRow("x", "i", "u", Category("total")),), year_pattern="^Q4", year_parser=short))
    wide = spark.createDataFrame([("x", "A", "1", "2", 1)], ["m", "a", "Q4 '21", "Q4 '22", "_ingest_order"])
    assert sorted((r.year, r.value) for r in to_tidy(wide, spec, RunContext("q")).collect()) == [(2021, 1.0), (2022, 2.0)]
    with pytest.raises(SpecError):
        UnpivotYears("m", (YearRow("x", "i", "u", Category("total")),), year_parser="nope")


def _requests(spark, *items):
    base = dict(kind="timeseries", limit=50, offset=0, order=None)
    return spark.createDataFrame(
        [(k, k, r["kind"], "i", "district", None, None, None, None, 2020, r["limit"], r["offset"], r["order"])
         for k, r in enumerate(base | x for x in items)], bulk.REQUEST_SCHEMA)


@pytest.mark.parametrize("items,field", [
    ([], "items"), ([{}] * 26, "items"), ([{}, {"limit": 501}], "limit"), ([{"limit": 0}], "limit"),
    ([{"kind": "ranking", "limit": 101}], "limit"), ([{"offset": -1}], "offset"),
    ([{"kind": "ranking", "order": "up"}], "order"), ([{"kind": "other"}], "kind")])
def test_bulk_bounds(spark, items, field):
    with pytest.raises(q.StatisticsValidationError) as e:
        bulk.check_bounds(_requests(spark, *items))
    assert e.value.details["field"] == field


def test_bulk_within_bounds(spark):
    bulk.check_bounds(_requests(spark, *[{}] * 23, {"limit": 500}, {"kind": "ranking", "limit": 100, "order": "asc"}))
    bulk.check_bounds(_requests(spark, {"limit": None, "offset": None}))
