"""Categories-as-columns imports against a plain-Python model of the rules
(feature filter, number test, keep-last per final key per category) on
random small files with duplicates, blanks and junk cells."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from statlake.operators.reshape import RunContext
from statlake.plans import datasets as D
from statlake.plans.importer import stage

HEAD = "Merkmal;Datum;Stadtteil;insgesamt;maennlich;weiblich"
NUM = re.compile(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*", re.ASCII)

cell = st.one_of(st.integers(0, 999).map(str), st.sampled_from(["", "x", "1,5", " 7 ", "nan"]))
row = st.tuples(st.sampled_from(["Einwohner insgesamt", "Einwohner insgesamt", "Andere"]),
                st.sampled_from(["2022_12_31", "31.12.2023"]),
                st.sampled_from(["Wik", " Wik", "Altstadt", "Ost"]),
                cell, cell, cell)


def model(rows):
    out = {}
    for feature, date, area, *cells in rows:  # later rows overwrite earlier ones
        if feature != "Einwohner insgesamt":
            continue
        year = int(re.search(r"\d{4}", date).group(0))
        for slug, text in zip(["total", "male", "female"], cells):
            if text and NUM.fullmatch(text):
                out[("gender", area, year, slug)] = float(text.strip())
    return sorted((k + (v,)) for k, v in out.items())


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_categories_import_matches_model(spark, tmp_path_factory, rows):
    path = tmp_path_factory.mktemp("model") / "in.csv"
    path.write_text("\n".join([HEAD] + [";".join(r) for r in rows]) + "\n")
    staged, _ = stage(spark, D.DISTRICTS_GENDER, str(path), RunContext("m", "v"))
    got = sorted((r.indicator, r.area_name, r.year, r.category, r.value)
                 for r in staged.collect())
    assert got == model(rows)


YEARS = ["2022", "2023", "2022"]  # a repeated year header: the later column wins unless empty
yrow = st.tuples(st.sampled_from(["Einwohner insgesamt", "Andere"]),
                 st.sampled_from(["Wik", "Wik ", "Altstadt"]), cell, cell, cell)


def years_model(rows):
    """Per (area, year) the value from the latest header position; between
    rows (which the reference leaves open) the later row."""
    best = {}
    for i, (feature, area, *cells) in enumerate(rows):
        if feature != "Einwohner insgesamt":
            continue
        for pos, (year, text) in enumerate(zip(YEARS, cells)):
            if text and NUM.fullmatch(text):
                key = ("population", area.strip(), int(year), "total")
                if key not in best or (pos, i) > best[key][0]:
                    best[key] = ((pos, i), float(text.strip()))
    return sorted(k + (v,) for k, (_, v) in best.items())


@settings(max_examples=8, deadline=None)
@given(st.lists(yrow, min_size=1, max_size=30))
def test_years_import_matches_model(spark, tmp_path_factory, rows):
    path = tmp_path_factory.mktemp("ymodel") / "in.csv"
    head = "Merkmal;Ortsteil;" + ";".join(YEARS)
    path.write_text("\n".join([head] + [";".join(r) for r in rows]) + "\n")
    staged, _ = stage(spark, D.SUBDISTRICTS_POPULATION, str(path), RunContext("m", "v"))
    got = sorted((r.indicator, r.area_name, r.year, r.category, r.value)
                 for r in staged.collect())
    assert got == years_model(rows)
