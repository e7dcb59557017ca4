"""Column functions against plain-Python statements of the same rules."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statlake.functions.columns import (
    NUMBER_PATTERN,
    normalize_url,
    parse_number,
    parse_year,
    split_list,
    url_file_name,
)
from statlake.sources.csv import unique_names

NUMBERISH = st.one_of(
    st.from_regex(r"\A\s?[+-]?\d{1,6}([.,]\d{0,4})?([eE][+-]?\d{1,2})?\s?\Z"),
    st.sampled_from(["", " ", "12d", "1_000", "nan", "NaN", "Infinity", "-inf", ".5", "5.",
                     "1e3", " 12 ", "x", "1.2.3", "--1", "+.5e-2"]),
)


def py_number(s):
    # \d and \s are ASCII classes in the JVM (and in the reference's JS)
    if s is None or not re.fullmatch(NUMBER_PATTERN.replace("^", "").replace("$", ""), s,
                                     flags=re.ASCII):
        return None
    return float(s.strip())


@settings(max_examples=3, deadline=None)
@given(st.lists(NUMBERISH, min_size=50, max_size=120))
def test_parse_number_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(parse_number("t")).collect()]
    assert got == [py_number(v) for v in values]


def test_year_parsers(spark):
    df = spark.createDataFrame([("31.12.2023",), ("2023_12_31",), ("31_12_2022",), ("2022_1",),
                                ("x2019y",), ("abc",), (None,)], "t string")
    first = [r[0] for r in df.select(parse_year("t", "first")).collect()]
    leading = [r[0] for r in df.select(parse_year("t", "leading")).collect()]
    assert first == [2023, 2023, 2022, 2022, 2019, None, None]
    assert leading == [None, 2023, None, 2022, None, None, None]


def test_url_rules(spark):
    df = spark.createDataFrame([(" https://a.example/x/file.csv?q=1#f ",), ("https://a.example/",),
                                ("https://a.example/dir//",)], "u string")
    rows = df.select(normalize_url("u"), url_file_name("u")).collect()
    assert [tuple(r) for r in rows] == [
        ("https://a.example/x/file.csv?q=1#f", "file.csv"),
        ("https://a.example", "a.example"),
        ("https://a.example/dir", "dir")]


@given(st.lists(st.sampled_from(["2022", "2023", "a", "a_1", "b"]), max_size=8))
def test_unique_names_are_unique(names):
    out = unique_names(names)
    assert len(set(out)) == len(out) == len(names)
    # first occurrences keep their name
    for i, n in enumerate(names):
        if n not in names[:i]:
            assert out[i] == n


def test_split_list_keeps_first_seen_order(spark):
    df = spark.createDataFrame([("c, a ,c,b, a",)], "s string")
    assert df.select(split_list(F.col("s"))).first()[0] == ["c", "a", "b"]
