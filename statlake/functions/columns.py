"""Column expressions used across imports and reads.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage code generation; none needs a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from statlake.schema import MAX_VALID_YEAR, MIN_VALID_YEAR

# A number the engine accepts: optional sign, digits with an optional
# fraction (or a bare fraction), optional exponent, surrounding blanks.
# Anything else (``12d``, ``1_000``, ``nan``, ``Infinity``, ``''``) is NULL.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c) -> Column:
    """Lenient string -> double: NULL unless the text is a plain number."""
    c = _col(c).cast("string")
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("double"))


def is_number(c) -> Column:
    return F.coalesce(_col(c).cast("string").rlike(NUMBER_PATTERN), F.lit(False))


def decimal_comma(c) -> Column:
    """``1,6`` -> ``1.6`` (German decimal comma)."""
    return F.replace(_col(c).cast("string"), F.lit(","), F.lit("."))


def thousands_dot(c) -> Column:
    """``10.141`` -> ``10141`` (German thousands separator)."""
    return F.replace(_col(c).cast("string"), F.lit("."), F.lit(""))


def computed_total(columns, lenient: bool = False) -> Column:
    """Sum of several raw columns with NULL counted as 0.

    strict: a cell must be a number or NULL, anything else raises;
    lenient: anything that is not a number counts as 0.
    """
    def one(name):
        c = F.col("`" + name.replace("`", "``") + "`") if isinstance(name, str) else name
        if lenient:
            return F.coalesce(parse_number(c), F.lit(0.0))
        text = c.cast("string")
        checked = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double")).otherwise(
            F.raise_error(F.concat(F.lit("not a number in a total: "), text)).cast("double"))
        return F.when(text.isNull(), F.lit(0.0)).otherwise(checked)
    return reduce(add, [one(c) for c in columns])


# Year parsers.  ``first`` takes the first run of four digits anywhere in
# the text (31.12.2023, 2023_12_31); ``leading`` only at the start
# (2022_1 from a repeated header).
YEAR_PARSERS = {
    "first": r"(\d{4})",
    "leading": r"^(\d{4})",
}


def parse_year(c, parser) -> Column:
    """Raw year text -> int.  Without a parser the text is cast as is; a callable
    gets the text's column and returns the year's."""
    c = _col(c).cast("string")
    if callable(parser):
        return parser(c).cast("int")
    if parser is None:
        return c.cast("int")
    pattern = YEAR_PARSERS[parser]
    digits = F.regexp_extract(c, pattern, 1)
    return F.when(digits != "", digits.cast("int"))


def year_in_range(c) -> Column:
    c = _col(c)
    return c.isNotNull() & (c >= MIN_VALID_YEAR) & (c <= MAX_VALID_YEAR)


def strip_space(c) -> Column:
    """White space of any kind (Unicode included) off both ends."""
    return F.regexp_replace(_col(c), r"^[\s\p{Z}\uFEFF]+|[\s\p{Z}\uFEFF]+$", "")


def normalize_url(c) -> Column:
    """White space off the ends, then trailing slashes; scheme, host case and query stay."""
    return F.regexp_replace(strip_space(c), r"/+$", "")


def url_file_name(c) -> Column:
    """Last path segment of the normalised URL without query and fragment."""
    no_query = F.regexp_extract(normalize_url(c), r"^([^?#]*)", 1)
    return F.regexp_extract(no_query, r"([^/]*)$", 1)


def iso_utc(c) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ss.SSSZ`` (session time zone is UTC)."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def split_list(c) -> Column:
    """Comma separated request list -> trimmed tokens, first occurrence kept."""
    return F.array_distinct(F.transform(F.split(_col(c), ","), lambda t: strip_space(t)))


def has_empty_token(c) -> Column:
    return F.exists(F.split(_col(c), ","), lambda t: F.length(strip_space(t)) == 0)


def longest_token(c) -> Column:
    return F.array_max(F.transform(F.split(_col(c), ","), lambda t: F.length(strip_space(t))))
