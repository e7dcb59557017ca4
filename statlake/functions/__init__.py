from statlake.functions.columns import (  # noqa: F401
    NUMBER_PATTERN,
    YEAR_PARSERS,
    computed_total,
    decimal_comma,
    has_empty_token,
    is_number,
    iso_utc,
    longest_token,
    normalize_url,
    parse_number,
    parse_year,
    split_list,
    thousands_dot,
    url_file_name,
    year_in_range,
)
