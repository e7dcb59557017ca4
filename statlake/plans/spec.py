"""Declarative import specifications.

A spec says how one wide CSV becomes tidy rows: which header columns carry
years (format ``UnpivotYears``) or which columns carry categories (format
``UnpivotCategories``), how area, year and value are derived, and which
(indicator, area type, category) scopes the import owns.  Expressions are
``Column`` builders, never SQL strings.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

from statlake.functions.columns import YEAR_PARSERS

DEFAULT_YEAR_PATTERN = r"^\d{4}$"

#: A named parser, a builder from the raw text's column to the year's, or none.
YearParser = str | Callable[[Column], Column] | None


class SpecError(ValueError):
    pass


def _check_year_parser(parser: YearParser) -> None:
    if parser is not None and not callable(parser) and parser not in YEAR_PARSERS:
        raise SpecError(f"unknown year parser {parser}")


@dataclass(frozen=True)
class Category:
    slug: str
    label: str | None = None


@dataclass(frozen=True)
class YearRow:
    """One feature of a years-as-columns table: rows whose feature column
    equals ``filter_value`` become ``indicator`` / ``category``.
    ``value`` rewrites the raw text before the number test (e.g. decimal comma)."""
    filter_value: str
    indicator: str
    unit: str
    category: Category
    value: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class UnpivotYears:
    indicator_column: str
    rows: tuple[YearRow, ...]
    year_pattern: str = DEFAULT_YEAR_PATTERN
    year_parser: YearParser = None

    def __post_init__(self):
        _check_year_parser(self.year_parser)
        if not self.rows:
            raise SpecError("unpivot_years needs at least one row")


@dataclass(frozen=True)
class CategoryColumn:
    """One category of a categories-as-columns table.  The value is the
    column ``value_column``, else the first of ``value_columns`` present in the
    header, else the expression ``value`` (a no-argument Column builder)."""
    category: Category
    value_column: str | None = None
    value_columns: tuple[str, ...] = ()
    value: Callable[[], Column] | None = None
    indicator: str | None = None
    unit: str | None = None

    def __post_init__(self):
        if self.value_column is None and not self.value_columns and self.value is None:
            raise SpecError(f"category {self.category.slug} needs a value column or expression")


@dataclass(frozen=True)
class UnpivotCategories:
    year_column: str
    columns: tuple[CategoryColumn, ...]
    year_parser: YearParser = None
    keep_last: bool = False
    indicator: str | None = None
    unit: str | None = None
    filter_column: str | None = None
    filter_value: str | None = None

    def __post_init__(self):
        if (self.filter_column is None) != (self.filter_value is None):
            raise SpecError("filter_column and filter_value go together")
        _check_year_parser(self.year_parser)
        if not self.columns:
            raise SpecError("unpivot_categories needs at least one column")


@dataclass(frozen=True)
class CsvOptions:
    encoding: str | None = None
    fallback_encodings: tuple[str, ...] = ()
    strict: bool | None = None
    quote: str | None = None
    escape: str | None = None

    def encodings(self) -> list[str | None]:
        """Declared encoding first, then each fallback, without repeats."""
        out: list[str | None] = []
        for e in (self.encoding, *self.fallback_encodings):
            if e not in out:
                out.append(e)
        return out or [None]


@dataclass(frozen=True)
class DatasetSpec:
    id: str
    url: str
    csv_filename: str
    area_type: str
    format: UnpivotYears | UnpivotCategories
    delimiter: str = ";"
    csv: CsvOptions = field(default_factory=CsvOptions)
    column_aliases: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    area_column: str | None = None
    area_expression: Callable[[Column], Column] | None = None
    default_area_name: str | None = None

    def __post_init__(self):
        if not self.id.strip():
            raise SpecError("dataset spec has an empty id")
        if not self.url.strip():
            raise SpecError(f"dataset {self.id} has an empty url")
        if not self.csv_filename.strip():
            raise SpecError(f"dataset {self.id} has an empty csv file name")
        if len(self.delimiter) != 1:
            raise SpecError(f"{self.id}: the delimiter must be one character, not {self.delimiter!r}")
        if self.area_column is None and self.default_area_name is None:
            raise SpecError(f"{self.id}: name an area column or give a default area name")

    @property
    def format_type(self) -> str:
        return "unpivot_years" if isinstance(self.format, UnpivotYears) else "unpivot_categories"

    def planned_categories(self) -> list[tuple[str, str, str]]:
        """(indicator, unit, category slug) per output category, in spec order."""
        fmt = self.format
        if isinstance(fmt, UnpivotYears):
            return [(r.indicator, r.unit, r.category.slug) for r in fmt.rows]
        out = []
        for c in fmt.columns:
            indicator = c.indicator or fmt.indicator
            unit = c.unit or fmt.unit
            if not indicator or not unit:
                raise SpecError(f"{self.id}: category {c.category.slug} has no indicator or no unit")
            out.append((indicator, unit, c.category.slug))
        return out

    def scopes(self) -> list[tuple[str, str, str]]:
        """(indicator, area_type, category) owned by this import."""
        seen = []
        for indicator, _unit, slug in self.planned_categories():
            key = (indicator, self.area_type, slug)
            if key not in seen:
                seen.append(key)
        return seen


def index_specs(specs) -> dict[str, DatasetSpec]:
    out: dict[str, DatasetSpec] = {}
    for s in specs:
        if s.id in out:
            raise SpecError(f"two specs have the id {s.id}")
        out[s.id] = s
    return out


def resolve_specs(specs, dataset_id: str | None = None) -> list[DatasetSpec]:
    """All specs, or the one with ``dataset_id`` (unknown ids list the known)."""
    index = index_specs(specs)
    if dataset_id is None or dataset_id == "all":
        return list(index.values())
    if dataset_id not in index:
        raise SpecError(f"no spec has the id {dataset_id}; there are {', '.join(index)}")
    return [index[dataset_id]]
