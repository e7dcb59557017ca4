"""The municipal dataset specs as declarative data.

Column names, feature values, slugs and units are fixed values of the
published open-data files; they must stay as written for the imports to find
their columns.  Inputs are expected at ``<SOURCE_BASE>/<dataset id>.csv``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions.columns import computed_total, decimal_comma, parse_number, thousands_dot
from statlake.plans.spec import (
    Category,
    CategoryColumn,
    CsvOptions,
    DatasetSpec,
    UnpivotCategories,
    UnpivotYears,
    YearRow,
    resolve_specs,
)

# Where the landed CSV files live: ``<SOURCE_BASE>/<dataset id>.csv``.  The
# download location of each file is deployment configuration, not code.
SOURCE_BASE = "file:///landing/statistics"

# Header regex of date-named year columns and of repeated year columns.
DATE_HEADER = r"^\d{2}\.\d{2}\.\d{4}$"
YEAR_WITH_SUFFIX = r"^\d{4}(?:_\d+)?$"

# District age bands (column, slug).
DISTRICT_AGES = [
    ("0 bis unter 3", "age_0_2"),
    ("3 bis unter 6", "age_3_5"),
    ("6 bis unter 10", "age_6_9"),
    ("10 bis unter 12", "age_10_11"),
    ("12 bis unter 15", "age_12_14"),
    ("15 bis unter 18", "age_15_17"),
    ("18 bis unter 21", "age_18_20"),
    ("21 bis unter 25", "age_21_24"),
    ("25 bis unter 30", "age_25_29"),
    ("30 bis unter 35", "age_30_34"),
    ("35 bis unter 40", "age_35_39"),
    ("40 bis unter 45", "age_40_44"),
    ("45 bis unter 50", "age_45_49"),
    ("50 bis unter 55", "age_50_54"),
    ("55 bis unter 60", "age_55_59"),
    ("60 bis unter 65", "age_60_64"),
    ("65 bis unter 70", "age_65_69"),
    ("70 bis unter 75", "age_70_74"),
    ("75 bis unter 80", "age_75_79"),
    ("80 und aelter", "age_80_plus"),
]
# Subdistrict age bands (column, slug).
SUBDISTRICT_AGES = [
    ("0-<5", "age_0_4"),
    ("5-<10", "age_5_9"),
    ("10-<15", "age_10_14"),
    ("15-<20", "age_15_19"),
    ("20-<25", "age_20_24"),
    ("25-<30", "age_25_29"),
    ("30-<35", "age_30_34"),
    ("35-<40", "age_35_39"),
    ("40-<45", "age_40_44"),
    ("45-<50", "age_45_49"),
    ("50-<55", "age_50_54"),
    ("55-<60", "age_55_59"),
    ("60-<65", "age_60_64"),
    ("65-<70", "age_65_69"),
    ("70-<75", "age_70_74"),
    ("75-<80", "age_75_79"),
    ("80-<85", "age_80_84"),
    ("85 und Aelter", "age_85_plus"),
]

# Marital status, household types, religion, nationalities (column -> slug).
MARITAL = [("ledig", "single"), ("verheiratet", "married"), ("verwitwet", "widowed"),
           ("geschieden", "divorced")]
HOUSEHOLDS = [("Einpersonen", "single_person"), ("Paar ohne Kind", "couple_no_children"),
              ("Paar mit Kindern", "couple_with_children"),
              ("Paar mit Nachkommen", "couple_with_descendants"),
              ("Alleinerziehende", "single_parent"),
              ("Sonst. Mehrpersonenhaushalte", "other_multi_person")]
RELIGION = [("evangelisch", "evangelical"), ("katholisch", "catholic"),
            ("sonstige/ohne", "other_or_none")]
NATIONALITIES = [("Tuerkei", "turkey"), ("Polen", "poland"), ("Irak", "iraq"),
                 ("Russland", "russia"), ("Ukraine", "ukraine"), ("Syrien", "syria"),
                 ("Bulgarien", "bulgaria")]
# Spellings under which the "male" column of the migrant files appears.
MALE_ALTERNATIVES = ("männlich", "mÃ¤nnlich", "m�nnlich", "maennlich")


def _lenient(name):
    return lambda: F.coalesce(parse_number(F.col(f"`{name}`")), F.lit(0.0))


def _total(names, lenient=False):
    return lambda: computed_total([F.col(f"`{n}`") for n in names], lenient=lenient)


def _columns(pairs, total: bool, lenient=False):
    cols = []
    if total:
        cols.append(CategoryColumn(Category("total"), value=_total([c for c, _ in pairs], lenient)))
    for name, slug in pairs:
        if lenient:
            cols.append(CategoryColumn(Category(slug), value=_lenient(name)))
        else:
            cols.append(CategoryColumn(Category(slug), value_column=name))
    return tuple(cols)


def _gender(male=("maennlich",)):
    male_col = (CategoryColumn(Category("male"), value_column=male[0]) if len(male) == 1
                else CategoryColumn(Category("male"), value_columns=male))
    return (CategoryColumn(Category("total"), value_column="insgesamt"), male_col,
            CategoryColumn(Category("female"), value_column="weiblich"))


def _years_row(feature, indicator, unit, value=None):
    return (YearRow(feature, indicator, unit, Category("total"), value),)


def _spec(id_, area_type, area_column, fmt, trim=False, **kw):
    return DatasetSpec(id=id_, url=f"{SOURCE_BASE}/{id_}.csv", csv_filename=f"{id_}.csv",
                       area_type=area_type, area_column=area_column,
                       area_expression=F.trim if trim else None, format=fmt, **kw)


DISTRICTS_POPULATION = _spec(
    "districts_population", "district", "Stadtteil",
    UnpivotYears("Merkmal", _years_row("Einwohner insgesamt", "population", "persons")))

DISTRICTS_HOUSEHOLDS_TYPE_SIZE = _spec(
    "districts_households_type_size",
    "district", "Stadtteile",
    UnpivotCategories("Jahr", _columns(HOUSEHOLDS, total=True), year_parser="first",
                      filter_column="Merkmal", filter_value="Haushalte",
                      indicator="households", unit="households"))

DISTRICTS_MARITAL_STATUS = _spec(
    "districts_marital_status",
    "district", "Stadtteil",
    UnpivotCategories("Jahr", _columns(MARITAL, total=True), year_parser="first",
                      indicator="marital_status", unit="persons"))

DISTRICTS_GENDER = _spec(
    "districts_gender", "district", "Stadtteil",
    UnpivotCategories("Datum", _gender(), year_parser="first", keep_last=True,
                      filter_column="Merkmal", filter_value="Einwohner insgesamt",
                      indicator="gender", unit="persons"))

DISTRICTS_FOREIGN_AGE_GROUPS = _spec(
    "districts_foreign_age_groups", "district", "Stadtteil",
    UnpivotCategories("Datum", _columns(DISTRICT_AGES, total=True, lenient=True),
                      year_parser="first", filter_column="Merkmal",
                      filter_value="Einwohner nach Altersgruppen",
                      indicator="foreign_age_groups", unit="persons"),
    trim=True)

DISTRICTS_FOREIGN_COUNT = _spec(
    "districts_foreign_count", "district", "Stadtteil",
    UnpivotYears("Merkmal", _years_row("Auslaender", "foreign_count", "persons")), trim=True)

DISTRICTS_FOREIGN_GENDER = _spec(
    "districts_foreign_gender", "district", "Stadtteil",
    UnpivotCategories("Datum", _gender(), year_parser="first", keep_last=True,
                      filter_column="Merkmal", filter_value="Auslaender",
                      indicator="foreign_gender", unit="persons"),
    trim=True)

DISTRICTS_FOREIGN_NATIONALITIES_SELECTED = _spec(
    "districts_foreign_nationalities_selected",
    "district", "Stadtteil",
    UnpivotCategories("Jahr", _columns(NATIONALITIES, total=True, lenient=True),
                      indicator="foreign_nationalities_selected", unit="persons"),
    trim=True)

DISTRICTS_AGE_GROUPS = _spec(
    "districts_age_groups", "district", "Stadtteil",
    UnpivotCategories("Datum", _columns(DISTRICT_AGES, total=True), year_parser="first",
                      filter_column="Merkmal", filter_value="Einwohner nach Altersgruppen",
                      indicator="age_groups", unit="persons"))

DISTRICTS_AREA_HECTARES = _spec(
    "districts_area_hectares", "district", "Stadtteil",
    UnpivotCategories("Jahr", (CategoryColumn(Category("total"),
                                              value=lambda: decimal_comma(F.col("Hektar"))),),
                      filter_column="Merkmal", filter_value="Flaechen in Hektar",
                      indicator="area_hectares", unit="hectares"))

DISTRICTS_MIGRANT_GENDER = _spec(
    "districts_migrant_gender",
    "district", "Stadtteil",
    UnpivotCategories("Datum", _gender(MALE_ALTERNATIVES), year_parser="first", keep_last=True,
                      filter_column="Merkmal", filter_value="Einwohner mit Migrationshintergrund",
                      indicator="migrant_gender", unit="persons"),
    trim=True, csv=CsvOptions(fallback_encodings=("latin-1",)))

DISTRICTS_UNEMPLOYED_COUNT = _spec(
    "districts_unemployed_count", "district", "Stadtteil",
    UnpivotYears("Merkmal", _years_row("Arbeitslose", "unemployed_count", "persons"),
                 year_pattern=DATE_HEADER, year_parser="first"))

DISTRICTS_UNEMPLOYED_RATE = _spec(
    "districts_unemployed_rate",
    "district", "Stadtteil",
    UnpivotYears("Merkmal", _years_row("Betroffenheitsquote", "unemployed_rate", "percent",
                                       decimal_comma),
                 year_pattern=DATE_HEADER, year_parser="first"))

DISTRICTS_RELIGION = _spec(
    "districts_religion",
    "district", "Stadtteil",
    UnpivotCategories("Jahr", _columns(RELIGION, total=True), indicator="religion",
                      unit="persons"))

POSTAL_CODES_POPULATION = _spec(
    "postal_codes_population", "postal_code", "PLZ-Bereich",
    UnpivotYears("Merkmal", _years_row("Jahr", "population", "persons", thousands_dot)),
    trim=True,
    csv=CsvOptions(quote='"', escape='"', strict=False),
    column_aliases={"PLZ-Bereich": ("PLZ-\nBereich", "PLZ- Bereich", "PLZ Bereich")})

SUBDISTRICTS_POPULATION = _spec(
    "subdistricts_population", "subdistrict", "Ortsteil",
    UnpivotYears("Merkmal", _years_row("Einwohner insgesamt", "population", "persons"),
                 year_pattern=YEAR_WITH_SUFFIX, year_parser="leading"),
    trim=True)

SUBDISTRICTS_AGE_GROUPS = _spec(
    "subdistricts_age_groups", "subdistrict", "Ortsteil",
    UnpivotCategories("Datum", _columns(SUBDISTRICT_AGES, total=True),
                      year_parser="first", keep_last=True, filter_column="Merkmal",
                      filter_value="Einwohner nach Altersgruppen", indicator="age_groups",
                      unit="persons"),
    trim=True)

SUBDISTRICTS_GENDER = _spec(
    "subdistricts_gender", "subdistrict", "Ortsteil",
    UnpivotCategories("Datum", _gender(), year_parser="first", keep_last=True,
                      filter_column="Merkmal", filter_value="Einwohner insgesamt",
                      indicator="gender", unit="persons"),
    trim=True)

SUBDISTRICTS_FOREIGN_GENDER = _spec(
    "subdistricts_foreign_gender", "subdistrict", "Ortsteil",
    UnpivotCategories("Datum", _gender(), year_parser="first", keep_last=True,
                      filter_column="Merkmal", filter_value="Auslaender",
                      indicator="foreign_gender", unit="persons"),
    trim=True)

SUBDISTRICTS_MIGRANT_GENDER = _spec(
    "subdistricts_migrant_gender",
    "subdistrict", "Ortsteil",
    UnpivotCategories("Datum", _gender(MALE_ALTERNATIVES), year_parser="first", keep_last=True,
                      filter_column="Merkmal", filter_value="Einwohner mit Migrationshintergrund",
                      indicator="migrant_gender", unit="persons"),
    trim=True, csv=CsvOptions(fallback_encodings=("latin-1",)))

# Registry order of the import manifest.
MANIFEST = (
    DISTRICTS_POPULATION,
    DISTRICTS_HOUSEHOLDS_TYPE_SIZE,
    DISTRICTS_MARITAL_STATUS,
    DISTRICTS_GENDER,
    DISTRICTS_FOREIGN_AGE_GROUPS,
    DISTRICTS_FOREIGN_COUNT,
    DISTRICTS_FOREIGN_GENDER,
    DISTRICTS_FOREIGN_NATIONALITIES_SELECTED,
    DISTRICTS_AGE_GROUPS,
    DISTRICTS_AREA_HECTARES,
    DISTRICTS_MIGRANT_GENDER,
    DISTRICTS_UNEMPLOYED_COUNT,
    DISTRICTS_UNEMPLOYED_RATE,
    DISTRICTS_RELIGION,
    POSTAL_CODES_POPULATION,
    SUBDISTRICTS_POPULATION,
    SUBDISTRICTS_AGE_GROUPS,
    SUBDISTRICTS_GENDER,
    SUBDISTRICTS_FOREIGN_GENDER,
    SUBDISTRICTS_MIGRANT_GENDER,
)


def datasets(dataset_id: str | None = None):
    return resolve_specs(MANIFEST, dataset_id)
